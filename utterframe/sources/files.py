"""Segment documents, manifests and listings as files."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterframe.operators.package import DOCUMENT

#: CSV as Python's csv module writes it: CRLF, doubled quotes, nothing for an empty value.
CSV_OPTIONS = {"header": "true", "escape": '"', "lineSep": "\r\n", "emptyValue": "", "encoding": "UTF-8"}


def write_text_atomically(path: str, text: str) -> None:
    tmp = f"{path}.tmp"
    Path(tmp).write_text(text, encoding="utf-8")
    os.replace(tmp, path)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """path and the fields of each segment document in a folder, in any layout of its JSON; a broken one fails.

    The driver lists the folder, since file sources skip names that begin with an underscore; tasks read the files.
    """
    root = Path(folder)
    paths = [(str(p),) for p in sorted(root.glob("*.json"))] if root.is_dir() else []
    listed = spark.createDataFrame(paths, "path string").repartition(max(1, min(len(paths) // 200 + 1, 1000)))

    def read(batches):
        for pdf in batches:
            yield pdf.assign(body=[Path(p).read_text(encoding="utf-8") for p in pdf["path"]])

    bodies = listed.mapInPandas(read, "path string, body string")
    return bodies.select("path", F.from_json("body", DOCUMENT, {"mode": "FAILFAST"}).alias("d")).select("path", "d.*")


def write_documents(docs: DataFrame, folder: str) -> int:
    """One JSON file per document, each moved into place whole; returns how many."""

    def write(batches):
        for pdf in batches:
            for name, body in zip(pdf["segment_id"], pdf["body"], strict=True):
                write_text_atomically(f"{folder}/{name}.json", body)
            yield pdf[["segment_id"]]

    Path(folder).mkdir(parents=True, exist_ok=True)
    body = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    return docs.select("segment_id", body.alias("body")).mapInPandas(write, "segment_id string").count()


def write_manifest(docs: DataFrame, path: str) -> int:
    """One file with a JSON line for each document in the order of paths; returns how many.

    Written as ordered parts, which are then joined: the lines pass through no task and no driver memory as a whole.
    """
    folder = f"{path}.parts"
    lines = docs.orderBy("path").select(F.to_json(F.struct(*[c for c in docs.columns if c != "path"]), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.mode("overwrite").text(folder)
    n = 0
    with open(f"{path}.tmp", "wb") as out:
        for part in sorted(Path(folder).glob("part-*")):
            with open(part, "rb") as lines_of:
                for line in lines_of:
                    out.write(line)
                    n += 1
    os.replace(f"{path}.tmp", path)
    _remove_folder(folder)
    return n


def _remove_folder(folder: str) -> None:
    for left in Path(folder).iterdir():
        left.unlink()
    Path(folder).rmdir()


def write_csv(rows: DataFrame, path: str) -> None:
    """One CSV file: a listing is a line per clip, and readers expect one header."""
    folder = f"{path}.parts"
    rows.coalesce(1).write.mode("overwrite").options(**CSV_OPTIONS).csv(folder)
    part = next(Path(folder).glob("part-*.csv"), None)
    if part is None:
        write_text_atomically(path, ",".join(rows.columns) + "\r\n")
    else:
        os.replace(part, path)
    _remove_folder(folder)


def remove_files(paths: DataFrame) -> int:
    """Deletes the files named by the only column, on the executors; returns how many were there."""
    column = paths.columns[0]

    def run(batches):
        for pdf in batches:
            gone = []
            for p in map(Path, pdf[column]):
                gone.append(p.exists())
                p.unlink(missing_ok=True)
            yield pdf.assign(gone=gone)[["gone"]]

    return paths.mapInPandas(run, "gone boolean").where("gone").count()


def remove_segments(folder: str, segments: DataFrame) -> int:
    """Deletes every file named after the segments in the column segment_id; returns how many segments had one.

    The folder is listed once, by the driver; files meet the segments in a join and go on the executors.
    """
    spark = segments.sparkSession
    listed = spark.createDataFrame([(p.stem, str(p)) for p in Path(folder).iterdir() if p.is_file()], "segment_id string, path string")
    found = listed.join(segments.select("segment_id").distinct(), "segment_id")
    n = found.select("segment_id").distinct().count()
    remove_files(found.select("path"))
    return n
