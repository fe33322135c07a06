"""Job state: three keyed tables as versions of Parquet folders, switched by a pointer file.

Every change writes a new version of a table and then moves the pointer, by rename, so that readers see either all of a
change or none. Nothing is changed in place; a run that dies leaves the old version in force. The current version and
the one before it are kept. The folder must be a path that the driver and all executors share.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUSES = ("PENDING", "RUNNING", "DONE", "FAILED")
_TAIL = "status string, error string, created_at timestamp, updated_at timestamp"
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "videos": (("video_id",), f"video_id string, channel string, url string, raw_path string, standardized_path string, duration_s double, {_TAIL}"),
    "superchunks": (("video_id", "idx"), f"video_id string, idx int, start_s double, end_s double, words_json string, {_TAIL}"),
    "segments": (
        ("video_id", "idx"),
        "video_id string, idx int, segment_id string, start_s double, end_s double, text string, words_json string, speaker string, "
        f"exceeds_max_duration int, dnsmos_ovr double, output_audio_path string, output_json_path string, {_TAIL}",
    ),
}


def insert_if_absent(current: DataFrame, new: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """``current`` and the rows of ``new`` whose key it lacks, of equal keys the first by ``order``."""
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    fresh = new.withColumn("__n", first).where("__n = 1").join(current.select(*keys), keys, "left_anti")
    return current.unionByName(fresh.select(current.columns))


def upsert(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` and the rows of ``current`` whose key it lacks; rows that are replaced keep when they were created."""
    born = current.select(*keys, F.col("created_at").alias("__born"))
    fresh = new.join(born, keys, "left").withColumn("created_at", F.coalesce("__born", "created_at"))
    return current.join(new.select(*keys), keys, "left_anti").unionByName(fresh.select(current.columns))


def partial_update(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Sets the columns named in each change's ``set_fields`` (array<string>), nulls included; others stay."""
    fields = [c for c in current.columns if c not in keys]
    named = changes.select(*keys, F.col("set_fields").alias("__set"), *[F.col(c).alias(f"__{c}") for c in fields if c in changes.columns])
    joined = current.join(named, keys, "left")
    new = {c: F.when(F.array_contains("__set", c), F.col(f"__{c}")).otherwise(F.col(c)) for c in fields if c in changes.columns}
    return joined.withColumns(new).select(current.columns)


def recover_stale(current: DataFrame, now: Column, max_age_s: float = 0) -> DataFrame:
    """RUNNING rows back to PENDING: all of them for an age of 0, else those not updated since."""
    stale = F.col("status") == "RUNNING"
    if max_age_s > 0:
        stale = stale & (F.unix_micros("updated_at") < F.unix_micros(now) - int(max_age_s * 1_000_000))
    return current.withColumns({"status": F.when(stale, "PENDING").otherwise(F.col("status")), "updated_at": F.when(stale, now).otherwise(F.col("updated_at"))})


def by_status(current: DataFrame, status: str | None = None) -> DataFrame:
    return current if status is None else current.where(F.col("status") == status)


def status_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name and the number of rows in each status, 0 where there are none."""
    all_ = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("table_name"), "status")
        all_ = part if all_ is None else all_.unionByName(part)
    return all_.groupBy("table_name").agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def all_done(chunks: DataFrame) -> DataFrame:
    """video_id, ready: whether all of a video's chunks are DONE."""
    return chunks.groupBy("video_id").agg(F.bool_and(F.col("status").eqNullSafe(F.lit("DONE"))).alias("ready"))


def without_video(current: DataFrame, video_id) -> DataFrame:
    return current.where(~F.col("video_id").eqNullSafe(F.lit(video_id)))


def pending_and_fresh(current: DataFrame, candidates: DataFrame, order: str) -> DataFrame:
    """All PENDING rows, then the candidates that the table doesn't know in any status, each once."""
    from pyspark.sql import Window

    columns = candidates.drop(order).columns
    first = F.row_number().over(Window.partitionBy("video_id").orderBy(order))
    fresh = candidates.withColumn("__n", first).where("__n = 1").join(current.select("video_id"), "video_id", "left_anti")
    waiting = current.where("status = 'PENDING'").select(*columns, F.lit(0).alias("rank"))
    return waiting.unionByName(fresh.select(*columns, F.lit(1).alias("rank")))


class JobStore:
    """The three tables in a folder that the session's file system reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        Path(self.root).mkdir(parents=True, exist_ok=True)

    def _pointer(self, table: str) -> Path:
        return Path(self.root, f"{table}.current")

    def read(self, table: str) -> DataFrame:
        schema = T._parse_datatype_string(TABLES[table][1])
        pointer = self._pointer(table)
        if not pointer.exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{json.loads(pointer.read_text())['version']}")

    def write(self, table: str, df: DataFrame) -> None:
        version = f"{table}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{version}")
        tmp = self._pointer(table).with_suffix(".tmp")
        before = json.loads(self._pointer(table).read_text()) if self._pointer(table).exists() else {}
        tmp.write_text(json.dumps({"version": version, "before": before.get("version")}))
        os.replace(tmp, self._pointer(table))
        if old := before.get("before"):  # the last version stays for readers that began with it
            shutil.rmtree(Path(self.root, old), ignore_errors=True)

    def add(self, table: str, rows: DataFrame, order: Column | str | None = None) -> int:
        """Inserts rows whose key is new, as PENDING unless they say otherwise; returns how many."""
        keys, ddl = TABLES[table]
        current = self.read(table)
        given = rows.withColumn("status", F.coalesce("status", F.lit("PENDING")) if "status" in rows.columns else F.lit("PENDING"))
        now = F.current_timestamp()
        given = given.withColumns({c: now for c in ("created_at", "updated_at") if c not in rows.columns})
        missing = {f.name: F.lit(None).cast(f.dataType) for f in T._parse_datatype_string(ddl).fields if f.name not in given.columns}
        before = current.count()
        self.write(table, insert_if_absent(current, given.withColumns(missing), list(keys), order if order is not None else F.lit(0)))
        return self.read(table).count() - before

    def put(self, table: str, rows: DataFrame, without: DataFrame | None = None) -> None:
        """Inserts rows or replaces those with their key (one row a key); drops the rows of the videos in ``without``."""
        keys, ddl = TABLES[table]
        now = F.current_timestamp()
        given = rows.withColumns({c: now for c in ("created_at", "updated_at") if c not in rows.columns})
        missing = {f.name: F.lit(None).cast(f.dataType) for f in T._parse_datatype_string(ddl).fields if f.name not in given.columns}
        current = self.read(table)
        if without is not None:
            current = current.join(without.select("video_id"), "video_id", "left_anti").select(current.columns)
        self.write(table, upsert(current, given.withColumns(missing), list(keys)))

    def get(self, table: str, *key) -> dict | None:
        """The row of a key, if there is one."""
        keys, _ = TABLES[table]
        found = self.read(table)
        for name, value in zip(keys, key, strict=True):
            found = found.where(F.col(name) == F.lit(value))
        row = found.first()
        return row.asDict() if row else None

    def update(self, table: str, changes: DataFrame) -> None:
        """``changes``: the key, new values, and no other column; every given column is set, nulls too."""
        keys, _ = TABLES[table]
        fields = [c for c in changes.columns if c not in keys]
        if not fields:
            return
        stamped = changes.withColumns({"updated_at": F.current_timestamp(), "set_fields": F.array(*[F.lit(c) for c in [*fields, "updated_at"]])})
        self.write(table, partial_update(self.read(table), stamped, list(keys)))

    def recover_stale_running(self, max_age_s: float = 0) -> int:
        """Sets stale RUNNING rows to PENDING; returns how many. Tables without one are left alone."""
        total = 0
        for table in TABLES:
            current, now = self.read(table), F.current_timestamp()
            stale = recover_stale(current.where("status = 'RUNNING'"), now, max_age_s).where("status = 'PENDING'").count()
            if stale:
                self.write(table, recover_stale(current, now, max_age_s))
            total += stale
        return total

    def reset(self, video_id: str | None = None) -> dict[str, int]:
        """Removes a video's rows, or all; returns the rows removed from each table."""
        removed = {}
        for table in TABLES:
            current = self.read(table)
            gone = current if video_id is None else current.where(F.col("video_id").eqNullSafe(F.lit(video_id)))
            removed[table] = gone.count()
            if removed[table]:
                self.write(table, current.limit(0) if video_id is None else without_video(current, video_id))
        return removed

    def counts(self) -> DataFrame:
        return status_counts({t: self.read(t) for t in TABLES})
