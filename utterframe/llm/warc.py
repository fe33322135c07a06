"""WARC archives: written by Spark's text sink, indexed first, read back by coalesced byte ranges.

Each record is one gzip member; a file is a ``warcinfo`` record and its records, end to end, named ``.warc.gz``. (The sink
puts a separator after every row. It is a zero byte, which is also the last byte of any gzip member of less than 16 MiB
of data: members go to the sink without it. Only after larger records it is padding, which gzip allows.)

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with the largest page_id is a response and the
others are revisits, whose HTTP header still states the payload's length and whose WARC header its digest and what they
refer to. This is decided on digests and ids alone: a bitmap of fixed size lets pages without a copy pass straight to the
sink, and of the others only those that become responses are joined with their html.

The index has path, offset, length, URL and digest of every record; a selection of its rows is read by sorting them by
place and merging neighbours into one range read each. Work is dealt by bytes: a task indexes some files and reads
ranges of about ``PART_BYTES``. Archive and index lie in the shared folder, so that a lost executor costs no data.

URLs stand in the archive as they are; those with control characters or outer white space are percent-escaped, which a
header of the record's tells, and are whole again in the index.

Defined results: a null html is an empty payload; a null URL is written as ``urn:x-page:<page_id>`` with a header that
says so, and reads back as null; html of any length is one record, and must fit a task; a null page_id stays null and, if
all copies lack one, all are responses; rows that repeat the largest page_id are all responses; repeated rows are
repeated records; extra columns are ignored, whatever their names; an empty table gives an empty archive and result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterframe.llm.common import bitmap_of, bounded_batches, discard, in_bitmap, materialize, scratch_path

MIN_REVISIT = 1000
#: Bytes between two records that are read rather than skipped, bytes of one read, and bytes of a task, about; fewer, down
#: to the last, where the cluster would stand idle.
GAP, RANGE_BYTES, PART_BYTES, LEAST_BYTES = 64 << 10, 4 << 20, 16 << 20, 1 << 20
#: Tasks at most; beyond it each takes more bytes.
MOST_PARTS = 20_000
BITMAP_BITS = 22
DATE = "2024-01-01T00:00:00Z"
PADDING = "\x00"
INDEX = "path string, offset long, length long, url string, digest string, record_type string, page_id string"
#: Characters of a URL that a header line can't hold.
UNSAFE = re.compile(r"[\x00-\x1f\x7f\x85\u2028\u2029]|^\s|\s$|^$")
#: Headers of our own.
ESCAPED, ABSENT = "X-Target-Escaped: percent", "X-Target-Absent: true"


def prepare(pages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """page_id, url, html (null for revisits), n_bytes, digest, refers_to (the response's page_id, for revisits); and the
    scratch tables that these depend on."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    given = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("__key"), "url", "html")
    given = given.withColumns({"digest": F.sha1(payload), "n_bytes": F.octet_length(payload).cast("long")})
    large = given.where(F.col("n_bytes") >= MIN_REVISIT)
    copies = large.groupBy("digest").agg(F.max("__key").alias("__first"), F.count("*").alias("n")).where("n > 1")
    copies = materialize(copies.select("digest", "__first"), "warc-copies")
    hashed = F.xxhash64("digest")
    copied = (F.col("n_bytes") >= MIN_REVISIT) & in_bitmap(hashed, bitmap_of(copies, hashed, BITMAP_BITS))
    alone = given.where(~copied).select("page_id", "url", "html", "n_bytes", "digest", F.lit(None).cast("string").alias("refers_to"))
    # the rest without html: revisits, and which pages are responses after all (some have no copy but share a bit)
    other = F.coalesce(F.col("__first") != F.col("__key"), F.col("__key").isNull() & F.col("__first").isNotNull())
    judged = given.where(copied).select("page_id", "__key", "url", "n_bytes", "digest").join(copies, "digest", "left").withColumn("again", other)
    judged = materialize(judged, "warc-copied")
    revisits = judged.where("again").select(
        "page_id", "url", F.lit(None).cast("string").alias("html"), "n_bytes", "digest", F.col("__first").cast("string").alias("refers_to")
    )
    chosen = judged.where("not again").select(F.col("digest").alias("__digest"), F.col("__key").alias("__page")).distinct()
    named = F.xxhash64("digest", "__key")
    bits = bitmap_of(chosen.toDF("digest", "__key"), named, BITMAP_BITS)
    is_it = (F.col("digest") == F.col("__digest")) & F.col("__key").eqNullSafe(F.col("__page"))
    responses = given.where(copied & in_bitmap(named, bits)).join(chosen, is_it, "left_semi").select(*alone.columns[:-1], F.lit(None).cast("string").alias("refers_to"))
    return alone.unionByName(responses).unionByName(revisits), [copies, judged]


def member(lines: list[str], block: bytes) -> bytes:
    """A record as a gzip member, without its last byte where that is the sink's separator."""
    raw = ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = press.compress(raw) + press.flush()
    return out.removesuffix(PADDING.encode())


def record(page_id: str | None, url: str | None, html: str | None, n_bytes: int, digest: str, refers_to: str | None) -> bytes:
    revisit = refers_to is not None
    payload = b"" if revisit else (html or "").encode("utf-8", "surrogatepass")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + payload
    escape = url is not None and UNSAFE.search(url) is not None
    target = f"urn:x-page:{quote(page_id or '')}" if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]-._~") if escape else url
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else quote(page_id)}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    lines += [ABSENT] if url is None else [ESCAPED] if escape else []
    if revisit:
        lines += [f"WARC-Refers-To: <urn:x-page:{quote(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return member(lines, block)


def file_info() -> bytes:
    """The first record of a file."""
    fields = b"software: utterframe\r\nformat: WARC File Format 1.1\r\n"
    lines = [
        "WARC/1.1", "WARC-Type: warcinfo", "WARC-Record-ID: <urn:x-info:file>", f"WARC-Date: {DATE}",
        "Content-Type: application/warc-fields", f"Content-Length: {len(fields)}",
    ]
    return member(lines, fields)


def parse_record(raw: bytes) -> dict:
    """Headers (lower-case names), http (its header lines) and payload of an uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:40]!r}")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in http.decode("utf-8").split("\r\n")[1:])}
    return {"headers": headers, "http": fields, "payload": payload}


def target_of(headers: dict[str, str]) -> str | None:
    """The URL of a record, as it was given."""
    if headers.get("x-target-absent") == "true":
        return None
    uri = headers["warc-target-uri"]
    return unquote(uri) if headers.get("x-target-escaped") == "percent" else uri


def _id(value: str) -> str | None:
    return unquote(value.removeprefix("<urn:x-page:").removesuffix(">")) or None


def write(pages: DataFrame, path: str) -> None:
    """Writes a folder of archives."""
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = [file_info()]
        for batch in batches:
            if batch.num_rows:
                cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "n_bytes", "digest", "refers_to")]
                yield pa.RecordBatch.from_arrays([pa.array([*first, *map(record, *cols)], pa.binary())], names=["record"])
                first = []

    prepared, scratch = prepare(pages)
    records = prepared.mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string")).write.option("lineSep", PADDING).option("compression", "none").text(path)
    discard(*scratch)
    session = pages.sparkSession
    folder = session._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(session._jsc.sc().hadoopConfiguration())
    for found in system.listStatus(folder):
        name = found.getPath().getName()
        if found.getLen() == 0:
            system.delete(found.getPath(), False)
        elif name.startswith("part-"):
            system.rename(found.getPath(), session._jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.gz"))


class RangeReader:
    """Byte ranges of files, kept open one at a time, through pyarrow's file systems."""

    def __init__(self) -> None:
        self.path, self.file = "", None

    def read(self, path: str, offset: int, length: int) -> bytes:
        from pyarrow import fs

        if path != self.path:
            self.close()
            system, name = fs.FileSystem.from_uri(path)
            self.path, self.file = path, system.open_input_file(name)
        self.file.seek(offset)
        return self.file.read(length)

    def close(self) -> None:
        if self.file:
            self.file.close()


def scan(path: str, size: int, reader: RangeReader, chunk: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and bytes of each gzip member of a file, read in chunks."""
    at = start = 0
    inflate, parts = None, []
    while at < size:
        data = reader.read(path, at, min(chunk, size - at))
        if not data:
            raise EOFError(f"{path} ends at {at}")
        at += len(data)
        while data:
            if inflate is None:
                stripped = data.lstrip(b"\x00")
                start = at - len(stripped)
                data = stripped
                if not data:
                    break
                inflate, parts = zlib.decompressobj(31), []
            parts.append(inflate.decompress(data))
            data = inflate.unused_data
            if inflate.eof:
                yield start, at - len(data) - start, b"".join(parts)
                inflate = None
    if inflate is not None:
        raise EOFError(f"{path} ends within a record")


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """A row for each response and revisit of the archives in ``path``, found by reading each file once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for batch in batches:
            for name, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                rows = []
                for offset, length, raw in scan(name, size, reader):
                    h = parse_record(raw)["headers"]
                    if h["warc-type"] not in ("response", "revisit"):
                        continue
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    rows.append((name, offset, length, target_of(h), digest, h["warc-type"], _id(h["warc-record-id"])))
                cols = list(zip(*rows, strict=True)) or [()] * 7
                types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                    names=["path", "offset", "length", "url", "digest", "record_type", "page_id"],
                )
        reader.close()

    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))
    return files.repartition(parts(files, "size", whole=True)).mapInArrow(run, INDEX)


def parts(df: DataFrame, size: str, whole: bool = False) -> int:
    """How many tasks share the bytes that ``size`` adds up to; no more than rows if these can't be cut."""
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    busy = min(-(-total // LEAST_BYTES), df.sparkSession.sparkContext.defaultParallelism)
    return max(1, min(max(-(-total // PART_BYTES), busy), MOST_PARTS, *([n] if whole else [])))


def coalesced(rows: list[dict]) -> Iterator[tuple[str, int, int, list[dict]]]:
    """Sorted index rows as (path, offset, length, rows) range reads."""
    group: list[dict] = []
    end = 0
    for row in rows:
        if group and (row["path"] != group[0]["path"] or row["offset"] > end + GAP or row["offset"] + row["length"] - group[0]["offset"] > RANGE_BYTES):
            yield group[0]["path"], group[0]["offset"], end - group[0]["offset"], group
            group = []
        end = max(end, row["offset"] + row["length"]) if group else row["offset"] + row["length"]
        group.append(row)
    if group:
        yield group[0]["path"], group[0]["offset"], end - group[0]["offset"], group


RECORDS = "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def read_records(selected: DataFrame, *, payloads: bool = True) -> DataFrame:
    """The records of selected index rows; a response's payload is checked against its digest and length, and returned
    if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for batch in batches:
            for path, offset, length, rows in coalesced(batch.to_pylist()):
                data = reader.read(path, offset, length)
                out = []
                for row in rows:
                    lo = row["offset"] - offset
                    r = parse_record(zlib.decompress(data[lo : lo + row["length"]], 31))
                    h, size = r["headers"], int(r["http"]["content-length"])
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    revisit = h["warc-type"] == "revisit"
                    if not revisit and (hashlib.sha1(r["payload"]).hexdigest() != digest or len(r["payload"]) != size):
                        raise ValueError(f"damaged record at {row['offset']} of {path}")
                    out.append((
                        _id(h["warc-record-id"]), target_of(h), h["warc-type"], _id(h["warc-refers-to"]) if revisit else None,
                        digest, size, r["payload"] if payloads and not revisit else None,
                    ))
                cols = list(zip(*out, strict=True))
                types = [*[pa.string()] * 5, pa.int64(), pa.binary()]
                names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)
        reader.close()

    bounded_batches(selected.sparkSession)
    # a stretch of a file stays together, in order
    stretch = F.floor(F.col("offset") / PART_BYTES)
    placed = selected.select("path", "offset", "length").repartition(parts(selected, "length"), "path", stretch).sortWithinPartitions("path", "offset")
    return placed.mapInArrow(run, RECORDS)


def archive(pages: DataFrame) -> tuple[str, DataFrame]:
    """Writes pages to a new folder of the shared one; its path and its index, a table there."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path)
    return path, materialize(build_index(pages.sparkSession, path), "warc-index")
