"""What the corpus operators share: scratch tables, label samples, row-preserving Arrow maps, text arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterframe.session import ensure_importable

#: Characters of text that one numpy block holds at most, unless a single text is longer.
BLOCK_CHARS = 1_000_000
#: Tasks that read a labelled sample.
SAMPLE_TASKS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``. Only a local session may go without."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        path = tempfile.mkdtemp(prefix="utterframe-")
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage by a table in the shared folder, which outlives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` wrote, once no result depends on them any more."""
    for df in tables:
        if path := getattr(df, "_scratch_path", None):
            session = df.sparkSession
            at = session._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(session._jsc.sc().hadoopConfiguration()).delete(at, True)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB, whatever the length of the texts, for workers that can import this package."""
    ensure_importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def held_out(key: str, n: int, remainder: int) -> Column:
    return F.coalesce(fold(key, n) == remainder, F.lit(False))


def class_sample(keyed: DataFrame, label: str, key: str, per_class: int, max_rows: int) -> DataFrame:
    """At most ``per_class`` keys of each label and ``max_rows`` in all: those with the least hashes.

    A first cut by hash, from each label's count, lets about a quarter more than wanted through (four standard deviations
    and more), so that the ranking meets a bounded number of rows whatever the label's share. Labels beyond the
    ``max_rows`` commonest take no part.
    """
    place = F.shiftrightunsigned(F.xxhash64(F.col(key)), 11)
    counts = keyed.groupBy(label).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), label).limit(max_rows)
    near = keyed.select(key, label).join(F.broadcast(counts), label).where(place / F.lit(2.0**53) * F.col("__n") < 1.25 * per_class + 20)
    first = Window.partitionBy(label).orderBy(place, key)
    ranked = near.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= per_class)
    return ranked.orderBy("__r", place, key).limit(max_rows).select(key, label)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, *, id_col: str = "doc_id", text_col: str = "text",
    learn: Column, per_class: int, max_rows: int,
) -> DataFrame:
    """label and text of a bounded sample of rows by ``class_sample``: whole texts, whatever their length.

    Rows that ``learn`` refuses, null ids and null labels take no part; where an id has several labels the largest
    counts, where it has several texts the least of them. Texts stay on the executors: what is learned from them is
    counted there.
    """
    known = (
        labels.where(learn & F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .groupBy(id_col).agg(F.max(label).alias(label))
    )
    chosen = class_sample(known, label, id_col, per_class, max_rows)  # bounded by max_rows: safe to broadcast
    texts = (
        docs.select(F.col(id_col), F.col(text_col).alias("__text")).where(F.col("__text").isNotNull())
        .join(F.broadcast(chosen), id_col)
        .groupBy(id_col, label).agg(F.min("__text").alias("__text"))
    )
    return texts.select(F.col(label).cast("string").alias("label"), F.col("__text").alias("text")).repartition(SAMPLE_TASKS)


def is_set(label: Column) -> Column:
    """1 for a label that isn't zero or false, as text; else 0."""
    return F.coalesce(label.try_cast("double") != 0, label == "true").cast("int")


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores appended until no column bears it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def bitmap_of(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A bit for each key by the top ``bits`` bits of a 64-bit hash: 2**bits / 64 numbers, whatever the number of keys."""
    place = F.shiftrightunsigned(key, 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    rows = keys.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("mask")).toPandas()
    out = np.zeros((1 << bits) // 64, dtype=np.uint64)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def constants(values: Iterable, kind: str) -> Column:
    """An array constant, made from one string."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def in_bitmap(key: Column, bitmap: np.ndarray) -> Column:
    """Whether the bit of a 64-bit hash is set."""
    place = F.shiftrightunsigned(key, 64 - int(np.log2(len(bitmap) * 64)))
    word = F.get(constants(bitmap.view(np.int64).tolist(), "bigint"), F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, place.bitwiseAND(63).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def append_columns(
    df: DataFrame, fields: Sequence[tuple[str, str]], text_col: str,
    start: Callable[[], Callable[[list[str | None]], Sequence]],
) -> DataFrame:
    """``df`` with the columns ``fields`` (name, DDL type) computed from ``text_col``; every row stays.

    ``start`` runs once in each task and gives the function from a list of texts to one list or array per field.
    Columns of ``df`` stay as they are: an output whose name is taken gets ``free_name``.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    bounded_batches(df.sparkSession)
    added = T.StructType([T.StructField(free_name(n, df.columns), T._parse_datatype_string(t)) for n, t in fields])
    types = [to_arrow_type(f.dataType) for f in added.fields]
    names = [*df.columns, *added.names]
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or start()
            got = work(batch.column(at).to_pylist())
            new = [pa.array(v, type=t, from_pandas=False) for v, t in zip(got, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))


def blocks(texts: list[str | None], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``most`` characters together."""
    lo = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > lo and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


_ALPHA: np.ndarray | None = None


def is_letter(codes: np.ndarray) -> np.ndarray:
    """Which code points are Unicode letters."""
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _ALPHA[codes]


def ngram_buckets(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A hash bucket in [0, 2**bits) for each run of n code points."""
    if len(codes) < n:
        return np.empty(0, dtype=np.int64)
    h = np.full(len(codes) - n + 1, n * 0x9E3779B1, dtype=np.uint64)
    for i in range(n):
        h = (h + codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - bits)).astype(np.int64)
