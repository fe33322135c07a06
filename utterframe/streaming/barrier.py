"""A per-video barrier over a stream of finished chunks: a video's words leave when all its chunks are there."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CHUNKS = (
    "video_id string, chunk_idx int, n_chunks int, chunk_start double, chunk_end double, status string, "
    "words array<struct<widx:int,text:string,start:double,end:double,speaker:string,overlap:boolean>>"
)


def ready_videos(chunks: DataFrame) -> DataFrame:
    """video_id of the videos whose chunks are all there and DONE; a chunk that comes again counts once."""
    done = chunks.where("status = 'DONE'").groupBy("video_id").agg(F.count_distinct("chunk_idx").alias("n"), F.max("n_chunks").alias("of"))
    return done.where("n >= of").select("video_id")


def exploded(chunks: DataFrame) -> DataFrame:
    """A row per word (one with a null text for a chunk without words), as the seam merge takes it."""
    once = chunks.where("status = 'DONE'").dropDuplicates(["video_id", "chunk_idx"])
    return once.select("video_id", "chunk_idx", "chunk_start", "chunk_end", F.explode_outer("words").alias("w")).select(
        "video_id", "chunk_idx", "chunk_start", "chunk_end", "w.*"
    )


def run_incrementally(
    spark: SparkSession, source: str, state: str, output: str, segment: Callable[[DataFrame], DataFrame], *, files_per_batch: int = 32
) -> StreamingQuery:
    """Reads chunk files as they come; each batch segments the videos it completes and appends them to ``output``.

    Chunks that wait for others are a table in ``state``, one folder a batch: a batch reads what waited after the batch
    before it, never what was delivered, and drops older folders. All folders are named by the batch's number, so that a
    repeated batch replaces what it wrote before. Chunks that come again after their video was delivered wait in vain.
    """
    stream = spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", files_per_batch).json(source)

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        folder = lambda n: f"{state}/waiting/batch={n}"
        known = batch
        if number > 0:
            known = known.unionByName(session.read.schema(batch.schema).parquet(folder(number - 1)))
        ready = ready_videos(known)
        segment(exploded(known.join(ready, "video_id", "left_semi"))).write.mode("overwrite").parquet(f"{output}/batch={number}")
        known.join(ready, "video_id", "left_anti").select(batch.columns).write.mode("overwrite").parquet(folder(number))
        old = session._jvm.org.apache.hadoop.fs.Path(folder(number - 2))
        old.getFileSystem(session._jsc.sc().hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{state}/checkpoint-{uuid.uuid5(uuid.NAMESPACE_URL, source)}").trigger(availableNow=True).start()
