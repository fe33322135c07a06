"""Speech-shaped views of general tables: words, speech regions, speaker turns. Times are whole milliseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH_US = 1704067200000000
#: Bytes of stored documents to a partition of words: sorted, their words take some 30 times as much memory, and a list of a
#: segment's words is gathered by two more sorts beside that one.
PART_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str, by_video: bool = False) -> DataFrame:
    """A document is a video; a gap of 300 ms after every 7th token, another speaker after every 23rd.

    by_video deals the documents by video before they become words, which then lie together and aren't shuffled.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    if by_video:
        stored = int(str(table(spark, sf_dir, "documents")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), stored // PART_BYTES)
        documents = documents.repartition(parts, "doc_id")
    token = documents.select("doc_id", F.posexplode(F.split("text", "[ \n\t\r]+")).alias("widx", "text"))
    return token.where("text <> ''").selectExpr(
        "doc_id AS video_id", "widx", "text", "CAST(widx*400 + (widx div 7)*300 AS BIGINT) AS start",
        "CAST(widx*400 + (widx div 7)*300 + 200 + (length(text)*37)%180 AS BIGINT) AS end",
        "concat('SPK_', CAST((doc_id + widx div 23)%3 AS STRING)) AS speaker",
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is a video, an event a speech interval; 30 days pass in 72 minutes."""
    at = f"(unix_micros(CAST(ts AS TIMESTAMP)) - {EPOCH_US}) div 600000"
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS video_id", "event_id AS ridx", f"CAST({at} AS BIGINT) AS start",
        f"CAST({at} + CAST(round(value*100) AS BIGINT)*2 AS BIGINT) AS end",
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a video, a role a speaker."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id AS video_id", "turn AS tidx", "role AS speaker", "turn*4000 AS start", "turn*4000 + 3000 + length(text)%3000 AS end"
    )


WORDS_SQL = """(SELECT doc_id AS video_id, widx, text, CAST(widx*400 + (widx//7)*300 AS BIGINT) AS "start",
    CAST(widx*400 + (widx//7)*300 + 200 + (length(text)*37)%180 AS BIGINT) AS "end",
    concat('SPK_', CAST((doc_id + widx//23)%3 AS VARCHAR)) AS speaker
  FROM (SELECT doc_id, CAST(generate_subscripts(a,1)-1 AS INTEGER) AS widx, unnest(a) AS text
        FROM (SELECT doc_id, string_split_regex(text, '[ \\n\\t\\r]+') a FROM documents)) WHERE text <> '')"""

REGIONS_SQL = f"""(SELECT user_id AS video_id, event_id AS ridx, CAST((epoch_us(ts) - {EPOCH_US})//600000 AS BIGINT) AS "start",
    CAST((epoch_us(ts) - {EPOCH_US})//600000 + CAST(round(value*100) AS BIGINT)*2 AS BIGINT) AS "end" FROM events)"""

TURNS_SQL = """(SELECT conv_id AS video_id, turn AS tidx, role AS speaker, turn*4000 AS "start",
    turn*4000 + 3000 + length(text)%3000 AS "end" FROM conversations)"""
