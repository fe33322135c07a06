"""Queries on packaged segments and job state, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterframe import fixtures as fx
from utterframe.config import Filter, cost_of
from utterframe.functions import text as tx
from utterframe.operators import browse, jobstore, package, quality
from utterframe.operators.order import numbered
from utterframe.plans.registry import query

#: Events as packaged segments: times in ms, scores and speakers with gaps.
_SEGMENTS = """(SELECT event_id AS idx, user_id AS video_id, CAST(user_id AS VARCHAR) || '_' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(5, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') AS segment_id,
    event_id * 1000 AS "start", event_id * 1000 + 500 + event_id * 37 % 9000 AS "end", (500 + event_id * 37 % 9000) / 1000.0::DOUBLE AS duration, event_type AS text,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '' ELSE 'SPK_' || CAST(event_id % 3 AS VARCHAR) END AS speaker,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE ['en', 'fr', 'it''s'][1 + event_id % 3] END AS language,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id * 29 % 500 AS DOUBLE) / 100 END AS ovr, event_id % 17 = 0 AS has_overlap, event_id % 19 = 0 AS exceeds_max_duration,
    'out/' || segment_id || '.json' AS path FROM events)"""


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events")
    n = F.col("event_id")
    out = e.select(
        n.alias("idx"), F.col("user_id").alias("video_id"), tx.segment_id(F.col("user_id"), n).alias("segment_id"),
        (n * 1000).alias("start"), (n * 1000 + 500 + n * 37 % 9000).alias("end"), ((500 + n * 37 % 9000) / 1000.0).alias("duration"),
        F.col("event_type").alias("text"),
        F.when(n % 7 == 0, None).when(n % 7 == 1, "").otherwise(F.concat(F.lit("SPK_"), (n % 3).cast("string"))).alias("speaker"),
        F.when(n % 11 != 0, F.element_at(F.array(F.lit("en"), F.lit("fr"), F.lit("it's")), (1 + n % 3).cast("int"))).alias("language"),
        F.when(n % 13 != 0, (n * 29 % 500).cast("double") / 100).alias("ovr"), (n % 17 == 0).alias("has_overlap"),
        (n % 19 == 0).alias("exceeds_max_duration"),
    )
    return out.withColumn("path", F.concat(F.lit("out/"), "segment_id", F.lit(".json")))


_UNKNOWN = "coalesce(nullif(speaker, ''), 'UNKNOWN')"


@query(f"""WITH r AS (SELECT segment_id, ovr, CASE WHEN has_overlap THEN 'overlapping multi-speaker speech detected'
      WHEN duration < 1.5 THEN 'duration ' || printf('%.2f', duration) || 's below min_duration_s'
      WHEN language IS NOT NULL AND language NOT IN ('en', 'de') THEN 'language ' || CASE WHEN contains(language, '''') THEN '"' || language || '"' ELSE '''' || language || '''' END || ' not in allowed_languages'
      END AS cheap FROM {_SEGMENTS}),
    v AS (SELECT segment_id, cheap, ovr, coalesce(cheap, CASE WHEN ovr IS NULL THEN 'dnsmos scoring failed' WHEN ovr < 2.5 THEN 'dnsmos_ovr ' || printf('%.2f', ovr) || ' below threshold' END) AS reason FROM r)
    SELECT segment_id, reason IS NULL AS passed, reason, CASE WHEN cheap IS NULL THEN ovr END AS dnsmos_ovr FROM v""")
def quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    cfg = Filter(reject_overlapping_speech=True, min_duration_s=1.5, allowed_languages=["en", "de"], min_dnsmos_ovr=2.5)
    known = _segments(spark, sf).withColumnRenamed("ovr", "measured")
    blank = F.lit(None).cast("double")
    score = lambda df: df.withColumns({"sig": blank, "bak": blank, "ovr": F.col("measured")})
    return quality.filter_segments(known, cfg, score).select("segment_id", "passed", "reason", "dnsmos_ovr")


@query("""WITH w AS (SELECT vec_id, unnest(range(0, greatest(0, len(embedding) - 16) + 1, 8)) AS s, embedding FROM embeddings),
    m AS (SELECT vec_id, s, round(list_sum([CAST(round(x * 1000) AS BIGINT) FOR x IN embedding[s + 1 : s + 16]]) / 16.0, 6) AS m FROM w)
    SELECT vec_id, count(*) AS n_windows, CAST(sum(CAST(round(m * 16) AS BIGINT)) AS BIGINT) AS total FROM m GROUP BY vec_id""")
def window_mean(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.round(x * F.lit(1000).cast("float")))  # in single precision, as SQL multiplies a FLOAT
    clips = fx.table(spark, sf, "embeddings").select("vec_id", whole.alias("samples"))
    scored = quality.window_mean(clips, "samples", 16, 8)
    n = F.floor(F.greatest(F.lit(0), F.size("samples") - 16) / 8) + 1
    return scored.select("vec_id", n.cast("long").alias("n_windows"), F.round(F.col("mean_score") * n * 16).cast("long").alias("total"))


@query(f"SELECT segment_id, path, text, CAST(row_number() OVER (ORDER BY path) AS BIGINT) AS no FROM {_SEGMENTS}")
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(_segments(spark, sf), "path").select("segment_id", "path", "text", F.col("no").cast("long").alias("no"))


@query(f"SELECT CAST(row_number() OVER (ORDER BY path) AS BIGINT) AS no, segment_id || '.flac' AS filename, coalesce(text, '') AS text FROM {_SEGMENTS}")
def manifest_csv(spark: SparkSession, sf: str) -> DataFrame:
    return package.listing(_segments(spark, sf), "flac").withColumn("no", F.col("no").cast("long"))


@query("SELECT CAST(row_number() OVER (ORDER BY url, page_id) AS BIGINT) AS no, url AS filename, CAST(length(html) AS DOUBLE) / 8 AS duration_s FROM pages")
def transcribe_csv(spark: SparkSession, sf: str) -> DataFrame:
    pages = fx.table(spark, sf, "pages").select("page_id", F.col("url").alias("filename"), tx.rounded(F.length("html") / 8.0, 3).alias("duration_s"))
    return numbered(pages, "filename", ("page_id",)).select(F.col("no").cast("long").alias("no"), "filename", "duration_s")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of a speaker as packaged documents, in ms."""
    from utterframe.plans.segments import _numbered
    from utterframe.operators import rechunk

    built = rechunk.build_segments(_numbered(spark, sf).withColumnRenamed("sid", "seg"), longest=20_000)
    videos = fx.table(spark, sf, "documents").selectExpr("doc_id AS video_id", "concat(source, '/', lang) AS url")
    return package.documents(built, videos)


def _sentence_words() -> str:
    from utterframe.plans.segments import _SENTENCES

    return _SENTENCES


@query(_sentence_words() + """, s AS (SELECT video_id, sid, widx, text, "start", "end", speaker, first_value("start") OVER (PARTITION BY video_id, sid ORDER BY widx) AS b FROM g)
    SELECT CAST(video_id AS VARCHAR) || '_' || lpad(CAST(sid AS VARCHAR), CAST(greatest(5, length(CAST(sid AS VARCHAR))) AS INTEGER), '0') AS segment_id, text, "start" - b AS clip_start, "end" - b AS clip_end FROM s""")
def clip_words(spark: SparkSession, sf: str) -> DataFrame:
    word = _documents(spark, sf).select("segment_id", F.explode("words").alias("w"))
    return word.select("segment_id", "w.text", "w.clip_start", "w.clip_end")


@query(_sentence_words() + """, s AS (SELECT video_id, sid, widx, text, "start", "end", speaker, first_value("start") OVER (PARTITION BY video_id, sid ORDER BY widx) AS b FROM g)
    SELECT CAST(video_id AS VARCHAR) || '_' || lpad(CAST(sid AS VARCHAR), CAST(greatest(5, length(CAST(sid AS VARCHAR))) AS INTEGER), '0') AS segment_id,
      CAST(row_number() OVER (PARTITION BY video_id, sid ORDER BY widx) - 1 AS INTEGER) AS pos, "start" - b AS "start", "end" - b AS "end", text, speaker FROM s""")
def transcript(spark: SparkSession, sf: str) -> DataFrame:
    return browse.transcript(_documents(spark, sf))


@query(_sentence_words() + """ SELECT CAST(g.video_id AS VARCHAR) || '_' || lpad(CAST(sid AS VARCHAR), CAST(greatest(5, length(CAST(sid AS VARCHAR))) AS INTEGER), '0') AS segment_id,
      any_value(d.source || '/' || d.lang) AS source_url, max(g."end") - min(g."start") AS duration FROM g JOIN documents d ON d.doc_id = g.video_id GROUP BY g.video_id, sid""")
def segments_with_source(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("segment_id", "source_url", "duration")


@query(f"""SELECT segment_id, segment_id || '  |  ' || {_UNKNOWN} || '  |  ' || printf('%.1f', duration) || 's' ||
    CASE WHEN ovr IS NULL THEN '' ELSE ', dnsmos=' || printf('%.2f', ovr) END AS label FROM {_SEGMENTS}""")
def segment_label(spark: SparkSession, sf: str) -> DataFrame:
    return browse.labelled(_segments(spark, sf).withColumnRenamed("ovr", "dnsmos_ovr")).select("segment_id", "label")


@query(f"""SELECT segment_id, '**' || segment_id || '**' || '  ' || chr(10) || 'video: `' || CAST(video_id AS VARCHAR) || '`' || '  ' || chr(10)
    || 'speaker: `' || {_UNKNOWN} || '`' || '  ' || chr(10) || 'duration: ' || printf('%.2f', duration) || 's'
    || CASE WHEN ovr IS NULL THEN '' ELSE '  ' || chr(10) || 'dnsmos_ovr: ' || printf('%.2f', ovr) END
    || CASE WHEN coalesce(language, '') = '' THEN '' ELSE '  ' || chr(10) || 'language: ' || language END
    || CASE WHEN exceeds_max_duration THEN '  ' || chr(10) || '**exceeds_max_duration**' ELSE '' END AS info FROM {_SEGMENTS}""")
def segment_info(spark: SparkSession, sf: str) -> DataFrame:
    docs = _segments(spark, sf).withColumnRenamed("ovr", "dnsmos_ovr").withColumn("video_id", F.col("video_id").cast("string"))
    return browse.with_info(docs).select("segment_id", "info")


@query(f"SELECT segment_id FROM {_SEGMENTS} WHERE {_UNKNOWN} = 'UNKNOWN'")
def segment_choices(spark: SparkSession, sf: str) -> DataFrame:
    docs = _segments(spark, sf).withColumnRenamed("ovr", "dnsmos_ovr")
    return browse.choices(docs, "All", "UNKNOWN").select("segment_id")


@query(f"""SELECT DISTINCT 'video' AS facet, CAST(video_id AS VARCHAR) AS value FROM {_SEGMENTS} UNION SELECT 'speaker', {_UNKNOWN} FROM {_SEGMENTS}
    UNION SELECT 'video', 'All' UNION SELECT 'speaker', 'All'""")
def facet_choices(spark: SparkSession, sf: str) -> DataFrame:
    return browse.facets(_segments(spark, sf))


@query(f"SELECT segment_id, CASE WHEN idx % 4 > 0 THEN 'media/' || segment_id || '.flac' END AS audio_path FROM {_SEGMENTS}")
def audio_path_for(spark: SparkSession, sf: str) -> DataFrame:
    docs = _segments(spark, sf)
    named = lambda ext: docs.select(F.concat(F.lit("media/"), "segment_id", F.lit(ext)).alias("path"))
    audio = docs.where("idx % 4 > 0").select(F.concat(F.lit("media/"), "segment_id", F.lit(".flac")).alias("path"))
    return browse.audio_path_for(docs.select("segment_id"), named(".json").unionByName(audio))


@query(f"SELECT {_UNKNOWN} AS speaker, count(*) AS segments, CAST(sum(\"end\" - \"start\") AS BIGINT) AS duration FROM {_SEGMENTS} GROUP BY 1")
def speaker_stats(spark: SparkSession, sf: str) -> DataFrame:
    return package.speaker_stats(_segments(spark, sf).withColumn("duration", F.col("end") - F.col("start")))


@query(f"""SELECT count(*) AS num_segments, count(DISTINCT video_id) + coalesce(max(CASE WHEN video_id IS NULL THEN 1 ELSE 0 END), 0) AS num_videos,
    count(DISTINCT {_UNKNOWN}) AS num_speakers, CAST(coalesce(sum("end" - "start"), 0) AS BIGINT) AS total_duration FROM {_SEGMENTS}""")
def dataset_totals(spark: SparkSession, sf: str) -> DataFrame:
    return package.dataset_totals(_segments(spark, sf).withColumn("duration", F.col("end") - F.col("start")))


@query(f"SELECT {_UNKNOWN} AS speaker, count(*) AS segments, CAST(sum(\"end\" - \"start\") AS BIGINT) / 3600.0::DOUBLE AS hours FROM {_SEGMENTS} GROUP BY 1")
def speaker_hours(spark: SparkSession, sf: str) -> DataFrame:
    return package.speaker_hours(_segments(spark, sf).withColumn("duration", F.col("end") - F.col("start")), "idx")


@query(f"SELECT segment_id, {_UNKNOWN} IN ('SPK_0', 'UNKNOWN') AS kept FROM {_SEGMENTS}")
def filter_speakers(spark: SparkSession, sf: str) -> DataFrame:
    kept, removed = package.kept_speakers(_segments(spark, sf), ["SPK_0", "UNKNOWN"])
    mark = lambda df, v: df.select("segment_id", F.lit(v).alias("kept"))
    return mark(kept, True).unionByName(mark(removed, False))


@query("SELECT event_id, CAST(trunc(CASE event_type WHEN 'purchase' THEN 60000000.0 WHEN 'click' THEN 3000000.0 ELSE 0 END * greatest(event_id % 50 - 5, 0)) AS BIGINT) AS cost FROM events")
def estimate_cost(spark: SparkSession, sf: str) -> DataFrame:
    cost = cost_of(F.col("event_type"), F.col("event_id") % 50 - 5, {"purchase": 6e7, "click": 3e6})
    return fx.table(spark, sf, "events").select("event_id", cost.alias("cost"))


# job state: orders are videos, their lines chunks

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'PENDING' ELSE 'RUNNING' END"
_LINE = "CASE l_linestatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'DONE' ELSE 'RUNNING' END END"


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS video_id", f"{_STATUS} AS status", "CAST(o_custkey AS STRING) AS channel", "CAST(o_orderdate AS TIMESTAMP) AS updated_at"
    )


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "lineitem").selectExpr("l_orderkey AS video_id", "CAST(l_linenumber AS INT) AS idx", f"{_LINE} AS status")


@query(f"SELECT video_id, status FROM (SELECT o_orderkey AS video_id, {_STATUS} AS status FROM orders) WHERE status = 'RUNNING'")
def list_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return jobstore.by_status(_videos(spark, sf), "RUNNING").select("video_id", "status")


_COUNTS = ", ".join(f"count(*) FILTER (status = '{s}') AS \"{s}\"" for s in jobstore.STATUSES)


@query(f"""SELECT table_name, {_COUNTS} FROM (SELECT 'videos' AS table_name, {_STATUS} AS status FROM orders UNION ALL SELECT 'superchunks', {_LINE} FROM lineitem) GROUP BY 1""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return jobstore.status_counts({"videos": _videos(spark, sf), "superchunks": _chunks(spark, sf)})


@query(f"SELECT l_orderkey AS video_id, bool_and(coalesce({_LINE} = 'DONE', false)) AS ready FROM lineitem GROUP BY 1")
def rechunk_barrier(spark: SparkSession, sf: str) -> DataFrame:
    return jobstore.all_done(_chunks(spark, sf))


@query(f"""SELECT o_orderkey AS video_id, {_STATUS} AS status FROM orders
    UNION ALL SELECT DISTINCT user_id * 7, 'PENDING' FROM events WHERE user_id IS NOT NULL AND user_id * 7 NOT IN (SELECT o_orderkey FROM orders)""")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    new = fx.table(spark, sf, "events").where("user_id is not null").selectExpr("user_id * 7 AS video_id", "'PENDING' AS status", "event_id AS at")
    return jobstore.insert_if_absent(_videos(spark, sf).select("video_id", "status"), new, ["video_id"], "at")


@query(f"""SELECT o_orderkey AS video_id, CASE WHEN c_custkey IS NOT NULL AND o_custkey % 2 = 0 THEN 'FAILED' ELSE {_STATUS} END AS status,
    CASE WHEN c_custkey IS NOT NULL AND o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS channel
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal < 0""")
def partial_update(spark: SparkSession, sf: str) -> DataFrame:
    broke = fx.table(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")
    orders = fx.table(spark, sf, "orders").join(broke, F.col("c_custkey") == F.col("o_custkey"))
    even, third = F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 3 == 0
    fields = F.array_compact(F.array(F.when(even, "status"), F.when(third, "channel")))
    changes = orders.select(F.col("o_orderkey").alias("video_id"), F.lit("FAILED").alias("status"), F.lit(None).cast("string").alias("channel"), fields.alias("set_fields"))
    return jobstore.partial_update(_videos(spark, sf).drop("updated_at"), changes, ["video_id"])


@query(f"""SELECT o_orderkey AS video_id, CASE WHEN {_STATUS} = 'RUNNING' AND CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '1998-01-01' - INTERVAL 30 DAY THEN 'PENDING' ELSE {_STATUS} END AS status FROM orders""")
def recover_stale(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("1998-01-01").cast("timestamp")
    return jobstore.recover_stale(_videos(spark, sf), now, 30 * 86_400).select("video_id", "status")


@query(f"SELECT o_orderkey AS video_id, {_STATUS} AS status FROM orders WHERE o_orderkey <> 7")
def reset_video(spark: SparkSession, sf: str) -> DataFrame:
    return jobstore.without_video(_videos(spark, sf), 7).select("video_id", "status")


@query("""SELECT 'videos' AS table_name, count(*) AS removed FROM orders WHERE o_orderkey = 7 UNION ALL SELECT 'superchunks', count(*) FROM lineitem WHERE l_orderkey = 7""")
def reset_counts(spark: SparkSession, sf: str) -> DataFrame:
    gone = lambda name, df: df.where("video_id = 7").agg(F.lit(name).alias("table_name"), F.count("*").alias("removed"))
    return gone("videos", _videos(spark, sf)).unionByName(gone("superchunks", _chunks(spark, sf)))
