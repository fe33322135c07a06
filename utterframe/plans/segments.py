"""Queries on sources, words, speech regions, turns and segments, over whole tables, and their DuckDB SQL.

Times are whole milliseconds, so that results compare exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterframe import fixtures as fx
from utterframe.functions import text as tx
from utterframe.functions import times as tm
from utterframe.operators import browse, jobstore, package, rechunk, turns, vad
from utterframe.plans.registry import query
from utterframe.sources import media

CAP, GAP, LONGEST, SHORTEST, SEAM = 90_000, 250, 20_000, 2_000, 2_500


# sources


@query(r"""SELECT page_id, CASE WHEN regexp_full_match(url, '[a-z]{11}') THEN url
    ELSE nullif(regexp_extract(url, '(?:/en/|/de/|/fr/|/es/)([0-9]+)', 1), '') END AS video_id FROM pages""")
def video_id_extract(spark: SparkSession, sf: str) -> DataFrame:
    found = media.video_id(F.col("url"), r"^[a-z]{11}$", r"(?:/en/|/de/|/fr/|/es/)([0-9]+)")
    return fx.table(spark, sf, "pages").select("page_id", found.alias("video_id"))


@query("SELECT DISTINCT source AS channel, concat('listed-', source) AS video_id, 'https://www.youtube.com/watch?v=listed-' || source AS url FROM documents WHERE source IS NOT NULL")
def discover_union(spark: SparkSession, sf: str) -> DataFrame:
    channels = fx.table(spark, sf, "documents").where("source is not null").select(F.col("source").alias("channel")).distinct()
    return media.discover(channels, lambda c: [f"listed-{c}", " "]).where("error is null").select("channel", "video_id", "url")


@query("""SELECT CASE WHEN regexp_full_match(url, '[A-Za-z0-9_-]{11}') THEN url ELSE nullif(regexp_extract(url, '(?:v=|youtu\\.be/|/shorts/)([A-Za-z0-9_-]{11})', 1), '') END AS video_id,
    url, CAST(0 AS INTEGER) AS source_rank FROM pages
    UNION ALL SELECT DISTINCT 'of-' || source, 'https://www.youtube.com/watch?v=of-' || source, 1 FROM documents WHERE source IS NOT NULL""")
def discover_sources(spark: SparkSession, sf: str) -> DataFrame:
    channels = fx.table(spark, sf, "documents").where("source is not null").select(F.col("source").alias("channel")).distinct()
    both = media.discover_sources(fx.table(spark, sf, "pages").select("url"), channels, lambda c: [f"of-{c}"])
    return both.select("video_id", "url", "source_rank")


@query("SELECT event_id, TRY_CAST(trim(CASE WHEN event_id % 7 = 0 THEN 'N/A' ELSE ' ' || CAST(event_id * 250 AS VARCHAR) || ' ' END) AS DOUBLE) AS duration_s FROM events")
def probe_duration_parse(spark: SparkSession, sf: str) -> DataFrame:
    printed = F.when(F.col("event_id") % 7 == 0, "N/A").otherwise(F.concat(F.lit(" "), (F.col("event_id") * 250).cast("string"), F.lit(" ")))
    return fx.table(spark, sf, "events").select("event_id", media.parse_duration(printed).alias("duration_s"))


@query("SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '[^/]\\.html$')")
def scan_local(spark: SparkSession, sf: str) -> DataFrame:
    return media.audio_files(fx.table(spark, sf, "pages").select("page_id", "url"), "url", (".html",))


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'PENDING' ELSE 'RUNNING' END"


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as videos."""
    return fx.table(spark, sf, "orders").selectExpr("o_orderkey AS video_id", f"{_STATUS} AS status", "CAST(o_custkey AS STRING) AS channel")


@query(f"""WITH v AS (SELECT o_orderkey AS video_id, {_STATUS} AS status FROM orders)
    SELECT video_id, CAST(0 AS INTEGER) AS rank FROM v WHERE status = 'PENDING'
    UNION ALL SELECT DISTINCT e.user_id * 7, 1 FROM events e WHERE e.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v WHERE v.video_id = e.user_id * 7)""")
def pending_and_fresh(spark: SparkSession, sf: str) -> DataFrame:
    seen = fx.table(spark, sf, "events").where("user_id is not null").selectExpr("user_id * 7 AS video_id", "event_id AS at")
    return jobstore.pending_and_fresh(_videos(spark, sf).select("video_id", "status"), seen, "at").select("video_id", "rank")


@query("""SELECT video_id, ridx, concat_ws(' ', 'ffmpeg -y -ss', printf('%.3f', "start"/1000.0), '-to', printf('%.3f', "end"/1000.0),
    '-i in.wav -ar 22050 -f flac', CAST(ridx AS VARCHAR) || '.flac') AS command FROM """ + fx.REGIONS_SQL)
def slice_args(spark: SparkSession, sf: str) -> DataFrame:
    out = F.concat(F.col("ridx").cast("string"), F.lit(".flac"))
    args = package.slice_arguments(F.lit("in.wav"), out, F.col("start") / 1000.0, F.col("end") / 1000.0, fmt="flac", rate=22050)
    return fx.regions(spark, sf).select("video_id", "ridx", F.array_join(args, " ").alias("command"))


# words


@query("""SELECT w.video_id, w.widx, w.start + w.video_id % 5 * 90000 AS "start", w."end" + w.video_id % 5 * 90000 AS "end", false AS overlap FROM """ + fx.WORDS_SQL + " w")
def time_shift(spark: SparkSession, sf: str) -> DataFrame:
    words = fx.words(spark, sf, by_video=True).withColumn("chunk_idx", F.lit(0))
    chunks = fx.table(spark, sf, "documents").selectExpr("doc_id AS video_id", "0 AS idx", "doc_id % 5 * 90000 AS start")
    return turns.shift_to_video(words, chunks).select("video_id", "widx", "start", "end", "overlap")


@query("SELECT doc_id, lower(regexp_replace(text, '[^\\p{L}\\p{N}_]', '', 'g')) AS normalized FROM documents")
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents").select("doc_id", tx.normalize(F.col("text")).alias("normalized"))


_PAIRS = """(SELECT video_id, ridx, "start" s, "end" e, lead("start") OVER p ns, lead("end") OVER p ne FROM """ + fx.REGIONS_SQL + ' WINDOW p AS (PARTITION BY video_id ORDER BY "start", ridx))'


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("video_id").orderBy("start", "ridx")
    return fx.regions(spark, sf).withColumns({"ns": F.lead("start").over(w), "ne": F.lead("end").over(w)}).where("ns is not null")


@query(f"""SELECT video_id, ridx, CASE WHEN greatest(e, ne) - least(s, ns) > 0
    THEN greatest(0, least(e, ne) - greatest(s, ns)) / CAST(greatest(e, ne) - least(s, ns) AS DOUBLE) ELSE 0.0 END AS iou FROM {_PAIRS} WHERE ns IS NOT NULL""")
def iou_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).select("video_id", "ridx", tm.iou(F.col("start"), F.col("end"), F.col("ns"), F.col("ne")).alias("iou"))


@query("SELECT video_id, widx, least(w.start - w.start//90000*90000, (w.start//90000+1)*90000 - w.\"end\") AS edge_dist FROM " + fx.WORDS_SQL + " w")
def edge_distance(spark: SparkSession, sf: str) -> DataFrame:
    begin = F.expr("start div 90000 * 90000")
    return fx.words(spark, sf).select("video_id", "widx", tm.edge_distance(F.col("start"), F.col("end"), begin, begin + 90000).alias("edge_dist"))


@query("SELECT video_id, widx, right(text, 1) IN ('.','!','?','。','…','؟','।') AS ends FROM " + fx.WORDS_SQL)
def punct_boundary(spark: SparkSession, sf: str) -> DataFrame:
    return fx.words(spark, sf).select("video_id", "widx", tx.ends_sentence(F.col("text")).alias("ends"))


@query("SELECT event_id, CAST(user_id AS VARCHAR) || '_' || CASE WHEN event_id * 37 < 100000 THEN lpad(CAST(event_id * 37 AS VARCHAR), 5, '0') ELSE CAST(event_id * 37 AS VARCHAR) END AS segment_id FROM events")
def segment_ids(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "events").select("event_id", tx.segment_id(F.col("user_id"), F.col("event_id") * 37).alias("segment_id"))


def _with_holes(spark: SparkSession, sf: str) -> DataFrame:
    word = "struct(CASE WHEN widx % 11 = 0 THEN NULL ELSE concat(' ', text) END AS text, CASE WHEN widx % 5 = 0 THEN NULL ELSE start END AS start, end AS end, widx AS widx)"
    return fx.words(spark, sf, by_video=True).groupBy("video_id").agg(F.array_sort(F.collect_list(F.expr(word))).alias("words"))


@query("""SELECT video_id, widx, CASE WHEN widx % 11 = 0 THEN '' ELSE text END AS text, "start", "end" FROM """ + fx.WORDS_SQL + " WHERE widx % 5 <> 0")
def drop_untimed(spark: SparkSession, sf: str) -> DataFrame:
    kept = _with_holes(spark, sf).select("video_id", F.explode(tm.timed(F.col("words"))).alias("w"))
    return kept.select("video_id", "w.widx", "w.text", "w.start", "w.end")


@query("""WITH p AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN json_object('words', json_array(json_object('text', event_type)), 'language', 'en')
      ELSE json_array(json_object('text', event_type)) END AS j FROM events)
    SELECT event_id, coalesce(j->>'$.words[0].text', j->>'$[0].text') AS first_word, j->>'$.language' AS language FROM p""")
def words_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    word = F.array(F.struct(F.col("event_type").alias("text")))
    stored = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(word.alias("words"), F.lit("en").alias("language")))).otherwise(F.to_json(word))
    parsed = fx.table(spark, sf, "events").select("event_id", turns.words_payload(stored).alias("p"))
    return parsed.select("event_id", F.get("p.words", F.lit(0))["text"].alias("first_word"), "p.language")


# voice activity

_MERGED = """WITH RECURSIVE r AS (SELECT video_id, "start" s, "end" e, row_number() OVER (PARTITION BY video_id ORDER BY "start", ridx) i FROM """ + fx.REGIONS_SQL + f"""),
  m AS (SELECT video_id, i, s, e, 0 AS c FROM r WHERE i = 1
    UNION ALL SELECT r.video_id, r.i, CASE WHEN r.e - m.s <= {CAP} THEN m.s ELSE r.s END, r.e, CASE WHEN r.e - m.s <= {CAP} THEN m.c ELSE m.c + 1 END
    FROM m JOIN r ON r.video_id = m.video_id AND r.i = m.i + 1),
  merged AS (SELECT video_id, CAST(c AS INTEGER) AS cidx, min(s) AS s, arg_max(e, i) AS e FROM m GROUP BY video_id, c)"""
_SPLIT = f"""{_MERGED}, n AS (SELECT *, CASE WHEN e - s <= {CAP} THEN 1 ELSE CAST(ceil((e - s) / {CAP}.0) AS INTEGER) END AS n FROM merged),
  split AS (SELECT video_id, cidx, CAST(piece AS INTEGER) AS piece, CASE WHEN n = 1 THEN CAST(s AS DOUBLE) ELSE s + piece * (CAST(e - s AS DOUBLE) / n) END AS s,
    CASE WHEN piece = n - 1 THEN CAST(e AS DOUBLE) ELSE s + (piece + 1) * (CAST(e - s AS DOUBLE) / n) END AS e
    FROM (SELECT *, unnest(range(n)) AS piece FROM n))"""
_PADDED = f"""{_SPLIT}, padded AS (SELECT video_id, CAST(row_number() OVER p - 1 AS INTEGER) AS idx,
    CASE WHEN lag(s) OVER p IS NULL THEN s ELSE greatest(0.0, s - {SEAM}) END AS "start",
    CASE WHEN lead(s) OVER p IS NULL THEN least(e, 4320000.0) ELSE least(4320000.0, e + {SEAM}) END AS "end"
    FROM split WINDOW p AS (PARTITION BY video_id ORDER BY cidx, piece))"""


@query(_MERGED + ' SELECT video_id, cidx, s AS "start", e AS "end" FROM merged')
def vad_merge(spark: SparkSession, sf: str) -> DataFrame:
    return vad.merge_regions(fx.regions(spark, sf), CAP)


@query(_SPLIT + ' SELECT video_id, cidx, piece, s AS "start", e AS "end" FROM split')
def vad_force_split(spark: SparkSession, sf: str) -> DataFrame:
    return vad.force_split(vad.merge_regions(fx.regions(spark, sf), CAP), CAP).select("video_id", "cidx", "piece", "start", "end")


@query(f"""SELECT video_id, ridx, CAST(CASE WHEN lag("start") OVER p IS NULL THEN "start" ELSE greatest(0.0, "start" - {SEAM}) END AS DOUBLE) AS "start",
    CAST(CASE WHEN lead("start") OVER p IS NULL THEN least("end", 4000000.0) ELSE least(4000000.0, "end" + {SEAM}) END AS DOUBLE) AS "end"
    FROM """ + fx.REGIONS_SQL + """ WINDOW p AS (PARTITION BY video_id ORDER BY "start", ridx)""")
def vad_overlap(spark: SparkSession, sf: str) -> DataFrame:
    cuts = fx.regions(spark, sf).withColumns({"start": F.col("start").cast("double"), "end": F.col("end").cast("double")})
    return vad.pad_overlap(cuts, SEAM, F.lit(4_000_000.0), ["start", "ridx"]).select("video_id", "ridx", "start", "end")


@query(_PADDED + ' SELECT video_id, idx, "start", "end" FROM padded')
def vad_superchunks(spark: SparkSession, sf: str) -> DataFrame:
    return vad.superchunks(fx.regions(spark, sf), CAP, SEAM, F.lit(4_320_000.0))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id * 2.0 WHEN event_id % 5 > 0 THEN CAST(event_id % 5 AS DOUBLE) ELSE CAST('Infinity' AS DOUBLE) END AS duration FROM events""")
def vad_duration(spark: SparkSession, sf: str) -> DataFrame:
    probed = F.when(F.col("event_id") % 3 == 0, F.col("event_id") * 2.0)
    return fx.table(spark, sf, "events").select("event_id", vad.clamp_duration(probed, F.col("event_id") % 5).alias("duration"))


# turns

_REGIONS_OF_TURNS = """WITH t AS (SELECT video_id v, tidx, "start" st, "end" en, speaker sp FROM """ + fx.TURNS_SQL + """),
  o AS (SELECT *, max(en) OVER (PARTITION BY v,sp ORDER BY st,en,tidx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) pm FROM t WHERE en>st),
  i AS (SELECT *, sum(CASE WHEN pm IS NULL OR st>pm THEN 1 ELSE 0 END) OVER (PARTITION BY v,sp ORDER BY st,en,tidx ROWS UNBOUNDED PRECEDING) g FROM o),
  m AS (SELECT v,sp,min(st) st,max(en) en FROM i GROUP BY v,sp,g),
  d AS (SELECT v,p,sum(k) k FROM (SELECT v,st p,1 k FROM m UNION ALL SELECT v,en,-1 FROM m) GROUP BY v,p),
  c AS (SELECT v,p,sum(k) OVER (PARTITION BY v ORDER BY p ROWS UNBOUNDED PRECEDING) n, lead(p) OVER (PARTITION BY v ORDER BY p) q FROM d),
  h AS (SELECT *, lag(q) OVER (PARTITION BY v ORDER BY p) pq FROM c WHERE n>=2),
  z AS (SELECT *, sum(CASE WHEN pq IS NULL OR pq<p THEN 1 ELSE 0 END) OVER (PARTITION BY v ORDER BY p ROWS UNBOUNDED PRECEDING) g FROM h),
  regions AS (SELECT v AS video_id, min(p) AS "start", max(q) AS "end" FROM z GROUP BY v, g)"""


@query(_REGIONS_OF_TURNS + " SELECT * FROM regions")
def overlap_regions(spark: SparkSession, sf: str) -> DataFrame:
    return turns.overlap_regions(fx.turns(spark, sf))


# the video is the only join key; what the spans must meet is opaque to the planner, which else picks a range join
_WORDS_AND_TURNS = "WITH w AS MATERIALIZED (SELECT * FROM " + fx.WORDS_SQL + "), t AS MATERIALIZED (SELECT * FROM " + fx.TURNS_SQL + """),
  m AS (SELECT w.video_id, w.widx, t.speaker, t.tidx, least(w."end", t."end") - greatest(w.start, t.start) AS o FROM w JOIN t ON w.video_id = t.video_id),
  best AS MATERIALIZED (SELECT video_id, widx, speaker FROM m WHERE CASE WHEN o > 0 THEN true ELSE false END
    QUALIFY row_number() OVER (PARTITION BY video_id, widx ORDER BY o DESC, tidx) = 1)"""


@query(_WORDS_AND_TURNS + " SELECT w.video_id, w.widx, b.speaker FROM w LEFT JOIN best b ON w.video_id = b.video_id AND w.widx = b.widx")
def assign_speakers(spark: SparkSession, sf: str) -> DataFrame:
    return turns.assign_speakers(fx.words(spark, sf, by_video=True), fx.turns(spark, sf)).select("video_id", "widx", "speaker")


@query(_WORDS_AND_TURNS + """, away AS (SELECT w.video_id, w.widx, t.speaker, t.tidx, abs((t.start + t."end") - (w.start + w."end")) AS d
      FROM w ANTI JOIN best USING (video_id, widx) JOIN t ON w.video_id = t.video_id),
    near AS (SELECT video_id, widx, speaker FROM away QUALIFY row_number() OVER (PARTITION BY video_id, widx ORDER BY d, tidx) = 1)
    SELECT w.video_id, w.widx, coalesce(b.speaker, n.speaker) AS speaker FROM w
    LEFT JOIN best b ON w.video_id = b.video_id AND w.widx = b.widx LEFT JOIN near n ON w.video_id = n.video_id AND w.widx = n.widx""")
def assign_speakers_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return turns.assign_speakers(fx.words(spark, sf, by_video=True), fx.turns(spark, sf), fill_nearest=True).select("video_id", "widx", "speaker")


@query(_REGIONS_OF_TURNS + """ SELECT w.video_id, w.widx, EXISTS (SELECT 1 FROM regions r WHERE r.video_id = w.video_id AND w.start < r."end" AND r.start < w."end") AS overlap FROM """ + fx.WORDS_SQL + " w")
def word_overlap_flag(spark: SparkSession, sf: str) -> DataFrame:
    regions = turns.overlap_regions(fx.turns(spark, sf))
    return turns.flag_overlap(fx.words(spark, sf, by_video=True), regions).select("video_id", "widx", "overlap")


# segments


def _chunked(spark: SparkSession, sf: str) -> DataFrame:
    """Words in chunks of 90 s, padded by 2.5 s on both sides; odd chunks hear them some ms late."""
    at = fx.words(spark, sf, by_video=True).withColumn("chunk_idx", F.explode(F.expr(
        f"sequence(greatest(0, (start - {SEAM}) div {CAP}), (end + {SEAM}) div {CAP})"
    ).cast("array<int>")))
    late = F.col("chunk_idx") % 2 * (F.col("widx") % 40)
    begin = F.greatest(F.lit(0), F.col("chunk_idx").cast("long") * CAP - SEAM)
    heard = at.withColumns({"chunk_start": begin, "chunk_end": (F.col("chunk_idx").cast("long") + 1) * CAP + SEAM})
    inside = heard.where((F.col("start") >= F.col("chunk_start")) & (F.col("end") <= F.col("chunk_end")))
    return inside.withColumns({"start": F.col("start") + late, "end": F.col("end") + late, "overlap": F.lit(False)})


_CHUNKED = f"""WITH w AS MATERIALIZED (SELECT * FROM {fx.WORDS_SQL}),
  c AS (SELECT w.*, CAST(unnest(range(greatest(0, (w.start - {SEAM})//{CAP}), (w."end" + {SEAM})//{CAP} + 1)) AS INTEGER) AS chunk_idx FROM w),
  h AS (SELECT *, greatest(0, chunk_idx*{CAP} - {SEAM}) AS chunk_start, (chunk_idx+1)*{CAP} + {SEAM} AS chunk_end FROM c),
  k AS MATERIALIZED (SELECT video_id, widx, text, speaker, lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}_]', '', 'g')) AS form, chunk_idx, chunk_start, chunk_end,
      h.start + chunk_idx % 2 * (widx % 40) AS s, h."end" + chunk_idx % 2 * (widx % 40) AS e FROM h WHERE h.start >= chunk_start AND h."end" <= chunk_end),
  lead_in AS MATERIALIZED (SELECT *, chunk_idx + 1 AS following FROM k WHERE e > (chunk_idx+1)*{CAP} - {SEAM}),
  later AS MATERIALIZED (SELECT * FROM k WHERE s < chunk_idx*{CAP} + {SEAM}),
  met AS (SELECT a.video_id, a.chunk_idx ca, a.widx wa, b.chunk_idx cb, b.widx wb,
      least(a.s - a.chunk_start, a.chunk_end - a.e) >= least(b.s - b.chunk_start, b.chunk_end - b.e) AS first_stays,
      greatest(0, least(a.e, b.e) - greatest(a.s, b.s)) / CAST(greatest(a.e, b.e) - least(a.s, b.s) AS DOUBLE) AS iou
    FROM lead_in a JOIN later b ON a.video_id = b.video_id AND b.chunk_idx = a.following AND a.form = b.form),
  pair AS (SELECT * FROM met WHERE CASE WHEN iou > 0.4 THEN true ELSE false END),
  gone AS MATERIALIZED (SELECT video_id, CASE WHEN first_stays THEN cb ELSE ca END AS chunk_idx, CASE WHEN first_stays THEN wb ELSE wa END AS widx FROM pair),
  merged AS MATERIALIZED (SELECT k.* FROM k ANTI JOIN gone USING (video_id, chunk_idx, widx))"""


@query(_CHUNKED + ' SELECT video_id, chunk_idx, text, s AS "start", e AS "end" FROM merged')
def dedup_seams(spark: SparkSession, sf: str) -> DataFrame:
    return rechunk.merge_superchunks(_chunked(spark, sf).drop("speaker", "overlap")).select("video_id", "chunk_idx", "text", "start", "end")


@query(_CHUNKED + """ SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY s, e) - 1 AS INTEGER) AS widx, text, s AS "start", e AS "end" FROM merged""")
def merge_superchunks(spark: SparkSession, sf: str) -> DataFrame:
    return rechunk.merge_superchunks(_chunked(spark, sf).drop("speaker", "overlap")).select("video_id", "widx", "text", "start", "end")


_SENTENCES = f"""WITH l AS (SELECT *, lead("start") OVER p nx, lead(speaker) OVER p ns FROM {fx.WORDS_SQL} WINDOW p AS (PARTITION BY video_id ORDER BY widx)),
  b AS (SELECT *, right(text,1) IN ('.','!','?','。','…','؟','।') OR nx IS NULL OR nx-"end">={GAP} OR coalesce(speaker<>ns, false) AS boundary FROM l),
  g AS (SELECT *, CAST(coalesce(sum(CAST(boundary AS INTEGER)) OVER (PARTITION BY video_id ORDER BY widx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) sid FROM b)"""


def _numbered(spark: SparkSession, sf: str, by_speaker: bool = True) -> DataFrame:
    words = fx.words(spark, sf, by_video=True).withColumn("overlap", F.col("widx") % 97 == 0)
    return rechunk.number_sentences(rechunk.mark_boundaries(words, gap=GAP, split_on_speaker=by_speaker))


@query(_SENTENCES + " SELECT video_id, widx, boundary FROM g")
def boundaries(spark: SparkSession, sf: str) -> DataFrame:
    return _numbered(spark, sf).select("video_id", "widx", "boundary")


@query(_SENTENCES + ' SELECT video_id, sid, count(*) n_words, min("start") AS "start", max("end") AS "end" FROM g GROUP BY video_id, sid')
def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return rechunk.sentences(_numbered(spark, sf)).select("video_id", "sid", "n_words", "start", "end")


_PLAIN = _SENTENCES.replace(" OR coalesce(speaker<>ns, false)", "").replace("WITH l", "WITH RECURSIVE l")
_PACKED = _PLAIN + f""", se AS (SELECT video_id, sid, arg_min("start", widx) s, arg_max("end", widx) e, row_number() OVER (PARTITION BY video_id ORDER BY sid) i FROM g GROUP BY video_id, sid),
  pk AS (SELECT video_id, i, sid, s AS cs, e, 0 AS seg FROM se WHERE i = 1
    UNION ALL SELECT se.video_id, se.i, se.sid, CASE WHEN se.e - pk.cs > {LONGEST} THEN se.s ELSE pk.cs END, se.e, CASE WHEN se.e - pk.cs > {LONGEST} THEN pk.seg + 1 ELSE pk.seg END
    FROM pk JOIN se ON se.video_id = pk.video_id AND se.i = pk.i + 1)"""


@query(_PACKED + " SELECT video_id, sid, CAST(seg AS INTEGER) AS seg FROM pk")
def pack_sentences(spark: SparkSession, sf: str) -> DataFrame:
    sents = rechunk.spans(_numbered(spark, sf, False))
    return rechunk.pack_sentences(sents, longest=LONGEST, split_on_speaker=False)


# a state per packed segment: the kept segment that may still grow (ls, le), and the held one (hs, he)
_MIN = _PACKED + f""", sg AS (SELECT video_id, seg, min(cs) s, arg_max(e, i) e, count(*) OVER (PARTITION BY video_id) n FROM pk GROUP BY video_id, seg),
  f AS (SELECT video_id, 0 AS k, n, CAST(NULL AS BIGINT) AS ls, CAST(NULL AS BIGINT) AS le, s AS hs, e AS he, 0 AS out FROM sg WHERE seg = 0
    UNION ALL SELECT f.video_id, f.k + 1, f.n,
      CASE WHEN back THEN f.ls WHEN fwd THEN f.ls ELSE f.hs END, CASE WHEN back THEN f.he WHEN fwd THEN f.le ELSE f.he END,
      CASE WHEN NOT back AND fwd THEN f.hs ELSE ns END, ne, CASE WHEN back OR fwd THEN f.out ELSE f.out + 1 END
    FROM (SELECT f.*, sg.s AS ns, sg.e AS ne, f.n > 1 AND f.he - f.hs < {SHORTEST} AND f.ls IS NOT NULL AND f.he - f.ls <= {LONGEST} AS back,
            f.n > 1 AND f.he - f.hs < {SHORTEST} AND sg.e IS NOT NULL AND sg.e - f.hs <= {LONGEST} AS fwd
          FROM f LEFT JOIN sg ON sg.video_id = f.video_id AND sg.seg = f.k + 1 WHERE f.k < f.n) f),
  ends AS (SELECT video_id, ls, max(le) AS le FROM f WHERE ls IS NOT NULL GROUP BY video_id, ls)"""


@query(_MIN + ' SELECT video_id, ls AS "start", le AS "end" FROM ends')
def min_duration(spark: SparkSession, sf: str) -> DataFrame:
    return rechunk.packed_spans(rechunk.spans(_numbered(spark, sf, False)), longest=LONGEST, shortest=SHORTEST).drop("seg")


_DOMINANT = """(SELECT video_id, {key}, arg_max(speaker, struct_pack(n := n, f := -f)) AS speaker FROM
    (SELECT video_id, {key}, speaker, count(*) n, min(widx) f FROM {src} WHERE speaker <> '' GROUP BY ALL) GROUP BY video_id, {key})"""
_BUILT = _SENTENCES + f""", s AS (SELECT video_id, sid AS seg, widx, text, "start", "end", speaker, widx % 97 = 0 AS overlap FROM g)
  SELECT s.video_id, CAST(s.seg AS BIGINT) AS idx, arg_min(s.start, widx) AS "start", arg_max(s."end", widx) AS "end", string_agg(text, ' ' ORDER BY widx) AS text,
    count(*) AS n_words, any_value(d.speaker) AS speaker, arg_max(s."end", widx) - arg_min(s.start, widx) > 1500 AS exceeds_max_duration, bool_or(overlap) AS has_overlap
  FROM s LEFT JOIN {_DOMINANT.format(key="seg", src="s")} d ON d.video_id = s.video_id AND d.seg = s.seg GROUP BY s.video_id, s.seg"""


@query(_BUILT)
def build_segments(spark: SparkSession, sf: str) -> DataFrame:
    built = rechunk.build_segments(_numbered(spark, sf).withColumnRenamed("sid", "seg"), longest=1500)
    return built.withColumn("n_words", F.size("words").cast("long")).drop("words")


@query(_CHUNKED.replace("WITH w", "WITH RECURSIVE w") + ", st AS (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY s, e) - 1 AS widx, text, s AS \"start\", e AS \"end\", '' AS speaker FROM merged), "
    + _MIN.removeprefix("WITH RECURSIVE ").replace(fx.WORDS_SQL, "st") + ' SELECT video_id, ls AS "start", le AS "end" FROM ends', name="rechunk")
def rechunk_videos(spark: SparkSession, sf: str) -> DataFrame:
    stream = rechunk.merge_superchunks(_chunked(spark, sf))
    segments = rechunk.rechunk(stream, gap=GAP, longest=LONGEST, shortest=SHORTEST, split_on_speaker=False, in_place=True)
    return segments.select("video_id", "start", "end")


# by speaker: packing knows the voice of the open segment (v); merging needs the leading voice of any run of packed
# segments that fits the cap, which is counted for all such runs beforehand
_VOICES = """(SELECT {by}, arg_max(speaker, struct_pack(n := n, f := -f)) AS v FROM
    (SELECT {by}, speaker, count(*) n, min(widx) f FROM {src} WHERE speaker <> '' GROUP BY ALL) GROUP BY {by})"""
_BY_SPEAKER = _CHUNKED.replace("WITH w", "WITH RECURSIVE w") + f""",
  st AS MATERIALIZED (SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY s, e) - 1 AS widx, text, s AS "start", e AS "end", speaker FROM merged),
  l AS (SELECT *, lead("start") OVER p nx, lead(speaker) OVER p ns FROM st WINDOW p AS (PARTITION BY video_id ORDER BY widx)),
  b AS (SELECT *, right(text,1) IN ('.','!','?','。','…','؟','।') OR nx IS NULL OR nx-"end">={GAP} OR coalesce(speaker<>ns, false) AS boundary FROM l),
  g AS MATERIALIZED (SELECT *, CAST(coalesce(sum(CAST(boundary AS INTEGER)) OVER (PARTITION BY video_id ORDER BY widx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) sid FROM b),
  sv AS ({_VOICES.format(by="video_id, sid", src="g")}),
  se AS MATERIALIZED (SELECT video_id, sid, s, e, v, row_number() OVER (PARTITION BY video_id ORDER BY sid) i
      FROM (SELECT video_id, sid, arg_min("start", widx) s, arg_max("end", widx) e FROM g GROUP BY video_id, sid) LEFT JOIN sv USING (video_id, sid)),
  pk AS (SELECT video_id, i, sid, s AS cs, e, v AS cv, 0 AS seg FROM se WHERE i = 1
    UNION ALL SELECT video_id, i, sid, CASE WHEN cut THEN s ELSE cs END, e, CASE WHEN cut OR cv IS NULL THEN v ELSE cv END, CASE WHEN cut THEN seg + 1 ELSE seg END
    FROM (SELECT se.*, pk.cs, pk.cv, pk.seg, se.e - pk.cs > {LONGEST} OR coalesce(se.v <> pk.cv, false) AS cut FROM pk JOIN se ON se.video_id = pk.video_id AND se.i = pk.i + 1)),
  ws AS MATERIALIZED (SELECT g.*, pk.seg FROM g JOIN pk USING (video_id, sid)),
  sg AS MATERIALIZED (SELECT video_id, seg, arg_min("start", widx) s, arg_max("end", widx) e, max(max(seg)) OVER (PARTITION BY video_id) + 1 AS n FROM ws GROUP BY video_id, seg),
  run AS MATERIALIZED (SELECT video_id, seg AS lo, seg AS hi, s, e FROM sg
    UNION ALL SELECT r.video_id, r.lo, r.hi + 1, r.s, sg.e FROM run r JOIN sg ON sg.video_id = r.video_id AND sg.seg = r.hi + 1 WHERE sg.e - r.s <= {LONGEST}),
  members AS (SELECT video_id, lo, hi, unnest(range(lo, hi + 1)) AS seg FROM run),
  named AS (SELECT m.video_id, m.lo, m.hi, ws.speaker, ws.widx FROM members m JOIN ws ON ws.video_id = m.video_id AND ws.seg = m.seg),
  rv AS ({_VOICES.format(by="video_id, lo, hi", src="named")}),
  rn AS MATERIALIZED (SELECT run.video_id, lo, hi, run.s, run.e, v FROM run LEFT JOIN rv USING (video_id, lo, hi)),
  f AS (SELECT video_id, 0 AS k, n, CAST(NULL AS INTEGER) AS ll, CAST(NULL AS INTEGER) AS lh, 0 AS hl, 0 AS hh FROM sg WHERE seg = 0
    UNION ALL SELECT video_id, k + 1, n, CASE WHEN back OR fwd THEN ll ELSE hl END, CASE WHEN back THEN hh WHEN fwd THEN lh ELSE hh END,
      CASE WHEN fwd AND NOT back THEN hl ELSE k + 1 END, k + 1
    FROM (SELECT f.*, f.n > 1 AND h.e - h.s < {SHORTEST} AND la.video_id IS NOT NULL AND coalesce(la.v = h.v, true) AS back,
            f.n > 1 AND h.e - h.s < {SHORTEST} AND ha.video_id IS NOT NULL AND coalesce(h.v = nx.v, true) AS fwd
          FROM (SELECT * FROM f WHERE k < n) f
          LEFT JOIN rn h ON h.video_id = f.video_id AND h.lo = f.hl AND h.hi = f.hh
          LEFT JOIN (SELECT a.video_id, a.lo, a.hi FROM rn a) lf ON lf.video_id = f.video_id AND lf.lo = f.ll AND lf.hi = f.hh
          LEFT JOIN (SELECT video_id, lo, hi, v FROM rn) la ON la.video_id = lf.video_id AND la.lo = f.ll AND la.hi = f.lh
          LEFT JOIN rn nx ON nx.video_id = f.video_id AND nx.lo = f.k + 1 AND nx.hi = f.k + 1
          LEFT JOIN rn ha ON ha.video_id = f.video_id AND ha.lo = f.hl AND ha.hi = f.k + 1) f),
  ends AS (SELECT video_id, ll AS lo, max(lh) AS hi, row_number() OVER (PARTITION BY video_id ORDER BY ll) - 1 AS idx FROM f WHERE ll IS NOT NULL GROUP BY video_id, ll),
  whole AS MATERIALIZED (SELECT ws.*, ends.idx FROM ws JOIN (SELECT video_id, idx, unnest(range(lo, hi + 1)) AS seg FROM ends) ends ON ends.video_id = ws.video_id AND ends.seg = ws.seg),
  wv AS ({_VOICES.format(by="video_id, idx", src="whole")})
  SELECT w.video_id, CAST(w.idx AS INTEGER) AS idx, arg_min(w."start", widx) AS "start", arg_max(w."end", widx) AS "end", string_agg(text, ' ' ORDER BY widx) AS text,
    any_value(wv.v) AS speaker, arg_max(w."end", widx) - arg_min(w."start", widx) > {LONGEST} AS exceeds_max_duration, false AS has_overlap
  FROM whole w LEFT JOIN wv ON wv.video_id = w.video_id AND wv.idx = w.idx GROUP BY w.video_id, w.idx"""


@query(_BY_SPEAKER)
def rechunk_by_speaker(spark: SparkSession, sf: str) -> DataFrame:
    stream = rechunk.merge_superchunks(_chunked(spark, sf))
    segments = rechunk.rechunk(stream, gap=GAP, longest=LONGEST, shortest=SHORTEST, in_place=True)
    return segments.select("video_id", "idx", "start", "end", "text", "speaker", "exceeds_max_duration", "has_overlap")


@query(f"""WITH f AS (SELECT video_id, widx, "start", "end", widx % 7 IN (1,2,5) AS o FROM {fx.WORDS_SQL}),
    n AS (SELECT *, sum(CASE WHEN o AND NOT coalesce(po, false) THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY widx ROWS UNBOUNDED PRECEDING) run
      FROM (SELECT *, lag(o) OVER (PARTITION BY video_id ORDER BY widx) po FROM f))
    SELECT video_id, arg_min("start", widx) AS "start", arg_max("end", widx) AS "end" FROM n WHERE o GROUP BY video_id, run""")
def overlap_ranges(spark: SparkSession, sf: str) -> DataFrame:
    flagged = fx.words(spark, sf, by_video=True).withColumn("overlap", (F.col("widx") % 7).isin(1, 2, 5))
    return browse.overlap_ranges(flagged, ["video_id"], "widx").select("video_id", "start", "end")


@query("SELECT video_id, speaker FROM " + _DOMINANT.replace("{key}", "1 AS k").replace("1 AS k, arg_max", "arg_max").replace("GROUP BY video_id, 1 AS k", "GROUP BY video_id").replace("{src}", fx.WORDS_SQL))
def dominant_speaker(spark: SparkSession, sf: str) -> DataFrame:
    return turns.first_seen_mode(fx.words(spark, sf), ["video_id"], "speaker", "widx", "speaker")


@query("""SELECT source, arg_max(lang, struct_pack(n := n, f := -f)) AS language FROM
    (SELECT source, lang, count(*) n, min(doc_id) f FROM documents WHERE lang <> '' GROUP BY ALL) GROUP BY source""")
def video_language(spark: SparkSession, sf: str) -> DataFrame:
    return turns.first_seen_mode(fx.table(spark, sf, "documents"), ["source"], "lang", "doc_id", "language")
