"""Browsing packaged segments: labels, facets, transcripts, spans of cross-talk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from utterframe.functions.text import fixed, or_unknown


def labelled(docs: DataFrame) -> DataFrame:
    """Adds label: id, speaker, seconds and, if known, score."""
    score = F.when(F.col("dnsmos_ovr").isNotNull(), F.concat(F.lit(", dnsmos="), fixed(F.col("dnsmos_ovr"), 2))).otherwise("")
    parts = F.concat_ws("  |  ", "segment_id", or_unknown(F.col("speaker")), F.concat(fixed(F.col("duration"), 1), F.lit("s")))
    return docs.withColumn("label", F.concat(parts, score))


def with_info(docs: DataFrame) -> DataFrame:
    """Adds info: what is known of a segment, an item a line, in Markdown."""
    marked = lambda name, value: F.concat(F.lit(f"{name}: `"), value, F.lit("`"))
    return docs.withColumn("info", F.concat_ws(
        "  \n", F.concat(F.lit("**"), F.col("segment_id"), F.lit("**")), marked("video", F.col("video_id")),
        marked("speaker", or_unknown(F.col("speaker"))), F.concat(F.lit("duration: "), fixed(F.col("duration"), 2), F.lit("s")),
        F.when(F.col("dnsmos_ovr").isNotNull(), F.concat(F.lit("dnsmos_ovr: "), fixed(F.col("dnsmos_ovr"), 2))),
        F.when(F.col("language") != "", F.concat(F.lit("language: "), F.col("language"))),
        F.when(F.col("exceeds_max_duration"), F.lit("**exceeds_max_duration**")),
    ))


def choices(docs: DataFrame, video: str | None = None, speaker: str | None = None) -> DataFrame:
    """label, segment_id of the segments of a video and speaker (None or "All": any), by segment_id."""
    found = docs
    if video not in (None, "All"):
        found = found.where(F.col("video_id") == video)
    if speaker not in (None, "All"):
        found = found.where(or_unknown(F.col("speaker")) == speaker)
    return labelled(found).orderBy("segment_id").select("label", "segment_id")


def facets(docs: DataFrame) -> DataFrame:
    """facet, value: "All" and each distinct video and speaker."""
    one = lambda name, value: docs.select(F.lit(name).alias("facet"), value.alias("value")).distinct()
    both = one("video", F.col("video_id").cast("string")).unionByName(one("speaker", or_unknown(F.col("speaker"))))
    everything = docs.sparkSession.createDataFrame([("video", "All"), ("speaker", "All")], "facet string, value string")
    return everything.unionByName(both).distinct()


def transcript(docs: DataFrame) -> DataFrame:
    """Each word of a segment in clip time, with its own speaker or the segment's."""
    word = docs.select("segment_id", "speaker", F.posexplode("words").alias("pos", "w"))
    return word.select(
        "segment_id", "pos", F.col("w.clip_start").alias("start"), F.col("w.clip_end").alias("end"), F.col("w.text").alias("text"),
        F.coalesce(F.nullif(F.col("w.speaker"), F.lit("")), F.col("speaker")).alias("speaker"),
    )


def overlap_ranges(words: DataFrame, by: list[str], order: str) -> DataFrame:
    """by, start, end: runs of consecutive words flagged as cross-talk."""
    w = Window.partitionBy(*by).orderBy(order)
    new = F.col("overlap") & ~F.coalesce(F.lag("overlap").over(w), F.lit(False))
    run = F.sum(new.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    flagged = words.withColumn("run", run).where("overlap")
    return flagged.groupBy(*by, "run").agg(F.min_by("start", order).alias("start"), F.max_by("end", order).alias("end"))


def audio_path_for(docs: DataFrame, files: DataFrame) -> DataFrame:
    """Adds audio_path: the first file named after the segment that isn't its document."""
    stem = F.regexp_extract("path", r"([^/]+?)\.[^./]*$", 1)
    audio = files.where(~F.lower("path").endswith(".json")).groupBy(stem.alias("segment_id")).agg(F.min("path").alias("audio_path"))
    return docs.join(audio, "segment_id", "left")
