"""Packaging: nested segment documents, manifest and numbered listings, statistics, removal by speaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterframe.functions.text import or_unknown, segment_id
from utterframe.functions.times import clip_words
from utterframe.operators.order import numbered

DOCUMENT = (
    "segment_id string, video_id string, source_url string, start double, end double, duration double, text string, "
    "words array<struct<text:string,start:double,end:double,speaker:string,overlap:boolean,clip_start:double,clip_end:double>>, "
    "speaker string, language string, dnsmos_ovr double, exceeds_max_duration boolean, has_overlap boolean"
)


def documents(segments: DataFrame, videos: DataFrame) -> DataFrame:
    """One nested document per segment, with its source, duration and words in clip time.

    A task holds the sources of its videos, so that segments with their words pass unsorted.
    """
    source = videos.select("video_id", F.col("url").alias("source_url"))
    given = {c: F.lit(None).cast(t) for c, t in (("language", "string"), ("dnsmos_ovr", "double")) if c not in segments.columns}
    joined = segments.withColumns(given).join(source.hint("shuffle_hash"), "video_id", "left")
    return joined.select(
        segment_id(F.col("video_id"), F.col("idx")).alias("segment_id"), "video_id", "source_url", "start", "end",
        (F.col("end") - F.col("start")).alias("duration"), "text", clip_words(F.col("words"), F.col("start")).alias("words"),
        "speaker", "language", "dnsmos_ovr", "exceeds_max_duration", "has_overlap",
    )


def listing(docs: DataFrame, fmt: str) -> DataFrame:
    """no, filename, text: numbered in the order of the documents' paths."""
    return numbered(docs, "path", ("segment_id",)).select(
        "no", F.concat("segment_id", F.lit(f".{fmt}")).alias("filename"), F.coalesce("text", F.lit("")).alias("text")
    )


def manifest(docs: DataFrame) -> DataFrame:
    """The documents in the order of their paths."""
    return docs.orderBy("path")


def dataset_totals(docs: DataFrame) -> DataFrame:
    """num_segments, num_videos (rows without one count as one more), num_speakers, total_duration."""
    return docs.agg(
        F.count("*").alias("num_segments"),
        (F.count_distinct("video_id") + F.coalesce(F.max(F.col("video_id").isNull().cast("long")), F.lit(0))).alias("num_videos"),
        F.count_distinct(or_unknown(F.col("speaker"))).alias("num_speakers"),
        F.coalesce(F.sum(F.coalesce("duration", F.lit(0))), F.lit(0)).alias("total_duration"),
    )


def speaker_stats(docs: DataFrame) -> DataFrame:
    """segments and duration of each speaker, UNKNOWN for none."""
    return docs.groupBy(or_unknown(F.col("speaker")).alias("speaker")).agg(
        F.count("*").alias("segments"), F.sum(F.coalesce("duration", F.lit(0))).alias("duration")
    )


def speaker_hours(docs: DataFrame, order: str) -> DataFrame:
    """speaker, segments, hours: longest first, ties by first appearance."""
    stats = docs.groupBy(or_unknown(F.col("speaker")).alias("speaker")).agg(
        F.count("*").alias("segments"), F.sum(F.coalesce("duration", F.lit(0))).alias("duration"), F.min(order).alias("__first")
    )
    return stats.orderBy(F.desc("duration"), "__first").select("speaker", "segments", (F.col("duration") / 3600.0).alias("hours"))


def kept_speakers(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows to remove) by speaker, UNKNOWN for none."""
    wanted = or_unknown(F.col("speaker")).isin(*keep)
    return docs.where(wanted), docs.where(~wanted)


def slice_arguments(source: Column, out: Column, start: Column, end: Column, *, fmt: str, rate: int | None = None, channels: int | None = None) -> Column:
    """The slicing command's arguments: times with three decimals, rate and channels only where set."""
    from utterframe.functions.text import fixed

    extra = [F.lit(x) for x in (["-ar", str(rate)] if rate else []) + (["-ac", str(channels)] if channels else [])]
    head = [F.lit("ffmpeg"), F.lit("-y"), F.lit("-ss"), fixed(start, 3), F.lit("-to"), fixed(end, 3), F.lit("-i"), source]
    return F.array(*head, *extra, F.lit("-f"), F.lit(fmt), out)
