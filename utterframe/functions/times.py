"""Expressions on time spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iou(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Intersection over union of two spans, 0 where the union is empty."""
    inter = F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))
    union = F.greatest(a_end, b_end) - F.least(a_start, b_start)
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def edge_distance(start: Column, end: Column, chunk_start: Column, chunk_end: Column) -> Column:
    """How far a word lies from its chunk's nearer edge; negative outside."""
    return F.least(start - chunk_start, chunk_end - end)


def intersects(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Whether two spans share more than a point."""
    return (a_start < b_end) & (b_start < a_end)


def clip_words(words: Column, clip_start: Column) -> Column:
    """Each word with clip_start and clip_end, its times from the clip's start on."""
    return F.transform(words, lambda w: w.withField("clip_start", w["start"] - clip_start).withField("clip_end", w["end"] - clip_start))


def timed(words: Column) -> Column:
    """The words that have both times, their texts stripped, '' for null."""
    from utterframe.functions.text import strip

    kept = F.filter(words, lambda w: w["start"].isNotNull() & w["end"].isNotNull())
    return F.transform(kept, lambda w: w.withField("text", strip(F.coalesce(w["text"], F.lit("")))))


def window_starts(length: Column, window: int, hop: int) -> Column:
    """Starts of the windows that lie within a clip padded to one window at least."""
    return F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), length.cast("long") - window), F.lit(hop).cast("long"))
