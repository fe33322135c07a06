"""Speech regions to super-chunks: capped merge, forced split, overlap padding."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterframe.operators.fold import Fold, ordered_fold


class _CappedMerge(Fold):
    """Extends the current chunk while a region ends within the cap from its start; gaps count, later ends replace."""

    def __init__(self, cap: float):
        self.cap = cap

    def start(self) -> None:
        self.idx, self.span = 0, None

    def row(self, row: dict) -> Iterator[tuple]:
        if self.span is not None and row["end"] - self.span[0] <= self.cap:
            self.span = (self.span[0], row["end"])
            return
        yield from self.end()
        self.span = (row["start"], row["end"])

    def end(self) -> Iterator[tuple]:
        if self.span is not None:
            yield (self.idx, *self.span)
            self.idx += 1


def merge_regions(regions: DataFrame, cap: float, order: list[str] | None = None) -> DataFrame:
    """video_id, cidx, start, end: greedy merge of each video's regions, in order, under a cap on the span."""
    kind = regions.schema["start"].dataType.simpleString()
    return ordered_fold(regions, "video_id", order or ["start", "ridx"], lambda: _CappedMerge(cap), f"cidx int, start {kind}, end {kind}")


def force_split(chunks: DataFrame, cap: float) -> DataFrame:
    """Chunks longer than the cap in equal pieces, the last ending where the chunk ends; no cap splits nothing."""
    span = F.col("end") - F.col("start")
    n = F.when((span <= cap) | (F.lit(cap) <= 0), 1).otherwise(F.ceil(span / F.lit(float(cap) or 1.0)).cast("int"))
    pieces = chunks.withColumn("__n", n).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    length = span / F.col("__n")
    one = F.col("__n") == 1
    start = F.when(one, F.col("start").cast("double")).otherwise(F.col("start") + F.col("piece") * length)
    end = F.when(F.col("piece") == F.col("__n") - 1, F.col("end").cast("double")).otherwise(F.col("start") + (F.col("piece") + 1) * length)
    return pieces.withColumns({"start": start, "end": end}).drop("__n")


def pad_overlap(chunks: DataFrame, overlap: float, duration: Column, order: list[str]) -> DataFrame:
    """Pads inner boundaries on both sides within [0, duration] and numbers a video's chunks: idx."""
    w = Window.partitionBy("video_id").orderBy(*order)
    first, last = F.lag("start").over(w).isNull(), F.lead("start").over(w).isNull()
    flagged = chunks.withColumns({"__first": first, "__last": last, "idx": F.row_number().over(w) - 1})
    start = F.when(F.col("__first"), F.col("start")).otherwise(F.greatest(F.lit(0.0), F.col("start") - overlap))
    end = F.when(F.col("__last"), F.least(F.col("end"), duration)).otherwise(F.least(duration, F.col("end") + overlap))
    return flagged.withColumns({"start": start, "end": end}).drop("__first", "__last")


def superchunks(regions: DataFrame, cap: float, overlap: float, duration: Column) -> DataFrame:
    """video_id, idx, start, end: merged, split and padded."""
    split = force_split(merge_regions(regions, cap), cap)
    return pad_overlap(split, overlap, duration, ["cidx", "piece"]).select("video_id", "idx", "start", "end")


def clamp_duration(probed: Column, raw: Column) -> Column:
    """The probed duration, else the listed one if positive, else no bound."""
    return F.coalesce(probed.cast("double"), F.when(raw > 0, raw.cast("double")), F.lit(float("inf")))
