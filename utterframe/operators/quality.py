"""Quality gates: ordered rejection reasons, and scores averaged over sliding windows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterframe.config import Filter
from utterframe.functions.text import fixed, quoted
from utterframe.functions.times import window_starts

#: Samples of a scoring window (9.01 s) and between windows (1 s) at 16 kHz.
WINDOW, HOP = 144_160, 16_000


def cheap_gates(segments: DataFrame, cfg: Filter) -> DataFrame:
    """Adds reason: the first gate that a segment fails without being scored, else null."""
    if not cfg.enabled:
        return segments.withColumn("reason", F.lit(None).cast("string"))
    gates = []
    if cfg.reject_overlapping_speech:
        gates.append((F.col("has_overlap"), F.lit("overlapping multi-speaker speech detected")))
    if cfg.min_duration_s is not None:
        gates.append((F.col("duration") < cfg.min_duration_s, F.concat(F.lit("duration "), fixed(F.col("duration"), 2), F.lit("s below min_duration_s"))))
    if cfg.allowed_languages:
        outside = F.col("language").isNotNull() & ~F.col("language").isin(*cfg.allowed_languages)
        gates.append((outside, F.concat(F.lit("language "), quoted(F.col("language")), F.lit(" not in allowed_languages"))))
    reason = F.lit(None).cast("string")
    for fails, text in reversed(gates):
        reason = F.when(fails, text).otherwise(reason)
    return segments.withColumn("reason", reason)


def filter_segments(segments: DataFrame, cfg: Filter, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds passed, reason, dnsmos_sig, dnsmos_bak and dnsmos_ovr.

    ``score`` adds sig, bak and ovr to the rows it is given; only those that pass the cheap gates reach it, and none
    where no threshold is set.
    """
    gated = cheap_gates(segments, cfg)
    blank = {c: F.lit(None).cast("double") for c in ("sig", "bak", "ovr")}
    if not cfg.enabled or cfg.min_dnsmos_ovr is None:
        out = gated.withColumns(blank)
    else:
        scored = score(gated.where("reason is null"))
        low = F.concat(F.lit("dnsmos_ovr "), fixed(F.col("ovr"), 2), F.lit(" below threshold"))
        verdict = F.when(F.col("ovr").isNull(), "dnsmos scoring failed").when(F.col("ovr") < cfg.min_dnsmos_ovr, low)
        out = scored.withColumn("reason", verdict).unionByName(gated.where("reason is not null").withColumns(blank))
    return out.withColumn("passed", F.col("reason").isNull()).withColumnsRenamed({c: f"dnsmos_{c}" for c in blank})


def window_mean(clips: DataFrame, samples: str, window: int, hop: int, alias: str = "mean_score") -> DataFrame:
    """Mean over sliding windows of each window's mean sample; short clips are padded with zeros to one window."""
    padded = F.concat(F.col(samples), F.array_repeat(F.lit(0).cast("float"), F.greatest(F.lit(0), F.lit(window) - F.size(samples))))
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a)
    starts = window_starts(F.size("__p"), window, hop)
    each = F.transform(starts, lambda s: mean(F.slice("__p", s.cast("int") + 1, F.lit(window))))
    return clips.withColumn("__p", padded).withColumn(alias, mean(each)).drop("__p")


def score_by_windows(clips: DataFrame, load: Callable[[], Callable], path_col: str = "audio_path") -> DataFrame:
    """Scores clips with a model that ``load`` makes once in a worker: path -> {sig, bak, ovr}, any of them None."""

    def run(batches):
        model = load()
        for pdf in batches:
            found = pd.DataFrame([model(p) for p in pdf[path_col]], columns=["sig", "bak", "ovr"], index=pdf.index)
            yield pdf.join(found.astype("float64"))

    from pyspark.sql import types as T

    added = [T.StructField(c, T.DoubleType()) for c in ("sig", "bak", "ovr")]
    return clips.mapInPandas(run, T.StructType([*clips.schema.fields, *added]))
