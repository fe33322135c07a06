"""Global row numbers without a single task that sees all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a range of the order, ranges at most, and sampled keys to a range.
RANGE_ROWS, MOST_RANGES, SAMPLED = 5000, 1 << 16, 8


def range_of(key: Column, bounds: list, kind: str) -> Column:
    """How many of the sorted bounds are at most the key: first among every w-th of them, then within that stretch."""
    if not bounds:
        return F.lit(0)
    width = max(1, math.isqrt(len(bounds)))
    as_array = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    upto = lambda values: F.size(F.filter(values, lambda b: b <= key))
    stretches = F.array(*[as_array(bounds[i : i + width]) for i in range(0, len(bounds), width)])
    group = F.greatest(upto(as_array(bounds[::width])) - 1, F.lit(0))
    within = lambda g: g * width + upto(F.get(stretches, g))
    return F.get(F.transform(F.array(group), within), F.lit(0))


def numbered(df: DataFrame, key: str, ties: tuple[str, ...] = (), alias: str = "no") -> DataFrame:
    """Adds the rows' numbers by (key, ties), from 1; null keys come first.

    A sample of keys, chosen by hash and as large as the ranges need, cuts the order into ranges of about RANGE_ROWS
    rows; each range counts its rows, and its numbers start after all before it.
    """
    rows = df.count()
    ranges = max(1, min(rows // RANGE_ROWS, MOST_RANGES))
    bounds: list = []
    if ranges > 1:
        place = F.shiftrightunsigned(F.xxhash64(key), 11) / F.lit(2.0**53)
        sample = df.select(key).where(F.col(key).isNotNull() & (place < SAMPLED * ranges / rows)).distinct().collect()
        bounds = sorted(r[0] for r in sample)[SAMPLED // 2 :: SAMPLED]
    part = F.when(F.col(key).isNull(), -1).otherwise(range_of(F.col(key), bounds, df.schema[key].dataType.simpleString()))
    dealt = df.withColumn("__part", part)
    counts = {r["__part"]: r["n"] for r in dealt.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # MOST_RANGES + 2 at most
    offsets, before = [], 0
    for p in sorted(counts):
        offsets.append((p, before))
        before += counts[p]
    starts = df.sparkSession.createDataFrame(offsets, "__part int, __before long")
    within = F.row_number().over(Window.partitionBy("__part").orderBy(key, *ties))
    return dealt.join(F.broadcast(starts), "__part").withColumn(alias, F.col("__before") + within).drop("__part", "__before")
