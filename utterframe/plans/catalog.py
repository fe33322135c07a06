"""All registered queries of the speech operators and the flagship among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from utterframe.plans import dataset, segments
from utterframe.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "dataset", "flagship", "segments"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole videos from chunk words to single-speaker segments."""
    return QUERIES["rechunk_by_speaker"](spark, sf_dir)
