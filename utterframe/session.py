"""What sessions need."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ensure_importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it lies in a folder instead of being installed."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join(p for p in [ROOT, *paths] if p)
    return spark
