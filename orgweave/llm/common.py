"""Shared plumbing of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import ready, stage

__all__ = ["fresh", "ready", "stage", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has a column so named."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name
