"""Removal of records that cannot be matched: the first reason that fits is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_generic, strip

# Bounds of a name's length, and the record type of persons.
SHORTEST, LONGEST, PERSON = 5, 200, "SPONSOR_INVESTIGATOR"


def removal_reason(name: Column, record_type: Column | None = None) -> Column:
    """Null for a record to keep. ``record_type`` adds the reason for persons, where there is such a column."""
    out = F.when(name.isNull() | (strip(name) == ""), "null_name").when(F.length(name) < SHORTEST, "short_name").when(F.length(name) > LONGEST, "long_name").when(is_generic(name), "generic_name")
    return out if record_type is None else out.when(record_type == PERSON, "person_record")


def filter_bad_records(df: DataFrame, name: str = "name", record_type: str = "rp_type") -> tuple[DataFrame, DataFrame]:
    """Kept and removed records; the removed ones carry ``_remove`` and ``_remove_reason``."""
    kind = F.col(record_type) if record_type in df.columns else None
    marked = df.withColumn("_remove_reason", removal_reason(F.col(name), kind))
    removed = marked.where(F.col("_remove_reason").isNotNull()).withColumn("_remove", F.lit(True))
    return marked.where(F.col("_remove_reason").isNull()).drop("_remove_reason"), removed


def removal_summary(removed: DataFrame) -> DataFrame:
    return removed.groupBy("_remove_reason").agg(F.count("*").alias("n_records"))
