"""Profiles of tables before matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import classify, is_generic


def _percent(part, whole, digits: int = 1):
    return F.round(F.when(whole > 0, 100.0 * part / whole), digits)


def field_coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """``(field, non_null_count, coverage_pct, status)`` in one pass; a column that is missing counts 0."""
    counts = df.agg(F.count("*").alias("_n"), *((F.count(c) if c in df.columns else F.lit(0)).alias(f"_c{k}") for k, c in enumerate(fields)))
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"_c{k}").cast("long").alias("non_null_count"), F.lit("available" if c in df.columns else "missing").alias("status")) for k, c in enumerate(fields)))
    out = counts.select("_n", F.explode(rows).alias("r")).select("r.field", "r.non_null_count", _percent(F.col("r.non_null_count"), F.col("_n")).alias("coverage_pct"), "r.status")
    return out


def coverage_side_by_side(tables: dict[str, DataFrame], fields: list[str]) -> DataFrame:
    """Coverage of several tables, one column for each."""
    parts = [field_coverage(df, fields).select("field", F.col("coverage_pct").alias(f"{name}_pct")) for name, df in tables.items()]
    return reduce(lambda a, b: a.join(b, "field"), parts)


def describe(df: DataFrame) -> DataFrame:
    """``(field, type, null_pct)`` of every column, and the number of rows."""
    types = F.create_map(*(F.lit(x) for c, t in df.dtypes for x in (c, t)))
    found = field_coverage(df, df.columns)
    n = df.agg(F.count("*").alias("n_rows"))
    return found.crossJoin(F.broadcast(n)).select("field", F.element_at(types, F.col("field")).alias("type"), _percent(F.col("n_rows") - F.col("non_null_count"), F.col("n_rows")).alias("null_pct"), "n_rows")


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records")).orderBy(F.desc("n_records"), column)
    return out if n is None else out.limit(n)


def blocking_estimate(df: DataFrame, keys: list[str]) -> DataFrame:
    """For each key its coverage, distinct values and pairs, the sum of n(n-1)/2, in one pass over unpivoted keys."""
    rows = F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys))
    each = df.select(F.explode(rows).alias("r")).groupBy("r.key", "r.value").agg(F.count("*").alias("n"))
    known = F.col("value").isNotNull()
    n = F.sum(F.when(known, F.col("n")).otherwise(0))
    pairs = F.sum(F.when(known, F.col("n") * (F.col("n") - 1) / 2).otherwise(0.0)).cast("long")
    return each.groupBy("key").agg(_percent(n, F.sum("n")).alias("coverage_pct"), F.count("value").alias("unique_values"), pairs.alias("estimated_pairs"))


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many of a's distinct keys b has."""
    left, right = a.select(key).na.drop().distinct(), b.select(key).na.drop().distinct()
    both = left.intersect(right).agg(F.count("*").alias("n_both"))
    return left.agg(F.count("*").alias("n_left")).crossJoin(both).select("n_left", "n_both", _percent(F.col("n_both"), F.col("n_left")).alias("overlap_pct"))


def no_blocking_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, (F.col(k).isNull() for k in keys)))


def name_lengths(df: DataFrame, name: str = "name") -> DataFrame:
    n = F.length(name)
    return df.agg(F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.avg(n).alias("mean_length"), F.percentile(n, F.lit(0.5)).alias("median_length"), F.count_if(n < 5).alias("n_short"), F.count_if(n > 100).alias("n_long"))


def top_duplicates(df: DataFrame, name: str, n: int = 10) -> DataFrame:
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n_records"))
    return counts.where("n_records > 1").orderBy(F.desc("n_records"), name).limit(n)


def category_counts(df: DataFrame, name: str = "name") -> DataFrame:
    kinds = df.select(classify(F.col(name)).alias("category")).groupBy("category").agg(F.count("*").alias("n_records"))
    total = df.agg(F.count("*").alias("_n"))
    return kinds.crossJoin(F.broadcast(total)).select("category", "n_records", _percent(F.col("n_records"), F.col("_n")).alias("pct"))


def exploration_summary(tables: dict[str, DataFrame], kept: DataFrame, removed: DataFrame, keys: list[str]) -> dict:
    """The findings as one document: sizes, overlap, coverage, blocking, names and filtering."""
    incoming = tables["mismatched"]
    n = incoming.count()
    share = lambda k: 100.0 * k / n if n else 0.0
    overlap = key_overlap(tables["dim_org"], tables["grid"], "ror_id").first()
    generic, bare, gone = incoming.where(is_generic(F.col("name"))).count(), no_blocking_key(incoming, keys).count(), removed.count()
    return {
        "data_sizes": {f"{k}_sample": df.count() for k, df in tables.items()},
        "ror_overlap": {"dim_org_with_ror": overlap["n_left"], "overlapping_ror_ids": overlap["n_both"]},
        "field_coverage": [r.asDict() for r in coverage_side_by_side(tables, keys).collect()],
        "blocking_stats": [r.asDict() | {"source": k} for k, df in tables.items() for r in blocking_estimate(df, keys).collect()],
        "name_quality": {"generic_names_count": generic, "generic_names_pct": share(generic), "no_blocking_key_count": bare, "no_blocking_key_pct": share(bare)},
        "filtering": {"records_after_filter": kept.count(), "records_removed": gone, "removal_pct": share(gone)},
    }
