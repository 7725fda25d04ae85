"""Reports on scored pairs, and the final output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tier


def tier_counts(predictions: DataFrame, low: bool = True) -> DataFrame:
    tiers = predictions.select(tier(F.col("match_probability"), low).alias("tier")).groupBy("tier").agg(F.count("*").alias("n_pairs"))
    total = tiers.agg(F.sum("n_pairs").alias("_n"))
    return tiers.crossJoin(F.broadcast(total)).select("tier", "n_pairs", F.round(100.0 * F.col("n_pairs") / F.col("_n"), 1).alias("pct"))


def match_rate_by_source(predictions: DataFrame, by: str = "source_table") -> DataFrame:
    p = F.col("match_probability")
    out = predictions.groupBy(by).agg(F.count("*").alias("n_matches"), F.round(F.avg(p), 3).alias("mean_p"), F.round(F.percentile(p, F.lit(0.5)), 3).alias("median_p"), F.round(F.max(p), 3).alias("max_p"))
    return out.orderBy(F.desc("n_matches"), by)


def describe_probability(predictions: DataFrame) -> DataFrame:
    p = F.col("match_probability")
    quartiles = {f"q{k}": F.percentile(p, F.lit(k / 100)) for k in (25, 50, 75)}
    return predictions.agg(F.count(p).alias("n"), F.avg(p).alias("mean"), F.stddev(p).alias("std"), F.min(p).alias("min"), *(v.alias(k) for k, v in quartiles.items()), F.max(p).alias("max"))


def probability_range(predictions: DataFrame, low: float, high: float, n: int | None = None) -> DataFrame:
    """Pairs from ``low`` up to, not including, ``high``, best first."""
    out = predictions.where((F.col("match_probability") >= low) & (F.col("match_probability") < high)).orderBy(F.desc("match_probability"), "unique_id_l", "unique_id_r")
    return out if n is None else out.limit(n)


def final_output(predictions: DataFrame, names: DataFrame, least: float = 0.95) -> DataFrame:
    """High-confidence matches under their outside names, with the name of the reference record."""
    high = predictions.where(F.col("match_probability") >= least)
    look = names.select(F.col("unique_id").alias("unique_id_l"), F.col("name").alias("matched_org_name"))
    source = F.col("source_table") if "source_table" in predictions.columns else F.lit(None).cast("string")
    out = high.withColumn("_source", source).join(look, "unique_id_l", "left")
    return out.select(F.col("unique_id_r").alias("mismatched_id"), F.col("unique_id_l").alias("dim_org_id"), F.col("match_probability").alias("confidence"), F.col("_source").alias("source_table"), "matched_org_name")


def judge_summary(judged: DataFrame, by: str | None = None) -> DataFrame:
    """Confirmed, total, rejected and rate; answers that failed count as rejected."""
    yes = F.coalesce(F.col("llm_match"), F.lit(False))
    groups = judged.groupBy(by) if by else judged.groupBy()
    out = groups.agg(F.count_if(yes).alias("confirmed"), F.count("*").alias("total"))
    return out.withColumn("rejected", F.col("total") - F.col("confirmed")).withColumn("rate", F.round(F.try_divide("confirmed", "total"), 3))


def disagreements(judged: DataFrame, least: float = 0.95) -> DataFrame:
    return judged.where((F.col("match_probability") >= least) & (F.col("llm_match") == F.lit(False)))
