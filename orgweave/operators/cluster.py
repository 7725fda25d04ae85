"""One best match for each record, and clusters of matched records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components

#: Fixed value: the least probability of an edge.
LEAST = 0.85


def disambiguate(predictions: DataFrame, first_non_null: bool = False) -> DataFrame:
    """The best match of each ``unique_id_r``: probability, equal country, shorter name, then id.

    The row stays whole. ``first_non_null`` instead takes each column's first known value in that order.
    """
    columns = predictions.columns
    country = F.coalesce((F.col("country_code_l") == F.col("country_code_r")).cast("int"), F.lit(0)) if "country_code_l" in columns else F.lit(0)
    name = next((c for c in ("name_l", "name_normalized_l") if c in columns), None)
    length = F.length(name) if name else F.lit(0)
    order = [F.desc("match_probability"), country.desc(), length.asc_nulls_last(), F.col("unique_id_l")]
    best = Window.partitionBy("unique_id_r").orderBy(*order)
    ranked = predictions.withColumn("_rank", F.row_number().over(best))
    if first_non_null:
        whole = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ranked = ranked.withColumns({c: F.first(c, ignorenulls=True).over(whole) for c in columns if c != "unique_id_r"})
    return ranked.where("_rank = 1").drop("_rank")


def matches_per_record(predictions: DataFrame, side: str = "r") -> DataFrame:
    return predictions.groupBy(f"unique_id_{side}").agg(F.count("*").alias("n_matches"))


def multi_matches(predictions: DataFrame, side: str = "l", n: int = 5) -> DataFrame:
    """The records with the most matches, of those that have several."""
    return most_matches(matches_per_record(predictions, side), side, n)


def most_matches(counts: DataFrame, side: str = "l", n: int = 5) -> DataFrame:
    return counts.where("n_matches > 1").orderBy(F.desc("n_matches"), f"unique_id_{side}").limit(n)


def clusters(predictions: DataFrame, least: float = LEAST) -> DataFrame:
    """``(unique_id, cluster_id)``: connected components of pairs; a cluster is named by its smallest id."""
    edges = predictions.where(F.col("match_probability") >= least).select(F.col("unique_id_l").alias("a"), F.col("unique_id_r").alias("b"))
    return components(edges).select(F.col("id").alias("unique_id"), F.col("component_id").alias("cluster_id"))


def star_clusters(best: DataFrame, least: float = LEAST) -> DataFrame:
    """The same for disambiguated pairs, whose components are stars around ``unique_id_l``: one group-by."""
    edges = best.where(F.col("match_probability") >= least).select("unique_id_l", "unique_id_r")
    centre = edges.groupBy("unique_id_l").agg(F.least(F.min("unique_id_r"), F.first("unique_id_l")).alias("cluster_id"))
    named = edges.join(centre, "unique_id_l")
    members = named.select(F.explode(F.array("unique_id_l", "unique_id_r")).alias("unique_id"), "cluster_id")
    return members.distinct()


def attach(predictions: DataFrame, found: DataFrame) -> DataFrame:
    return predictions.join(found.withColumnRenamed("unique_id", "unique_id_l"), "unique_id_l", "left")


def cluster_sizes(found: DataFrame) -> DataFrame:
    return found.groupBy("cluster_id").agg(F.count("*").alias("size"))


def size_summary(sizes: DataFrame) -> DataFrame:
    n = F.col("size")
    return sizes.agg(F.count("*").alias("n_clusters"), F.count_if(n == 1).alias("n_single"), F.count_if(n > 1).alias("n_multi"), F.max(n).alias("largest"), F.avg(n).alias("mean_size"), F.percentile(n, F.lit(0.5)).alias("median_size"))


def size_histogram(sizes: DataFrame) -> DataFrame:
    n = F.col("size")
    bin_ = F.when(n == 1, "1").when(n == 2, "2").when(n <= 5, "3-5").when(n <= 10, "6-10").otherwise(">10")
    return sizes.groupBy(bin_.alias("size_bin")).agg(F.count("*").alias("n_clusters"))
