"""Records that no rule and no comparison tells apart, as classes: pairs of classes stand for all pairs of their records.

Copies of a record multiply its pairs by the square of their number. Blocked, compared and scored as classes, they cost one
pair; counts of pairs follow from the sizes of the classes, and only who needs every pair of records expands them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

#: Ids of a class that are kept in one row, about: a pair of rows expands to the square of it inside a task.
BLOCK = 256


def classes(df: DataFrame, columns: list[str], carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``columns`` of each class with ``class_id``, its size ``n`` and its smallest ``unique_id``; and each record's ``unique_id, class_id, n``.

    Rows are of one class if all ``columns`` are equal, null with null. ``carry`` names columns that the records keep.
    """
    found = df.groupBy(*columns).agg(F.min("unique_id").alias("unique_id"), F.count("*").alias("n"))
    found = stage(found.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    own = found.select("class_id", "n", *(F.col(c).alias(f"_{c}") for c in columns))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns))
    return found, stage(df.join(own, same).select("unique_id", "class_id", "n", *carry), "members")


def _blocks(members: DataFrame, s: str) -> DataFrame:
    salt = F.pmod(F.xxhash64("unique_id"), F.ceil(F.col("n") / BLOCK))
    found = members.groupBy(F.col("class_id").alias(f"class_id_{s}"), salt.alias("_salt")).agg(F.collect_list("unique_id").alias(f"_ids_{s}"))
    return found.drop("_salt")


def expand(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of records of ``pairs`` of classes, with ``unique_id_l`` and ``unique_id_r`` in place of the class's.

    Ids are joined by blocks and dealt out evenly before they unfold, so a large class meets in no single task.
    """
    spark = pairs.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rest = [c for c in pairs.columns if c not in ("unique_id_l", "unique_id_r", "class_id_l", "class_id_r", "n_l", "n_r")]
    held = pairs.drop("unique_id_l", "unique_id_r", "n_l", "n_r").join(_blocks(left, "l"), "class_id_l").join(_blocks(right, "r"), "class_id_r")
    held = held.select("_ids_l", "_ids_r", *rest).repartition(n)
    return held.select("_ids_r", F.explode("_ids_l").alias("unique_id_l"), *rest).select("unique_id_l", F.explode("_ids_r").alias("unique_id_r"), *rest)


def expand_side(rows: DataFrame, members: DataFrame, s: str) -> DataFrame:
    """``rows`` that hold one side's ``class_id``, for every record of the class, under its ``unique_id``."""
    each = members.drop("n").withColumnsRenamed({"unique_id": f"unique_id_{s}", "class_id": f"class_id_{s}"})
    return rows.drop(f"unique_id_{s}").join(each, f"class_id_{s}")
