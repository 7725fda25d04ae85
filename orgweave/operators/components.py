"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

#: Rounds after which something is wrong: the steps converge in about the square of the logarithm of the size.
MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(id, component_id)``: the smallest id reachable, for every id that has a link.

    Self links, repeated and null ends are ignored; no links give an empty result. Every step is a
    group-by with partial sums and an equi join, so no component meets in one task.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "links")
    last = None
    for _ in range(MAX_ROUNDS):
        # large star: a node's larger neighbours hang on its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        edges = edges.where("u <> v").distinct()
        # small star: a node and its smaller neighbours hang on the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(low, "u")
        edges = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stage(edges.where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last or now[0] == 0:
            break
        last = now
    else:
        raise RuntimeError("components did not converge")
    roots = edges.groupBy("v").agg(F.count("*").alias("n")).select(F.col("v").alias("id"), F.col("v").alias("component_id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)
