"""Fellegi-Sunter scores: match weights of the levels, term frequencies and a prior (Fellegi and Sunter 1969)."""

from __future__ import annotations

from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import match_weight
from .compare import Comparison, Level


def term_frequencies(tables: list[DataFrame], column: str, by: str | None = None) -> DataFrame:
    """``(value, tf)``: each value's share of the non-null ones of all tables; with ``by``, inside each of its groups."""
    keys = [by] if by else []
    both = None
    for df in tables:
        part = df.select(*keys, F.col(column).alias("value")).where(F.col("value").isNotNull())
        both = part if both is None else both.unionByName(part)
    n = both.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    total = both.groupBy(*keys).agg(F.count("*").alias("total"))
    joined = n.join(total, keys) if keys else n.crossJoin(F.broadcast(total))
    return joined.select(*keys, "value", (F.col("n") / F.col("total")).alias("tf"))


def weight(c: Comparison) -> Column:
    """The level's log2(m / u); none for null."""
    out = None
    for number, x in c.gammas:
        test = F.col(f"gamma_{c.name}") == number
        value = F.lit(match_weight(x.m, x.u))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(0.0)


def term_weight(c: Comparison, tf_l: Column, tf_r: Column) -> Column:
    """For a level that is adjusted: log2(u / the larger frequency), times its weight."""
    for number, x in c.gammas:
        if x.tf_column:
            larger = F.greatest(tf_l, tf_r)
            return F.when((F.col(f"gamma_{c.name}") == number) & (larger > 0), F.log2(F.lit(x.u) / larger) * x.tf_weight).otherwise(0.0)
    return F.lit(0.0)


def most_weight(tests: list[tuple[Column, Level, bool]]) -> Column:
    """The most that a comparison adds by tests that allow its levels, in order: a level's weight where its test is exact, else the largest
    of it and those behind it. A level that is adjusted has no bound."""
    weights = [0.0 if x.is_null else float("inf") if x.tf_column else match_weight(x.m, x.u) for _, x, _ in tests]
    out = F
    for k, (test, _, exact) in enumerate(tests):
        out = out.when(test, F.lit(weights[k] if exact else max(weights[k:])))
    return out.otherwise(next(w for w, (_, x, _) in zip(weights[::-1], tests[::-1], strict=True) if not x.is_null))


def can_reach(prior: float, least: float) -> Callable[..., Column]:
    """For ``add_gammas``: if unequal names can have a probability of ``least`` by the known gammas and the best ones of the others,
    or the best ones that tests allow.

    Only equal values are adjusted by their frequency, and those need no similarity.
    """

    def reach(known: list[Comparison], others: list[Comparison], tests: Callable[[Comparison], list] | None = None) -> Column:
        total = F.lit(log2(prior / (1 - prior)))
        for c in known:
            total = total + weight(c)
        unequal = lambda x: x.condition != "name_normalized_l = name_normalized_r"
        for c in others:
            total = total + (most_weight(tests(c)) if tests else max([0.0, *(match_weight(x.m, x.u) for _, x in c.gammas if unequal(x))]))
        adjusted = any(x.tf_column and x.tf_column != "name_normalized" for c in [*known, *others] for x in c.levels)
        return F.lit(True) if adjusted else total >= log2(least / (1 - least)) - 1e-6

    return reach


def add_scores(pairs: DataFrame, found: list[Comparison], prior: float, tf: dict[str, DataFrame] | None = None, least: float | None = None) -> DataFrame:
    """``pairs`` with gammas, scored: ``match_weight`` and ``match_probability``; below ``least`` they are left out.

    ``tf`` maps a column to ``term_frequencies`` of it; pairs that have ``tf_`` columns of both sides need none.
    """
    total = F.lit(log2(prior / (1 - prior)))
    out = pairs
    for c in found:
        total = total + weight(c)
        adjusted = next((x.tf_column for x in c.levels if x.tf_column), None)
        known = {f"tf_{adjusted}_l", f"tf_{adjusted}_r"} <= set(pairs.columns)
        if known or tf and adjusted in tf:
            for side in "" if known else "lr":
                t = tf[adjusted].select(F.col("value").alias(f"_v{side}"), F.col("tf").alias(f"tf_{adjusted}_{side}"))
                out = out.join(t, F.col(f"{adjusted}_{side}") == F.col(f"_v{side}"), "left").drop(f"_v{side}")
            total = total + term_weight(c, F.col(f"tf_{adjusted}_l"), F.col(f"tf_{adjusted}_r"))
    out = out.withColumn("match_weight", total).withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))
    return out if least is None else out.where(F.col("match_probability") >= least)


def parameter_table(spark, found: list[Comparison]) -> DataFrame:
    """``(comparison, gamma, condition, m, u, weight)``: what a chart of the model's parameters shows."""
    rows = [(c.name, k, x.condition, x.m, x.u, match_weight(x.m, x.u) if x.m and x.u else None) for c in found for k, x in c.gammas]
    return spark.createDataFrame(rows, "comparison string, gamma int, condition string, m double, u double, weight double")


def steps(found: list[Comparison], prior: float, digits: int | None = None) -> Column:
    """The weight that the prior and each comparison adds, as an array in order, rounded if ``digits`` are given."""
    shown = lambda c: c if digits is None else F.round(c, digits)
    each = [("prior", F.lit(log2(prior / (1 - prior)))), *((c.name, weight(c)) for c in found)]
    return F.array(*(F.struct(F.lit(name).alias("step"), shown(w).alias("weight")) for name, w in each))


def unfold(pairs: DataFrame) -> DataFrame:
    """A row for each of the ``steps`` of each pair."""
    return pairs.select("unique_id_l", "unique_id_r", F.posexplode("steps").alias("place", "s")).select("unique_id_l", "unique_id_r", "place", "s.step", "s.weight")


def waterfall(pairs: DataFrame, found: list[Comparison], prior: float) -> DataFrame:
    """For each pair the weight that each comparison adds, in order: what a waterfall chart shows."""
    return unfold(pairs.withColumn("steps", steps(found, prior)))
