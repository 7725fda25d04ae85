"""Candidate pairs by blocking rules: one equi join for each rule, each pair under its first rule.

A rule is SQL over the aliases ``l`` and ``r``. A later rule excludes what an earlier one has found by a
residual condition, so pairs are never shuffled to be made distinct, and no join has an OR.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key on either side that meet in one cell of the join, about.
CELL = 512

# The rules for prediction and those of the training sessions.
PREDICTION_RULES = [
    "l.name_normalized = r.name_normalized",
    "substr(l.name_normalized, 1, 25) = substr(r.name_normalized, 1, 25) AND l.country_code = r.country_code",
    "l.distinctive_token = r.distinctive_token AND l.city = r.city",
    "l.name_metaphone = r.name_metaphone AND l.country_code = r.country_code AND l.city = r.city",
]
TRAINING_RULES = [
    "l.name_normalized = r.name_normalized",
    "l.country_code = r.country_code AND l.name_prefix_5 = r.name_prefix_5",
    "l.distinctive_token = r.distinctive_token",
    "l.city = r.city AND l.name_prefix_5 = r.name_prefix_5",
    "l.country_code = r.country_code AND l.city = r.city",
]


def _ends(rule: str) -> list[list[str]] | None:
    """The expressions of both sides of each equality, if a rule is equalities of the same expression on both sides, joined by AND."""
    ends = [[x.strip() for x in test.split("=")] for test in rule.split(" AND ")]
    return None if any(len(x) != 2 or x[0].replace("l.", "r.") != x[1] for x in ends) else ends


def _keyed(df: DataFrame, s: str, at: int, ends: list[list[list[str]]]) -> DataFrame | None:
    """A row of ``df`` for each rule whose keys it has, under ``_rule``; none if a key is no text, since keys of all rules share columns."""
    df = df.alias(s)
    if any(kind != "string" for _, kind in df.select(*(F.expr(x[at]).alias(f"_{k}_{j}") for k, e in enumerate(ends) for j, x in enumerate(e))).dtypes):
        return None
    width = max(map(len, ends))
    found = []
    for k, e in enumerate(ends):
        held = reduce(Column.__and__, (F.expr(x[at]).isNotNull() for x in e))
        found.append(F.when(held, F.struct(F.lit(k).alias("_rule"), *((F.expr(e[j][at]) if j < len(e) else F.lit("")).alias(f"_k{j}") for j in range(width)))))
    return df.select("*", F.explode(F.array_compact(F.array(*found))).alias("_o")).select("*", "_o.*").drop("_o")


def _dealt(keyed: list[DataFrame], keys: list[str], cell: int) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with a row for each cell that they meet the other side in, dealt out by cells, and the condition of the join.

    The rows of a key are cut on either side into blocks of about ``cell``; each pair of blocks is a cell, so a large key meets in
    many tasks and each pair of rows in one cell. Only keys of more than ``cell`` rows are looked up, and of those there are
    at most as many as rows by ``cell``.
    """
    spark = keyed[0].sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = reduce(DataFrame.unionByName, (df.select(*keys, F.lit(at).alias("_s")) for at, df in enumerate(keyed)))
    large = both.groupBy(*keys).agg(*(F.ceil(F.count_if(F.col("_s") == at) / cell).cast("int").alias(c) for at, c in enumerate(("_nl", "_nr"))))
    large = F.broadcast(large.where("least(_nl, _nr) > 0 AND greatest(_nl, _nr) > 1"))
    out = []
    for df, own, own_n, other, other_n in zip(keyed, ("_i", "_j"), ("_nl", "_nr"), ("_j", "_i"), ("_nr", "_nl"), strict=True):
        df = df.join(large, keys, "left").withColumn(own, F.pmod(F.xxhash64("unique_id"), F.coalesce(own_n, F.lit(1))).cast("int"))
        out.append(df.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other_n, F.lit(1)) - 1))).drop("_nl", "_nr").repartition(n, *keys, "_i", "_j"))
    same = reduce(Column.__and__, (F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, "_i", "_j"]))
    return out[0], out[1].hint("merge"), same


def block(left: DataFrame, right: DataFrame, rules: list[str], keep: list[str] | None = None, cell: int | None = None) -> DataFrame:
    """``(unique_id_l, unique_id_r, match_key)`` and the columns ``keep`` of both sides with ``_l`` and ``_r``.

    With ``cell``, the pairs of a rule of equalities are made in cells of about ``cell`` rows a side: for pairs that much is done with.
    """
    columns = [F.col(f"{s}.{c}").alias(f"{c}_{s}") for c in ["unique_id", *(keep or [])] for s in "lr"]
    every = [_ends(rule) if cell else None for rule in rules]
    if all(every):
        # one join of all rules: a plan of one branch, so that what is done with the pairs is compiled once
        keyed = [_keyed(df, s, at, every) for at, (df, s) in enumerate(((left, "l"), (right, "r")))]
        if all(x is not None for x in keyed):
            l, r, condition = _dealt(keyed, ["_rule", *(f"_k{j}" for j in range(max(map(len, every))))], cell)
            for k, earlier in enumerate(rules[:-1]):
                condition = condition & ((F.col("l._rule") <= k) | ~F.coalesce(F.expr(earlier), F.lit(False)))
            return l.alias("l").join(r.alias("r"), condition).select(*columns, F.col("l._rule").alias("match_key"))
    parts = []
    for k, (rule, ends) in enumerate(zip(rules, every, strict=True)):
        l, r, condition = left, right, F.expr(rule)
        if ends:
            keys = [f"_k{j}" for j in range(len(ends))]
            l, r, condition = _dealt([df.alias(s).select("*", *(F.expr(x[at]).alias(c) for c, x in zip(keys, ends, strict=True))).dropna(subset=keys) for at, (df, s) in enumerate(((left, "l"), (right, "r")))], keys, cell)
        for earlier in rules[:k]:
            condition = condition & ~F.coalesce(F.expr(earlier), F.lit(False))
        parts.append(l.alias("l").join(r.alias("r"), condition).select(*columns, F.lit(k).alias("match_key")))
    return reduce(DataFrame.unionByName, parts)


def chosen(pairs: DataFrame, left: DataFrame, right: DataFrame, rules: list[str], keep: list[str], key: str = "class_id") -> DataFrame:
    """What ``block`` gives of the ``pairs`` of ``key``, which repeat none: their rows are looked up instead of blocked."""
    columns = [F.col(f"{s}.{c}").alias(f"{c}_{s}") for c in ["unique_id", *keep] for s in "lr"]
    both = pairs.alias("p").join(left.alias("l"), F.col(f"p.{key}_l") == F.col(f"l.{key}")).join(right.alias("r"), F.col(f"p.{key}_r") == F.col(f"r.{key}"))
    first = F.coalesce(*(F.when(F.expr(rule), k) for k, rule in enumerate(rules)))
    return both.withColumn("match_key", first).where("match_key IS NOT NULL").select(*columns, "match_key")


def links(left: DataFrame, right: DataFrame, rules: list[str]) -> DataFrame:
    """``(unique_id_l, unique_id_r)`` that connect the same records as all pairs of the rules, at most one for each record and rule.

    A rule must be equalities of the same expression on both sides, joined by AND. The records of one key on either side
    are then linked each with each, so all of them hang on the smallest id.
    """
    parts = []
    for rule in rules:
        ends = _ends(rule)
        if ends is None:
            raise ValueError(f"not the same expression on both sides: {rule}")
        keys = [f"_k{k}" for k in range(len(ends))]
        side = lambda df, s, at: df.alias(s).select("unique_id", F.lit(at).alias("_s"), *(F.expr(x[at]).alias(k) for k, x in zip(keys, ends, strict=True)))  # noqa: B023, E731
        both = side(left, "l", 0).unionByName(side(right, "r", 1)).dropna(subset=keys)
        low = both.groupBy(*keys).agg(F.min("unique_id").alias("unique_id_l"), F.min("_s").alias("_low"), F.max("_s").alias("_high")).where("_low < _high")
        parts.append(both.join(low, keys).select("unique_id_l", F.col("unique_id").alias("unique_id_r")))
    return reduce(DataFrame.unionByName, parts)


def cumulative_counts(pairs: DataFrame, rules: list[str]) -> DataFrame:
    """New and cumulative pairs of each rule; a rule without new pairs has a row too."""
    spark = pairs.sparkSession
    every = spark.createDataFrame([(k, r) for k, r in enumerate(rules)], "match_key int, rule string")
    n = pairs.groupBy("match_key").agg(F.count("*").alias("n"))
    out = every.join(n, "match_key", "left").select("match_key", "rule", F.coalesce("n", F.lit(0)).cast("long").alias("new_pairs"))
    return out.withColumn("cumulative_pairs", F.sum("new_pairs").over(Window.orderBy("match_key")))
