"""Labelled pairs from shared outside ids, and measures of predictions against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import sample_key

#: Thresholds of the measures.
THRESHOLDS = (0.5, 0.7, 0.85, 0.95)
#: Negatives drawn at most, as in the reference.
MOST_NEGATIVES = 100_000


def negative_draws(positives: int) -> int:
    """Two draws for each positive pair, up to the reference's own limit."""
    return min(2 * positives, MOST_NEGATIVES)


def positive_pairs(left: DataFrame, right: DataFrame, key: str = "ror_id") -> DataFrame:
    a = left.where(F.col(key).isNotNull()).select(F.col("unique_id").alias("unique_id_l"), key)
    b = right.where(F.col(key).isNotNull()).select(F.col("unique_id").alias("unique_id_r"), key)
    return a.join(b, key).select("unique_id_l", key, "unique_id_r", F.lit(True).alias("is_match"))


def count_positives(left: DataFrame, right: DataFrame, key: str = "ror_id") -> int:
    """The number of ``positive_pairs``, by the sizes of the keys."""
    a, b = (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(n)) for df, n in ((left, "a"), (right, "b")))
    return a.join(b, key).agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0


def positive_classes(left: DataFrame, right: DataFrame, key: str = "ror_id") -> DataFrame:
    """``(class_id_l, class_id_r, n)``: how many positive pairs there are between the records of two classes."""
    a, b = (df.where(F.col(key).isNotNull()).groupBy(key, F.col("class_id").alias(f"class_id_{s}")).agg(F.count("*").alias(f"_{s}")) for df, s in ((left, "l"), (right, "r")))
    return a.join(b, key).groupBy("class_id_l", "class_id_r").agg(F.sum(F.col("_l") * F.col("_r")).alias("n"))


def negative_pairs(left: DataFrame, right: DataFrame, n: int, key: str = "ror_id", seed: int = 42) -> DataFrame:
    """``n`` pairs drawn with replacement on either side, less those of equal key.

    Draw i takes the row whose place, in an order by hash, is a hash of i modulo the number of rows; so
    reruns agree and nothing is collected. ``n`` is a stated bound, at most 100,000 by default settings.
    """

    def placed(df: DataFrame, s: str) -> DataFrame:
        rows = df.where(F.col(key).isNotNull()).select(F.col("unique_id").alias(f"unique_id_{s}"), F.col(key).alias(f"{key}_{s}"))
        # a draw's place is looked up among as many rows as draws at most: the lowest hashes are themselves a sample
        few = rows.orderBy(sample_key(F.col(f"unique_id_{s}"), seed), f"unique_id_{s}").limit(max(n, 1))
        return few.withColumn("_p", F.row_number().over(Window.orderBy(sample_key(F.col(f"unique_id_{s}"), seed), f"unique_id_{s}")) - 1)

    spark = left.sparkSession
    a, b = placed(left, "l"), placed(right, "r")
    size = a.agg(F.count("*").alias("na")).crossJoin(b.agg(F.count("*").alias("nb"))).where("na > 0 and nb > 0")
    draw = lambda s: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(s), F.col("id").cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    draws = spark.range(n).crossJoin(F.broadcast(size)).select("id", (draw("l") % F.col("na")).alias("_pl"), (draw("r") % F.col("nb")).alias("_pr"))
    out = draws.join(a.withColumnRenamed("_p", "_pl"), "_pl").join(b.withColumnRenamed("_p", "_pr"), "_pr")
    return out.where(F.col(f"{key}_l") != F.col(f"{key}_r")).select("unique_id_l", "unique_id_r", f"{key}_l", f"{key}_r", F.lit(False).alias("is_match"))


def truth_labels(predictions: DataFrame, positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """``predictions`` with ``truth``: TRUE_MATCH, TRUE_NON_MATCH or UNKNOWN; the order of a pair doesn't matter."""

    def keys(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.least("unique_id_l", "unique_id_r").alias("_a"), F.greatest("unique_id_l", "unique_id_r").alias("_b")).distinct().withColumn(name, F.lit(True))

    out = predictions.withColumns({"_a": F.least("unique_id_l", "unique_id_r"), "_b": F.greatest("unique_id_l", "unique_id_r")})
    out = out.join(keys(positives, "_yes"), ["_a", "_b"], "left").join(keys(negatives, "_no"), ["_a", "_b"], "left")
    truth = F.when(F.col("_yes"), "TRUE_MATCH").when(F.col("_no"), "TRUE_NON_MATCH").otherwise("UNKNOWN")
    return out.withColumn("truth", truth).drop("_a", "_b", "_yes", "_no")


def class_truth_counts(pairs: DataFrame, positives: DataFrame, negatives: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``(truth, n_pairs)`` over all pairs of records of ``pairs`` of classes with sizes ``n_l`` and ``n_r``.

    ``positives`` are counted by classes; ``negatives`` are pairs of records with their classes, where a repeated one counts once.
    ``labelled`` are those of ``pairs`` that hold any of both, if the caller has them; else all are looked through.
    """
    both = ["class_id_l", "class_id_r"]
    no = negatives.select("unique_id_l", "unique_id_r", *both).distinct().groupBy(*both).agg(F.count("*").alias("_no"))
    total = pairs.agg(F.coalesce(F.sum(F.col("n_l") * F.col("n_r")), F.lit(0)).alias("_all"))
    held = (pairs if labelled is None else labelled).select(*both).join(positives.withColumnRenamed("n", "_yes"), both, "left").join(no, both, "left")
    n = held.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_yes", "_no"))).crossJoin(total)
    found = (("TRUE_MATCH", F.col("_yes")), ("TRUE_NON_MATCH", F.col("_no")), ("UNKNOWN", F.col("_all") - F.col("_yes") - F.col("_no")))
    rows = F.array(*(F.struct(F.lit(name).alias("truth"), count.alias("n_pairs")) for name, count in found))
    return n.select(F.explode(rows).alias("x")).select("x.*").where("n_pairs > 0")


def false_positives(labelled: DataFrame, least: float = 0.95) -> DataFrame:
    return labelled.where((F.col("match_probability") >= least) & (F.col("truth") == "TRUE_NON_MATCH"))


def labelled_predictions(labels: DataFrame, predictions: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Labels with the probability of their pair, 0 for pairs that no rule brought together. ``on`` are a pair's ids."""
    on = on or ["unique_id_l", "unique_id_r"]
    p = predictions.groupBy(*on).agg(F.max("match_probability").alias("match_probability"))
    out = labels.join(p, on, "left")
    return out.withColumn("match_probability", F.coalesce("match_probability", F.lit(0.0)))


def metrics(labelled: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, weight: str | None = None) -> DataFrame:
    """``(threshold, tp, fp, tn, fn, precision, recall, f1)`` in one pass; a share of nothing is 0. ``weight``: how many pairs a row stands for."""
    each = F.explode(F.array(*map(F.lit, thresholds)))
    count = F.col(weight) if weight else F.lit(1).cast("long")
    rows = labelled.select("is_match", "match_probability", count.alias("_n"), each.alias("threshold"))
    said, true = F.col("match_probability") >= F.col("threshold"), F.col("is_match")
    total = lambda c: F.sum(F.when(c, F.col("_n")).otherwise(0))
    n = rows.groupBy("threshold").agg(total(said & true).alias("tp"), total(said & ~true).alias("fp"), total(~said & ~true).alias("tn"), total(~said & true).alias("fn"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    n = n.withColumn("precision", share(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", share(F.col("tp"), F.col("tp") + F.col("fn")))
    return n.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
