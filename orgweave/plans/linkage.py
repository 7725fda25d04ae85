"""Plans: candidate pairs, scores and exports, for all sources in one job."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tier
from ..operators.blocking import CELL, block, chosen
from ..operators.classes import classes, expand, expand_side
from ..operators.cluster import attach, disambiguate, star_clusters
from ..operators.compare import Comparison, add_gammas, comparisons, lowered, needed_columns, signed
from ..operators.model import default_settings
from ..operators.score import add_scores, can_reach, term_frequencies
from ..sources.progress import progress
from ..sources.staging import spread, stage

LEAST = 0.5


@dataclass(frozen=True)
class Scored:
    """Scored pairs of classes of records, the records of both sides with their classes, and the classes.

    ``least`` holds for what the methods give; ``pairs`` are more, since a filter on scores would be pushed down as one
    expression over all comparisons. With ``least`` most pairs that can't reach it are left out, and the names of others that
    can't are not compared: their scores are under it, but not exact.
    """

    pairs: DataFrame
    left: DataFrame
    right: DataFrame
    classes: tuple[DataFrame, DataFrame]
    rate: Callable[[DataFrame], DataFrame]
    rules: list[str]
    keep: list[str]
    least: float | None = None

    def among(self, pairs: DataFrame) -> Scored:
        """Scores of only those ``pairs`` of classes, as far as a rule brings them together."""
        some = pairs.select("class_id_l", "class_id_r").distinct()
        return replace(self, pairs=self.rate(chosen(some, *self.classes, self.rules, self.keep)))

    def all_pairs(self, *columns: str) -> DataFrame:
        """Every pair of records, with ``columns`` of it or else all that the classes have but arrays."""
        pairs = self.pairs.select("class_id_l", "class_id_r", *columns) if columns else self.pairs.drop(*_arrays(self.pairs))
        if self.least is not None:
            pairs = stage(pairs, "scored").where(F.col("match_probability") >= self.least)
        return expand(pairs, self.left, self.right)

    def best(self) -> DataFrame:
        """The best match of each ``unique_id_r``, as ``disambiguate`` finds it among all pairs.

        Of a class on the left its smallest id comes first, and the records of a class on the right share their best match. Rows that
        repeat an id in several classes meet at the end. Pairs are ranked by what decides, other columns looked up for the best ones.
        """
        ordered = [c for c in ("country_code_l", "country_code_r", "name_l", "name_normalized_l") if c in self.pairs.columns]
        scores = [c for c in self.pairs.columns if c.startswith(("gamma_", "match_"))]
        best = disambiguate(self.pairs.select("class_id_l", "class_id_r", "unique_id_l", F.col("class_id_r").alias("unique_id_r"), *ordered, *scores))
        best = stage(best, "best")
        best = best if self.least is None else best.where(F.col("match_probability") >= self.least)
        for df, s in zip(self.classes, "lr", strict=True):
            own = df.drop("unique_id", "n", *_arrays(df), *(c for c in df.columns if c.startswith("_low_")))
            own = own.select(*(F.col(c).alias(f"{c}_{s}") for c in own.columns if c == "class_id" or f"{c}_{s}" not in best.columns))
            best = best.join(own, f"class_id_{s}")
        return disambiguate(expand_side(best, self.right, "r").drop("class_id_l", "class_id_r"))

    def matches(self, s: str = "r") -> DataFrame:
        """``n_matches`` of each record of a side that has any."""
        other = F.col("n_l" if s == "r" else "n_r")
        n = other if self.least is None else F.when(F.col("match_probability") >= self.least, other).otherwise(0)
        n = self.pairs.groupBy(f"class_id_{s}").agg(F.sum(n).alias("n_matches")).where("n_matches > 0")
        return expand_side(n, self.left if s == "l" else self.right, s).groupBy(f"unique_id_{s}").agg(F.sum("n_matches").alias("n_matches"))


def _arrays(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind.startswith("array")]


def compare(left: DataFrame, right: DataFrame, found: list[Comparison], rules: list[str], keep: tuple[str, ...] = ("name",), carry: tuple[str, ...] = (), tf: DataFrame | None = None, reach: Callable | None = None) -> Scored:
    """Pairs of classes that the rules bring together, with their gammas. ``carry`` names columns that records keep where they have them.

    Pairs are made in cells and compared where they are made, since a rule's large groups make many. With ``tf`` they have the
    term frequencies of ``name_normalized``, which are looked up once for each class.
    """
    columns = sorted({*needed_columns(found), *(c for c in keep if c in left.columns and c in right.columns)})
    key = sorted({*columns, *(["name_normalized"] if tf is not None else []), *(c for r in rules for c in re.findall(r"\b[lr]\.(\w+)", r))})
    (a, l), (b, r) = (classes(spread(df), key, tuple(c for c in carry if c in df.columns)) for df in (left, right))
    low = {c: x for c, x in lowered(found).items() if c.removeprefix("_low_") in columns}
    low |= signed(found) if reach else {}
    a, b = (df.withColumns(low) for df in (a, b))
    columns = ["class_id", "n", *columns, *low]
    if tf is not None:
        look = tf.select(F.col("value").alias("_value"), F.col("tf").alias("tf_name_normalized"))
        a, b = (stage(df.join(look, F.col("name_normalized") == F.col("_value"), "left").drop("_value"), "frequencies") for df in (a, b))
        columns.append("tf_name_normalized")
    rate = lambda pairs: add_gammas(pairs, found, reach)
    return Scored(rate(block(spread(a), spread(b), rules, columns, CELL)), l, r, (a, b), rate, rules, columns)


def score(left: DataFrame, right: DataFrame, settings: dict | None = None, rules: list[str] | None = None, least: float | None = LEAST, term_frequency: bool = True, keep: tuple[str, ...] = ("name",), carry: tuple[str, ...] = (), written: bool = False) -> Scored:
    """Scored pairs of classes of a reference table and incoming records, of probability ``least`` or more.

    Term frequencies are of both tables together, so a pair's score depends on no chunking. ``written`` says that both are read from
    files as they are, so they need not be written.
    """
    settings = settings or default_settings()
    found = comparisons(settings)
    rules = rules or [r["blocking_rule"] for r in settings["blocking_rules_to_generate_predictions"]]
    used = {"unique_id", *needed_columns(found), *keep, *carry, "name_normalized", *(c for r in rules for c in re.findall(r"\b[lr]\.(\w+)", r))}
    # classes and term frequencies read both sides, so their features are computed once
    left, right = (df.select(*(c for c in df.columns if c in used)) for df in (left, right))
    left, right = (df if written else stage(df, "features") for df in (left, right))
    tf = term_frequencies([left, right], "name_normalized") if term_frequency else None
    prior = settings["probability_two_random_records_match"]
    out = compare(left, right, found, rules, keep, carry, tf, None if least is None else can_reach(prior, least))
    rate = lambda pairs: add_scores(out.rate(pairs), found, prior)
    return replace(out, pairs=add_scores(out.pairs, found, prior), rate=rate, least=least)


def predict(left: DataFrame, right: DataFrame, settings: dict | None = None, **options) -> DataFrame:
    """Every scored pair of records of probability ``least`` or more, with the options of ``score``."""
    return score(left, right, settings, **options).all_pairs()


def link(left: DataFrame, right: DataFrame, settings: dict | None = None, **options) -> DataFrame:
    """The best match of each incoming record with its cluster and tier."""
    best = score(left, right, settings, **options).best()
    if "source_table" in right.columns:
        best = best.join(right.select(F.col("unique_id").alias("unique_id_r"), "source_table"), "unique_id_r", "left")
    best = stage(best, "best")
    return attach(best, star_clusters(best)).withColumn("confidence_tier", tier(F.col("match_probability"), low=False))


def link_by_source(left: DataFrame, right: DataFrame, sources: list[str], **options) -> tuple[list[DataFrame], dict[str, str]]:
    """One plan for each source, where they must run apart; a source that fails is reported and skipped."""
    done, failed = [], {}
    for s in progress(sources, "sources"):
        try:
            done.append(link(left, right.where(F.col("source_table") == s), **options))
        except Exception as e:
            failed[s] = str(e)
    return done, failed
