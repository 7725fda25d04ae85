"""Comparisons: ordered levels compiled to Columns from a model's settings.

Settings are a dict as models are saved: comparisons of levels with an SQL condition and m and u. Their SQL may be
of the dialect that saved models use; it is translated. A level's number, gamma, is -1 for null, 0 for
ELSE and rises to the first level listed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import SIGNS, add_similarity, signs, upper_bound
from ..functions.text import match_weight

_JW = re.compile(r"jaro_winkler_similarity\(\s*`?(\w+)_l`?\s*,\s*`?(\w+)_r`?\s*\)\s*>=\s*([0-9.]+)", re.I)


# What a pair's conditions repeat, and a costly test that cheap ones precede.
_BOTH = re.compile(r"size\(array_intersect\(\s*(\w+)_l\s*,\s*(\w+)_r\s*\)\)")
_SORTED = re.compile(r"array_sort\((\w+)\) = array_sort\((\w+)\)")
# What a condition makes of one record alone.
_LOWER = re.compile(r"transform\((\w+)_([lr]), x -> lower\(x\)\)|\blower\((\w+)_([lr])\)")


_DENIED = re.compile(r"\bNOT\b|<|!|\bCASE\b|\bIF\b|= *(?:false|true)", re.I)


@dataclass(frozen=True)
class Level:
    condition: str
    m: float | None = None
    u: float | None = None
    is_null: bool = False
    tf_column: str | None = None
    tf_weight: float = 1.0


@dataclass(frozen=True)
class Comparison:
    name: str
    levels: tuple[Level, ...] = field(default_factory=tuple)

    @property
    def gammas(self) -> list[tuple[int, Level]]:
        """Levels that are evidence, with their numbers."""
        real = [x for x in self.levels if not x.is_null]
        return [(len(real) - 1 - k, x) for k, x in enumerate(real)]

    @property
    def columns(self) -> set[str]:
        return {c for x in self.levels for c in re.findall(r"(\w+)_[lr]\b", translate(x.condition))}


def translate(sql: str) -> str:
    """A condition in Spark's SQL: list functions by their Spark names, identifiers in backticks."""
    sql = re.sub(r'"(\w+)"', r"`\1`", sql)
    sql = re.sub(r"\barray_length\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*?)(?:,\s*1)?\)", r"size(\1)", sql)
    for old, new in (("len", "size"), ("list_intersect", "array_intersect"), ("list_sort", "array_sort"), ("list_contains", "array_contains"), ("list_transform", "transform")):
        sql = re.sub(rf"\b{old}\(", f"{new}(", sql)
    sql = re.sub(r"transform\(([^,]+),\s*lambda\s+(\w+)\s*:\s*", r"transform(\1, \2 -> ", sql)
    return " ".join(sql.split())


def comparisons(settings: dict) -> list[Comparison]:
    out = []
    for c in settings["comparisons"]:
        levels = tuple(
            Level(x["sql_condition"], x.get("m_probability"), x.get("u_probability"), bool(x.get("is_null_level")), x.get("tf_adjustment_column"), x.get("tf_adjustment_weight", 1.0)) for x in c["comparison_levels"]
        )
        out.append(Comparison(c["output_column_name"], levels))
    return out


def needed_columns(found: list[Comparison]) -> list[str]:
    return sorted(set().union(*(c.columns for c in found)))


def lowered(found: list[Comparison]) -> dict[str, Column]:
    """What conditions make of one record's columns, by names of their own: computed for records, pairs have them ready."""
    out = {}
    for c in found:
        for x in c.levels:
            for array, _, text, _ in _LOWER.findall(translate(x.condition)):
                out[f"_low_{array or text}"] = F.transform(array, F.lower) if array else F.lower(text)
    return out


def signed(found: list[Comparison]) -> dict[str, Column]:
    """Words of bits that tell of most pairs that they have nothing in common: of each array that is intersected a bit for the hash of
    every element, of each text whose Jaro-Winkler can weigh over one bit its ``signs``."""
    arrays = {a for c in found for x in c.levels for a, b in _BOTH.findall(translate(x.condition)) if a == b}
    bits = {f"_low_bits_{a}": F.expr(f"aggregate(`{a}`, 0L, (x, y) -> x | shiftleft(1L, cast(pmod(xxhash64(y), 64) AS int)))") for a in sorted(arrays)}
    texts = {a for c in found for _, x in c.gammas for a, _, _ in _JW.findall(translate(x.condition)) if match_weight(x.m, x.u) > 1}
    return bits | {f"_low_{k}_{a}": v for a in sorted(texts) for k, v in signs(a).items()}


def _shared(a: str, columns: list[str]) -> Column:
    """The size of both sides' intersection; without a bit in common it is empty."""
    size, bits = F.size(F.array_intersect(f"{a}_l", f"{a}_r")), [f"_low_bits_{a}_{s}" for s in "lr"]
    return F.when(F.col(bits[0]).bitwiseAND(F.col(bits[1])) == 0, 0).otherwise(size) if set(bits) <= set(columns) else size


def _most(column: str, columns: list[str]) -> Column:
    """What Jaro-Winkler can reach at most, by the ``signs`` of both where pairs have them."""
    known = [{k: F.col(f"_low_{k}_{column}_{s}") for k in SIGNS} for s in "lr"] if f"_low_{SIGNS[0]}_{column}_l" in columns else []
    return upper_bound(F.col(f"{column}_l"), F.col(f"{column}_r"), *known) + 1e-9


def _tests(c: Comparison, columns: list[str]) -> list[tuple[Column, Level, bool]]:
    """The levels with tests that hold wherever the level's does, a similarity being taken for its ``_most_``, and if a test is exact."""
    out = []
    for x in c.levels:
        sql = translate(x.condition)
        test = F.lit(True) if sql.upper() == "ELSE" else F.expr(sql if x.is_null else _ready(_fast(_JW.sub(r"`_most_\1` >= \3", sql)), columns))
        # a test that may deny a similarity is no bound
        sure = not _JW.search(sql)
        out.append((F.coalesce(test, F.lit(False)) if sure or not _DENIED.search(sql) else F.lit(True), x, sure))
    return out


def _ready(sql: str, columns: list[str]) -> str:
    """The condition over the columns of ``lowered`` where pairs have them."""

    def column(x: re.Match) -> str:
        name = f"_low_{x[1] or x[3]}_{x[2] or x[4]}"
        return f"`{name}`" if name in columns else x[0]

    return _LOWER.sub(column, sql)


def _fast(sql: str) -> str:
    """The condition over sizes of intersections that are columns; equal sorted arrays have equal sizes and smallest elements."""
    sql = _BOTH.sub(lambda x: f"`_both_{x[1]}`" if x[1] == x[2] else x[0], sql)
    return _SORTED.sub(r"(size(\1) = size(\2) AND array_min(\1) <=> array_min(\2) AND array_sort(\1) = array_sort(\2))", sql)


def gamma(c: Comparison, columns: list[str] = []) -> Column:  # noqa: B006
    """The comparison as one CASE; a condition that is null is false. It reads the columns that ``add_gammas`` adds before."""
    out = None
    for x in c.levels:
        if x.is_null:
            number, test = -1, F.coalesce(F.expr(translate(x.condition)), F.lit(False))
        else:
            number = next(k for k, y in c.gammas if y is x)
            if x.condition.strip().upper() == "ELSE":
                return F.lit(number) if out is None else out.otherwise(number)
            test = F.coalesce(F.expr(_ready(_fast(_JW.sub(r"`_jw_\1` >= \3", translate(x.condition))), columns)), F.lit(False))
        out = F.when(test, number) if out is None else out.when(test, number)
    return out.otherwise(0)


def _similar(c: Comparison) -> set[str]:
    """The columns whose Jaro-Winkler a comparison reads."""
    return {a for x in c.levels for a, _, _ in _JW.findall(translate(x.condition))}


def add_gammas(pairs: DataFrame, found: list[Comparison], reach: Callable[..., Column] | None = None) -> DataFrame:
    """``pairs`` with a ``gamma_`` column for each comparison.

    Jaro-Winkler is computed beforehand, for the pairs of values that may reach the lowest level, and so is each intersection, once.
    ``reach`` tells of a pair, by the gammas that are known and the comparisons that are not, if it can still matter. Names are then
    the last to be compared, and only of such pairs; in others a comparison that waits for its similarity has its ELSE. Pairs that have the
    columns of ``signed`` are left out before any similarity is computed, where the signs tell that they can't matter.
    """
    least: dict[str, float] = {}
    both: set[str] = set()
    for c in found:
        for x in c.levels:
            both.update(a for a, b in _BOTH.findall(translate(x.condition)) if a == b)
            for a, _, t in _JW.findall(translate(x.condition)):
                least[a] = min(least.get(a, 1.0), float(t))
    out = pairs.withColumns({f"_both_{a}": _shared(a, pairs.columns) for a in sorted(both)})
    last = "name_normalized" if reach and "name_normalized" in least else None
    done = []
    if last and f"_low_{SIGNS[0]}_{last}_l" in pairs.columns:
        done = [c for c in found if not _similar(c)]
        out = out.withColumns({f"_most_{a}": _most(a, pairs.columns) for a in least} | {f"gamma_{c.name}": gamma(c, pairs.columns) for c in done})
        may = F.coalesce(reach(done, [c for c in found if _similar(c)], lambda c: _tests(c, pairs.columns)), F.lit(True))
        # an expression that isn't deterministic stays behind the join, where it would be one test that computes shared parts again
        out = out.withColumn("_may", may & (F.spark_partition_id() >= 0)).where("_may").drop("_may", *(f"_most_{a}" for a in least))
    for column, t in least.items():
        if column != last:
            out = add_similarity(out, f"{column}_l", f"{column}_r", f"_jw_{column}", t)
    first, late = ([c for c in found if (last in _similar(c)) == waits] for waits in (False, True))
    out = out.withColumns({f"gamma_{c.name}": gamma(c, pairs.columns) for c in first if c not in done})
    if last:
        out = out.withColumn("_open", F.coalesce(reach(first, late), F.lit(True)))
        out = add_similarity(out, f"{last}_l", f"{last}_r", f"_jw_{last}", least[last], "_open")
        out = out.withColumns({f"gamma_{c.name}": gamma(c, pairs.columns) for c in late}).drop("_open")
    return out.drop(*(f"_jw_{c}" for c in least), *(f"_both_{a}" for a in both), *(c for c in pairs.columns if c.startswith("_low_")))
