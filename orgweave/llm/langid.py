"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle 1994).

A profile is the ``size`` most frequent 1- to 3-grams of letters, by rank. A text's distance to a language
adds, over the text's own profile, how far each n-gram is out of its place in the language's profile;
an n-gram that the language's profile lacks counts ``size``. The nearest language wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, ready

UNKNOWN = "und"


@dataclass(frozen=True)
class Profiles:
    """``sample``: about so many training texts of each language are read; a stated bound of the classifier."""

    size: int = 400
    sample: int = 3000


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams, ascending, and their counts; words are padded with a blank on either side."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[c]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of other characters only the first after a word stays
    x = np.concatenate([[32], np.where(letter, c, 32)[keep], [32]])
    solid = x != 32
    one = x[solid]
    two = (x[:-1] | x[1:] << 21)[solid[:-1] | solid[1:]]
    three = (x[:-2] | x[1:-1] << 21 | x[2:] << 42)[solid[1:-1]]
    grams = np.sort(np.concatenate([one, two, three]))
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.append(first, len(grams)))


def profile(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams by rank; of equal counts the smaller n-gram comes first."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


class Ranker:
    """Distances of texts to the profiles of languages, in name order."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.size, self.names = size, sorted(profiles)
        self.known = np.unique(np.concatenate([np.empty(0, np.int64), *profiles.values()]))
        self.rank = np.full((len(self.names), len(self.known)), -1, np.int64)
        for row, name in zip(self.rank, self.names, strict=True):
            row[np.searchsorted(self.known, profiles[name])] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language, the first by name of several, and 1 less its distance over the largest possible."""
        own = profile(*ngrams(text), self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        place = self.rank[:, at]
        missing = (place < 0) | (self.known[at] != own)
        distance = np.where(missing, self.size, np.abs(place - np.arange(len(own)))).sum(axis=1)
        best = int(distance.argmin())
        return self.names[best], float(1 - distance[best] / (self.size * len(own)))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, list] = {}

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        grams, inverse = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
        return grams, np.bincount(inverse, np.concatenate([x[1] for x in parts])).astype(np.int64)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total.setdefault(lang, []).append(ngrams(text))
            if len(total[lang]) > 256:
                total[lang] = [merged(total[lang])]
    for lang, parts in total.items():
        grams, n = merged(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])


def train(labelled: DataFrame, p: Profiles) -> dict[str, np.ndarray]:
    """Profiles from rows ``(lang, text, key)``: of each language the texts of the lowest hashes, about ``sample``.

    A language's share of texts follows from its number of rows, so no rows are ranked or moved to choose them.
    """
    rows = {r[0]: r[1] for r in labelled.groupBy("lang").agg(F.count("*")).collect()}
    if not rows:
        return {}
    share = F.create_map(*(F.lit(x) for lang, n in rows.items() for x in (lang, p.sample / n)))
    low = F.pmod(F.xxhash64("key"), F.lit(1 << 31)) / F.lit(float(1 << 31)) < F.element_at(share, F.col("lang"))
    few = labelled.where(low).select("lang", "text")
    counts = few.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("_k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("_k") <= p.size)
    out: dict[str, list[tuple[int, int]]] = {}
    for r in top.select("lang", "gram", "_k").collect():  # languages times size rows
        out.setdefault(r[0], []).append((r[2], r[1]))
    return {lang: np.array([g for _, g in sorted(v)], np.int64) for lang, v in out.items()}


def _predict(profiles: dict[str, np.ndarray], size: int, columns: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles, size)
        for batch in batches:
            out = [ranker.predict(t) for t in batch.column(text_col).to_pylist()]
            arrays = [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *arrays], [*columns, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, params: Profiles = Profiles(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every row of ``docs`` with ``held_out, lang_pred, score``.

    Profiles are learned from the rows whose crc32 of the id as text is not divisible by 5 and whose language
    and text are not null; the others are held out (a null id is neither learned from nor held out).
    ``lang_pred`` is ``und`` with score 0 for a null text, one without letters, or if nothing was learned.
    ``score`` is between 0 and 1, larger the closer. Of languages at equal distance the first in code point order wins,
    of n-grams of equal count the smaller ranks first. Repeated rows are predicted alike, and those learned from
    count once each. An empty table gives no rows. Columns of those three names are replaced, all others pass through.
    """
    ready(docs.sparkSession)
    crc = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    text = F.col(text_col)
    labelled = docs.where((crc != 0) & F.col(lang_col).isNotNull() & text.isNotNull())
    labelled = labelled.select(F.col(lang_col).alias("lang"), text.alias("text"), F.struct(F.col(id_col), text).alias("key"))
    profiles = train(labelled, params)
    kept = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")]
    own = fresh(docs, "text")
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(crc == 0, F.lit(False)).alias("held_out"), text.alias(own))
    schema = T.StructType([docs.schema[c] for c in kept]).add("held_out", "boolean").add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predict(profiles, params.size, [*kept, "held_out"], own), schema)
