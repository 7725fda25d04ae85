"""Removal of passages that repeat across documents, by sliding spans of consecutive sentences.

Texts are cut into sentences: after a word that ends in ``.``, ``!`` or ``?`` and at a line break. A sentence of
over ``long`` words is cut further, at places that depend on nothing but its words, so a passage is cut alike wherever
it stands, even when it begins in the middle of a sentence: after a word whose hash is 0 modulo ``anchor``, and, of
``gap`` words on end without a cut, after the one of least hash. What is then still longer, as in one word said over and
over, is cut every ``longest`` words.

A run is several consecutive sentences, at least ``sentences`` and ``words`` words. Every run is covered by the shortest
ones inside it: those that start at each of its sentences, and the one that reaches up to its end. A repeated
run holds only repeated ones, and later occurrences hold later ones, so hashing the shortest runs from each
sentence on and up to each sentence's end removes what hashing all runs would. A text that is shorter than any run is
hashed whole.

Hashes meet globally; each run but the first of its kind, by document id and place, removes the sentences it covers.
Hashes with more than a thousandth of all rows, which are fewer than a thousand, are salted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec
from .common import fresh, ready, stage

#: A hash is hot from this share of all rows on, as one of so many; its rows are dealt to so many salts.
HOT, SALTS = 1000, 64
_STEP = 0xC2B2AE3D27D4EB4F
_BACK = pow(_STEP, -1, 1 << 64)


@dataclass(frozen=True)
class Spans:
    """With these any passage of 51 words or more holds a common run wherever it stands: up to 16 words at either end may be cut otherwise."""

    sentences: int = 2
    words: int = 16
    long: int = 16
    anchor: int = 10
    gap: int = 15
    longest: int = 32


class Cut(NamedTuple):
    """Of one text: the byte where each sentence begins, words before each, and each span's first sentence, end and hash, in that order."""

    at: np.ndarray
    words: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hash: np.ndarray


def _bridge(ends: np.ndarray, w: textvec.Words, gap: int, long: np.ndarray) -> None:
    """Adds an end to every ``gap`` words of one long sentence that have none, by those words alone; words that are all one are left."""
    n = len(ends)
    if n < gap:
        return
    before = np.zeros(n + 1, np.int64)
    np.cumsum(ends, out=before[1:])
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    bare = np.flatnonzero((before[gap:] == before[:-gap]) & (text[gap - 1 :] == text[: n - gap + 1]) & long[: n - gap + 1])
    window = np.lib.stride_tricks.sliding_window_view(w.hash, gap)
    for k in range(0, len(bare), 1 << 16):
        at = bare[k : k + (1 << 16)]
        h = window[at][:, ::-1]
        pick = at + gap - 1 - h.argmin(axis=1)
        ends[pick[(h != h[:, :1]).any(axis=1)]] = True


def cut(texts: list[bytes], p: Spans) -> Iterator[Cut]:
    w = textvec.words(texts)
    lines = np.zeros(len(w.buffer) + 1, np.int32)
    np.cumsum(w.buffer == 10, out=lines[1:])
    n = len(w.start)
    ends = np.isin(w.buffer[w.end - 1], np.frombuffer(b".!?", np.uint8))
    if n:
        ends[:-1] |= lines[w.start[1:]] > lines[w.end[:-1]]
        close = ends.copy()
        close[w.first[1:][w.first[1:] > 0] - 1] = True
        sentence = np.concatenate([[0], np.cumsum(close)[:-1]])
        long = (np.bincount(sentence) > p.long)[sentence]
        ends |= long & (w.hash % np.uint64(p.anchor) == 0)
        _bridge(ends, w, p.gap, long)
    sums = np.zeros(n + 1, np.uint64)
    log2 = max(1, n.bit_length())
    np.cumsum(w.hash * textvec._powers(log2, _STEP)[:n], out=sums[1:])
    back = textvec._powers(log2, _BACK)
    for d, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
        head = np.flatnonzero(ends[a : b - 1]) + 1 if b > a else np.empty(0, np.int64)
        bound = np.concatenate([[0], head, [b - a]]) if b > a else np.zeros(1, np.int64)
        if len(bound) > 1 and np.diff(bound).max() > p.longest:
            bound = np.concatenate([*(np.arange(x, y, p.longest) for x, y in zip(bound[:-1], bound[1:], strict=True)), bound[-1:]])
        k = len(bound) - 1
        on = np.maximum(np.arange(k) + p.sentences, np.searchsorted(bound, bound[:-1] + p.words))
        up = np.minimum(np.arange(1, k + 1) - p.sentences, np.searchsorted(bound, bound[1:] - p.words, side="right") - 1)
        head, tail = np.flatnonzero(on <= k), np.flatnonzero(up >= 0)
        tail = tail[on[up[tail]] != tail + 1]
        first, last = np.concatenate([head, up[tail]]), np.concatenate([on[head], tail + 1])
        if k and not len(first):
            first, last = np.zeros(1, np.int64), np.full(1, k)
        order = np.lexsort((last, first))
        first, last = first[order], last[order]
        s, e = a + bound[first], a + bound[last]
        hashed = textvec.mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))
        at = w.start[a + bound[:-1]] - w.text_start[d]
        at[:1] = 0
        yield Cut(at, bound, first, last, hashed.view(np.int64))


def _spans(p: Spans):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in textvec.blocks(textvec.arrow_rows(batches, "id", "th", "text"), 2):
            ids, versions, starts, hashes = [], [], [], []
            for row, c in zip(rows, cut(texts, p), strict=True):
                ids.append(np.full(len(c.hash), row[0]))
                versions.append(np.full(len(c.hash), row[1]))
                starts.append(np.arange(len(c.hash), dtype=np.int32))
                hashes.append(c.hash)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hashes, ids, versions, starts)], ["h", "id", "th", "a"])

    return run


def _remove(p: Spans, columns: list[str], text_col: str, spans_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, spans = batch.column(text_col).to_pylist(), batch.column(spans_col).to_pylist()
            out: list[str | None] = []
            counts = np.zeros((len(text), 3), np.int64)
            for group in _runs(text):
                part = [(t or "").encode("utf-8", "surrogatepass") for t in text[group]]
                for i, raw, c in zip(range(group.start, group.stop), part, cut(part, p), strict=True):
                    counts[i, 0] = len(c.at)
                    if not spans[i]:
                        out.append(text[i])
                        continue
                    where = np.asarray(spans[i], np.int64)
                    turn = np.zeros(len(c.at) + 1, np.int64)
                    np.add.at(turn, c.first[where], 1)
                    np.add.at(turn, c.last[where], -1)
                    gone = np.cumsum(turn[:-1]) > 0
                    edge = np.append(c.at, len(raw))
                    out.append(b"".join(raw[edge[k] : edge[k + 1]] for k in np.flatnonzero(~gone)).decode("utf-8", "surrogatepass"))
                    counts[i, 1:] = gone.sum(), np.diff(c.words)[gone].sum()
            arrays = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(out, pa.string()), *(pa.array(np.ascontiguousarray(counts[:, k])) for k in range(3))], [*columns, text_col, "n_sentences", "n_removed", "words_removed"])

    return run


def _runs(text: list[str | None]) -> Iterator[slice]:
    """Slices of about a block of text."""
    a = size = 0
    for i, t in enumerate(text):
        if i > a and size + len(t or "") > textvec.BLOCK:
            yield slice(a, i)
            a, size = i, 0
        size += len(t or "")
    if a < len(text):
        yield slice(a, len(text))


def remove_repeats(docs: DataFrame, params: Spans = Spans(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its text less the repeated sentences, and ``n_sentences, n_removed, words_removed``.

    The first occurrence of a run, by id (a null id last), text and place, stays; all others go, in the same
    document too. A text without repeats comes back unchanged, a null text null; a text that is repeated
    whole, however short, becomes empty. Rows of equal id and text are one document and are cut alike, so none of them is
    emptied for the other's sake. An empty table gives no rows. Other columns are passed through, whatever their
    names, save that the three counts replace columns of those names.
    """
    ready(docs.sparkSession)
    p = params
    counts = ["n_sentences", "n_removed", "words_removed"]
    kept = [c for c in docs.columns if c not in (text_col, *counts)]
    order = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    version = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    slim = docs.where(F.col(text_col).isNotNull()).select(order.alias("id"), version.alias("th"), F.col(text_col).alias("text"))
    spans = slim.mapInArrow(_spans(p), "h long, id long, th long, a int")
    spans = stage(spans, "spans")
    # counts first: only spans that repeat are then told apart by document and place
    repeated = stage(spans.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.col("n") * HOT > total
    salts = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    few = repeated.where(hot).select("h", F.lit(True).alias("hot"))  # fewer than HOT rows
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "th", "a"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    spans = spans.join(F.broadcast(few), "h", "left").withColumn("salt", salt)
    spans = stage(spans.join(repeated.select("h", hot.alias("hot")).select("h", salts), ["h", "salt"], "left_semi"), "repeats")
    first = spans.groupBy("h").agg(F.min(F.struct("id", "th", "a")).alias("f"), F.coalesce(F.bool_or("hot"), F.lit(False)).alias("hot"))
    again = spans.drop("hot").join(stage(first, "first").select("h", "f", salts), ["h", "salt"]).where(F.struct("id", "th", "a") != F.col("f"))
    # a list for each document, of its own spans
    i, t, i0, t0, own, marks = (fresh(docs, x) for x in ("id", "th", "id0", "th0", "text0", "spans"))
    cover = again.groupBy(F.col("id").alias(i), F.col("th").alias(t)).agg(F.collect_set("a").alias(marks))
    full = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(text_col).alias(own), order.alias(i0), version.alias(t0))
    full = full.join(cover, (F.col(i0) == F.col(i)) & (F.col(t0) == F.col(t)), "left").select(*(F.col(f"`{c}`") for c in kept), own, marks)
    schema = T.StructType([docs.schema[c] for c in kept]).add(own, "string")
    for c in counts:
        schema = schema.add(c, "long")
    out = full.mapInArrow(_remove(p, kept, own, marks), schema)
    back = [F.col(own).alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in counts]
    return out.select(*back, *counts)
