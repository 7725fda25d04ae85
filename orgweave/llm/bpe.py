"""Byte-level BPE: encoding of whole texts in overlapping chunks, and decoding.

A text of at most ``chunk`` characters is one piece. A longer one is cut into chunks that overlap, and each
chunk is pre-tokenised on its own, in parallel. Two neighbours resynchronise where both have a pre-token
boundary in their overlap: from there on they read the same text by the same pattern, so the boundary is
one of the whole text too. There the text is stitched, and the pieces between stitches are encoded. A boundary
is trusted only if the chunk before was itself in step; from the first stitch that fails, the rest of that
text is put together again and encoded whole.

The ids equal those of the whole text: the pattern looks ahead only from white space, and pieces end in another
character.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec
from .common import ready


@dataclass(frozen=True)
class Bpe:
    """``ranks``: a file of base64 tokens and ranks; every executor must have it at that path."""

    ranks: str
    pattern: str
    chunk: int = 1 << 15
    overlap: int = 1 << 10


class Codec:
    """Encodes and decodes by one vocabulary."""

    def __init__(self, p: Bpe):
        import tiktoken

        with open(p.ranks, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=p.pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.name_of = [str(k) for k in range(size)]

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: Iterable[int]) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids])

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        """``n_tokens, ids_sha256, decoded_sha256``"""
        names = self.name_of
        joined = " ".join([names[i] for i in ids]).encode()
        return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


@lru_cache(4)
def codec(p: Bpe) -> Codec:
    return Codec(p)


@lru_cache(4)
def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)


def chunks(text: str, p: Bpe) -> Iterator[tuple[int, int, str]]:
    """``(number, first character, text)`` of overlapping chunks."""
    for k, a in enumerate(range(0, len(text), p.chunk)):
        yield k, a, text[a : a + p.chunk + p.overlap]


def edges(k: int, a: int, text: str, p: Bpe, last: bool) -> tuple[list[int], list[int]]:
    """Pre-token boundaries of a chunk in its overlap with the chunk before, and in that with the chunk after.

    A boundary within the chunk's last two pre-tokens may be due to the chunk's end and isn't used, nor is one
    after white space: at the end of a piece two pre-tokens of white space would be read as one.
    """
    starts = [m.start() for m in _compiled(p.pattern).finditer(text)]
    safe = lambda s: s > 0 and not text[s - 1].isspace()
    head = [a + s for s in starts if s < p.overlap and safe(s)] if k else []
    tail = [] if last else [a + s for s in starts[:-2] if s >= p.chunk and safe(s)]
    return head, tail


def _cut(p: Bpe):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, text in textvec.arrow_rows(batches, "key", "text"):
            for k, a, part in chunks(text, p):
                last = a + p.chunk >= len(text)
                yield pa.RecordBatch.from_pydict({"key": [key], "k": pa.array([k], pa.int32()), "a": pa.array([a], pa.int64()), "last": [last], "part": [part]})

    return run


def _edges(p: Bpe):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, k, a, last, part in textvec.arrow_rows(batches, "key", "k", "a", "last", "part"):
            head, tail = edges(k, a, part, p, last)
            yield pa.RecordBatch.from_pydict({"key": [key], "k": pa.array([k], pa.int32()), "a": pa.array([a], pa.int64()), "part": [part], "head": pa.array([head], pa.list_(pa.int64())), "tail": pa.array([tail], pa.list_(pa.int64()))})

    return run


def _pieces(p: Bpe):
    """Encodes the pieces; those after a stitch that failed stay text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(p)
        for key, k, piece, sure in textvec.arrow_rows(batches, "key", "k", "piece", "sure"):
            ids = np.asarray(c.encode(piece), np.int32).tobytes() if sure else None
            yield pa.RecordBatch.from_pydict({"key": [key], "k": pa.array([k], pa.int32()), "ids": pa.array([ids], pa.binary()), "raw": pa.array([None if sure else piece], pa.string())})

    return run


_OUT = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _gathered(p: Bpe):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        c = codec(p)
        rows = sorted(zip(*(table.column(x).to_pylist() for x in ("k", "ids", "raw")), strict=True))
        ids: list[int] = []
        for _, x, _ in rows:
            ids += np.frombuffer(x or b"", np.int32).tolist()
        rest = "".join(raw for _, _, raw in rows if raw is not None)
        n, a, b = c.digest(ids + c.encode(rest))
        return pa.table({"key": key, "n_tokens": [n], "ids_sha256": [a], "decoded_sha256": [b]})

    return run


def _short(p: Bpe, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(p)
        for batch in batches:
            out = [c.digest(c.encode(t or "")) for t in batch.column("_text").to_pylist()]
            arrays = [pa.array([x[k] for x in out], f.type) for k, f in enumerate(_OUT)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *arrays], [*names, *_OUT.names])

    return run


def encode_documents(docs: DataFrame, params: Bpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` for every row of ``docs``.

    A null text is empty: no tokens and the digests of nothing. The digests are of the decimal ids joined by one
    space and of the bytes that the ids decode to. Rows of equal id and text are encoded alike, once if they
    are long. Other columns are not read.
    """
    ready(docs.sparkSession)
    p = params
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    kind = dict(rows.dtypes)[id_col]
    result = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    long = F.length("_text") > p.chunk
    short = rows.where(~F.coalesce(long, F.lit(False))).mapInArrow(_short(p, [id_col]), f"`{id_col}` {kind}, {result}")
    big = rows.where(long).withColumn("key", F.sha2(F.col("_text").cast("binary"), 256))
    # copies of a long text are encoded once
    texts = big.groupBy("key").agg(F.min("_text").alias("text"))
    parts = texts.mapInArrow(_cut(p), "key string, k int, a long, last boolean, part string").repartition("key", "k")
    marks = parts.mapInArrow(_edges(p), "key string, k int, a long, part string, head array<long>, tail array<long>")
    order = Window.partitionBy("key").orderBy("k")
    met = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    marks = marks.withColumn("end", met).withColumn("more", F.lead("k").over(order).isNotNull())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("sure_start", F.coalesce(F.min(F.col("end").isNotNull()).over(before), F.lit(True)))
    sure = F.col("sure_start") & (F.col("end").isNotNull() | ~F.col("more"))
    # a piece runs from the last stitch to the next; after a failed stitch chunks are joined without their overlap
    last_end = F.lag("end").over(order)
    start = F.when(F.col("sure_start"), F.coalesce(last_end, F.col("a"))).otherwise(F.col("a"))
    stop = F.when(sure & F.col("more"), F.col("end")).when(F.col("more"), F.col("a") + p.chunk).otherwise(F.col("a") + F.length("part"))
    marks = marks.select("key", "k", "a", "part", sure.alias("sure"), start.alias("s"), stop.alias("e"))
    piece = F.substring(F.col("part"), (F.col("s") - F.col("a") + 1).cast("int"), F.greatest(F.col("e") - F.col("s"), F.lit(0)).cast("int"))
    pieces = marks.select("key", "k", piece.alias("piece"), "sure").repartition("key", "k")
    coded = pieces.mapInArrow(_pieces(p), "key string, k int, ids binary, raw string")
    whole = coded.groupBy("key").applyInArrow(_gathered(p), f"key string, {result}")
    return short.unionByName(big.select(id_col, "key").join(whole, "key").drop("key"))
