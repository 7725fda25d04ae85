"""Near-duplicate embeddings by randomised-rotation binary codes with stored correction factors.

A unit vector is turned by random rotations; the signs of the turned components are its code. For the first
``factor_rotations`` of them the inner product of the vector with its own sign vector is stored. Divided
by that factor, the inner product of a code with another vector is an unbiased estimate of theirs, and its
error has a known bound (Gao and Long 2024, RaBitQ). Bands of code bits find candidates; the estimate and its
bound decide which of them are computed exactly, in double precision.

Equal vectors are one class. A bucket's pairs stay inside its task: what leaves is, for each member, how many
vectors it links with and one link into each part that its links form there. Buckets larger than ``block``
are dealt to tasks by pairs of blocks. A pair that shares several bands counts in the first only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from . import textvec
from .common import ready, stage


@dataclass(frozen=True)
class Rotation:
    """With bands of 24 bits a pair at cosine 0.98 shares one of 40 with probability 0.9999.

    ``sigmas`` is the width of the confidence bound in standard errors.
    """

    least: float = 0.98
    bands: int = 40
    band_bits: int = 24
    factor_rotations: int = 4
    sigmas: float = 4.5
    block: int = 2048
    seed: int = 20


@lru_cache(8)
def rotations(p: Rotation, dim: int) -> np.ndarray:
    """Orthonormal matrices, stacked: rows enough for all bands and, in whole matrices, for the factors."""
    rng = np.random.default_rng(p.seed)
    n = max(p.factor_rotations, -(-p.bands * p.band_bits // dim))
    return np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(n)])


def codes(unit: np.ndarray, p: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of all rotations, band keys, and correction factors."""
    n, dim = unit.shape
    turned = unit @ rotations(p, dim).T
    bits = turned >= 0
    k = p.factor_rotations * dim
    factor = np.abs(turned[:, :k]).reshape(n, p.factor_rotations, dim).sum(axis=2) / np.sqrt(dim)
    weight = (1 << np.arange(p.band_bits, dtype=np.int64))[::-1]
    keys = (bits[:, : p.bands * p.band_bits].reshape(n, p.bands, p.band_bits) @ weight).astype(np.int32)
    return np.packbits(bits[:, :k], axis=1), keys, factor


def estimator(packed: np.ndarray, factor: np.ndarray, dim: int, p: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """Vectors whose inner products with others estimate those of the coded ones, and the estimates' bounds."""
    k = p.factor_rotations
    sign = np.unpackbits(packed, axis=1, count=k * dim).astype(np.float64) * 2 - 1
    scale = np.repeat(1 / (factor * k * np.sqrt(dim)), dim, axis=1)
    error = np.sqrt(((1 - factor**2).clip(0) / factor**2).sum(axis=1) / max(dim - 1, 1)) / k
    return (sign * scale) @ rotations(p, dim)[: k * dim], p.sigmas * error


def _coded(p: Rotation):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.asarray(v, np.float64) for v in batch.column("v").to_pylist()]
            dims = np.array([len(v) for v in raw])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.stack([raw[i] for i in at])
                x = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                packed, keys, factor = codes(unit, p)
                salt = textvec.mix(np.arange(1, p.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                group = np.array(batch.column("g").take(pa.array(at)).to_pylist(), np.int64).view(np.uint64)
                bucket = textvec.mix(textvec.mix(keys.astype(np.uint64) ^ salt) + group[:, None]).view(np.int64)
                take = pa.array(at)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bucket.size + 1, p.bands, dtype=np.int32)), pa.array(bucket.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(take), batch.column("n").take(take), pa.array([u.tobytes() for u in unit]), pa.array([c.tobytes() for c in packed]), pa.array([f.tobytes() for f in factor]), lists],
                    ["id", "n", "unit", "code", "factor", "buckets"],
                )

    return run


def _links(p: Rotation):
    """Over rows sorted by bucket and block pair: ``(id, links, root)`` for each member with a link."""

    def pairs(unit: np.ndarray, est: np.ndarray, bound: np.ndarray, keys: np.ndarray, me: int, x: np.ndarray, y: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a in range(0, len(x), 256):
            xs = x[a : a + 256]
            i, j = np.nonzero(est[xs] @ unit[y].T + bound[xs, None] >= p.least)
            i, j = xs[i], y[j]
            if same:
                i, j = i[i < j], j[i < j]
            for b in range(0, len(i), 1 << 16):
                s, t = i[b : b + (1 << 16)], j[b : b + (1 << 16)]
                first = np.take_along_axis(keys[s], np.argmax(keys[s] == keys[t], axis=1)[:, None], axis=1)[:, 0]
                ok = (first == me) & (np.einsum("ij,ij->i", unit[s], unit[t]) >= p.least)
                yield s[ok], t[ok]

    def bucket(me: int, rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        ids = np.array([r[2] for r in rows])
        weight = np.array([r[3] for r in rows])
        unit = np.frombuffer(b"".join(r[4] for r in rows)).reshape(len(rows), -1)
        packed = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(len(rows), -1)
        factor = np.frombuffer(b"".join(r[6] for r in rows)).reshape(len(rows), -1)
        keys = np.array([r[7] for r in rows])
        est, bound = estimator(packed, factor, unit.shape[1], p)
        side = np.array([r[8] for r in rows])
        lo, hi = rows[0][9], rows[0][10]
        x, y = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
        count = np.zeros(len(rows), np.int64)
        root = np.arange(len(rows))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for s, t in pairs(unit, est, bound, keys, me, x, y, lo == hi):
            np.add.at(count, s, weight[t])
            np.add.at(count, t, weight[s])
            for a, b in zip(s.tolist(), t.tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        for k in np.flatnonzero(count):
            yield int(ids[k]), int(count[k]), int(ids[find(k)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int, int]] = []

        def drain() -> pa.RecordBatch:
            cols = [pa.array([r[k] for r in out], pa.int64()) for k in range(3)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, ["id", "links", "root"])

        for row in textvec.arrow_rows(batches, "bucket", "pair", "id", "n", "unit", "code", "factor", "buckets", "side", "lo", "hi"):
            if held and held[0][:2] != row[:2]:
                if len(held) > 1:
                    out += bucket(held[0][0], held)
                held = []
            held.append(row)
            if len(out) > 50_000:
                yield drain()
        if len(held) > 1:
            out += bucket(held[0][0], held)
        yield drain()

    return run


def near_vectors(vectors: DataFrame, params: Rotation = Rotation(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows are compared only if their labels are equal and not null and their vectors have equal length. A null,
    empty or zero vector, and one with a null or non-finite component, links with nothing, as does a row
    with a null id (null component, kept). Every row is a vector of its own: rows that repeat an id count and
    link one by one, each with its own component; equal rows link with one another. The component is named by its
    smallest id, so ties don't arise. An empty table gives no rows. Other columns are not read.
    """
    p = params
    ready(vectors.sparkSession)
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("ok", F.coalesce(fine, F.lit(False)))
    good = rows.where("ok")
    # a class has a number of its own, since rows of one id may lie in several classes; 0.0 and -0.0 are grouped as equal
    classes = good.groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    coded = classes.select("id", "n", "v", F.xxhash64("label", F.size("v")).alias("g"))
    coded = stage(coded.mapInArrow(_coded(p), "id long, n long, unit binary, code binary, factor binary, buckets array<long>"), "codes")
    member = coded.select("id", F.explode("buckets").alias("bucket"))
    full = member.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    member = member.join(full, "bucket").withColumn("parts", F.ceil(F.col("m") / p.block).cast("int"))
    member = member.withColumn("side", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    member = member.select("id", "bucket", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    member = member.withColumn("pair", F.concat_ws("-", "lo", "hi"))
    dealt = member.join(coded, "id").repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")
    found = stage(dealt.mapInArrow(_links(p), "id long, links long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = stage(components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))), "components")
    named = comp.join(classes.select("id", "least"), "id").groupBy("component_id").agg(F.min("least").alias("name"))
    comp = comp.join(named, "component_id").select("id", F.col("name").alias("component_id"))
    known = classes.join(links, "id", "left").join(comp, "id", "left")
    known = known.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    out = rows.alias("r").join(known.alias("k"), F.col("r.ok") & (F.col("r.label") == F.col("k.label")) & (F.col("r.v") == F.col("k.v")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
