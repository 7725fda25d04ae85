"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

Every document becomes a set of word shingles. Documents with equal sets form one class. Each class
has ``bands * rows`` MinHash samples; a band of equal samples puts classes into one bucket. The samples
are also folded into an odd sketch: bit ``hash(i, sample_i)`` is flipped for each sample, so the XOR of
two sketches holds the parity of the samples in which they differ, and its population count estimates a
high similarity closely (Mitzenmacher, Pagh and Pham 2014). A pair is confirmed on its full sets only if
its estimate comes within ``slack`` standard errors of the threshold.

Buckets are never expanded into all pairs. First every member is compared with one star of its bucket,
chosen by a hash so that it differs from band to band; members that then still lie in different
components are compared across components. Before that, shingles that no other set of those members holds
are counted: they bound each set's similarity to any other exactly, and rule out many. The rest of a bucket meets in
tasks, in pairs of bounded blocks, where full sets are intersected as matrix products; only links come out.
A link inside a component changes nothing, so nothing that matters is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from . import textvec
from .common import ready, stage

#: Bits of an odd sketch, held in four longs.
SKETCH_BITS = 256
#: Members and shingles of a block, where a bucket's members are compared across components.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1_000_000


@dataclass(frozen=True)
class Near:
    """``percent``: least similarity in hundredths. 25 bands of 5 find a pair at 0.80 with probability 0.99995, at 0.85 with 0.9999996."""

    shingle: int = 5
    percent: int = 80
    bands: int = 25
    rows: int = 5
    slack: float = 4.5

    @property
    def most_bits(self) -> int:
        """The largest XOR population count of a pair that may reach the threshold."""
        k, j = self.bands * self.rows, self.percent / 100
        j = max(0.0, j - self.slack * math.sqrt(j * (1 - j) / k))
        share = (1 - math.exp(-4 * k * (1 - j) / SKETCH_BITS)) / 2
        return math.ceil(SKETCH_BITS * share + self.slack * math.sqrt(SKETCH_BITS * share * (1 - share)) / 2)


def shingle_hashes(w: textvec.Words, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; a shorter text is one shingle."""
    h, first = w.hash, w.first
    odd = [np.uint64((2 * k + 3) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) for k in range(size)]
    n = len(h) - size + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        rolled += h[k : k + n] * odd[k]
    rolled = textvec.mix(rolled)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            x = np.sort(rolled[a : b - size + 1])
            keep = np.empty(len(x), bool)
            keep[:1] = True
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        elif b > a:
            whole = sum(int(v) * (2 * k + 3) for k, v in enumerate(h[a:b])) + int(b - a)
            out.append(textvec.mix(np.array([whole & 0xFFFFFFFFFFFFFFFF], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _samplers(p: Near) -> tuple[np.ndarray, np.ndarray]:
    k = p.bands * p.rows
    return textvec.mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), textvec.mix(np.arange(7_001, 7_001 + k, dtype=np.uint64)) | np.uint64(1)


def samples(x: np.ndarray, flip: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """MinHash samples of one set; long sets are taken in pieces."""
    out = np.full(len(flip), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(x), 4096):
        np.minimum(out, ((x[a : a + 4096, None] ^ flip) * odd).min(axis=0), out=out)
    return out


def odd_sketch(s: np.ndarray) -> np.ndarray:
    """Four 64-bit words of parities."""
    bit = textvec.mix(s ^ (np.arange(len(s), dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))) % np.uint64(SKETCH_BITS)
    parity = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def _signatures(p: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flip, odd = _samplers(p)
        salt = textvec.mix(np.arange(101, 101 + p.bands, dtype=np.uint64))
        step = textvec.mix(np.arange(1, p.rows + 1, dtype=np.uint64)) | np.uint64(1)
        for rows, texts in textvec.blocks(textvec.arrow_rows(batches, "rid", "doc", "text"), 2):
            sets = shingle_hashes(textvec.words(texts), p.shingle)
            n = len(sets)
            key, sketch = np.zeros((n, 2), np.int64), np.zeros((n, 4), np.int64)
            band = np.zeros((n, p.bands), np.int64)
            for i, x in enumerate(sets):
                if len(x):
                    s = samples(x, flip, odd)
                    key[i] = np.array([textvec.mix(x).sum(dtype=np.uint64), np.bitwise_xor.reduce(x)], np.uint64).view(np.int64)
                    sketch[i] = odd_sketch(s)
                    band[i] = textvec.mix((s.reshape(p.bands, p.rows) * step).sum(axis=1, dtype=np.uint64) + salt).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * p.bands + 1, p.bands, dtype=np.int32)), pa.array(band.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array(key[:, 0]), pa.array(key[:, 1]), *(pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(4)), lists],
                ["id", "doc", "n_shingles", "k0", "k1", "s0", "s1", "s2", "s3", "bands"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in textvec.blocks(textvec.arrow_rows(batches, "id", "text"), 1):
            sets = shingle_hashes(textvec.words(texts), size)
            off = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([len(x) for x in sets], out=off[1:])
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))], ["id", "set"])

    return run


def _close(p: Near, x: str, y: str):
    bits = sum((F.bit_count(F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}"))) for k in range(4)), F.lit(0))
    nx, ny = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    return (bits <= p.most_bits) & (100 * F.least(nx, ny) >= p.percent * F.greatest(nx, ny))


def _linkable(p: Near, sets: DataFrame) -> DataFrame:
    """``(id, n)`` of those sets that may link with another here: enough of their ``n`` elements are in another set too.

    What no other set holds is in no intersection, so this bound is exact.
    """
    each = sets.select("id", F.explode("set").alias("g"))
    common = each.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
    shared = each.join(common, "g").groupBy("id").agg(F.count("*").alias("shared"))
    return shared.join(sets.select("id", F.size("set").alias("n")), "id").where(100 * F.col("shared") >= p.percent * F.col("n")).select("id", "n")


def _shared_counts(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets x with sets y, as products of 0-1 matrices over the elements that several sets hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(x), len(y)), np.float32)
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[a:b], column[a:b] - first] = 1
        out += m[x] @ m[y].T
    return out


def _across(p: Near):
    """Over rows sorted by bucket and block pair: one confirmed link for each two components that have any there."""

    def bucket(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        ids, comp, side = (np.array([r[k] for r in rows]) for k in (3, 4, 5))
        sets = [r[6] for r in rows]
        x, y = np.flatnonzero(side == rows[0][1]), np.flatnonzero(side == rows[0][2])
        if not len(x) or not len(y) or len(np.unique(comp)) < 2:
            return
        size = np.array([len(s) for s in sets])
        for part in range(0, len(x), 512):
            xs = x[part : part + 512]
            use = np.unique(np.concatenate([xs, y]))
            common = _shared_counts([sets[k] for k in use], np.searchsorted(use, xs), np.searchsorted(use, y))
            i, j = np.nonzero((100 * common >= p.percent * (size[xs][:, None] + size[y][None, :] - common)) & (comp[xs][:, None] != comp[y][None, :]))
            s, t = xs[i], y[j]
            pair = np.stack([np.minimum(comp[s], comp[t]), np.maximum(comp[s], comp[t])], axis=1)
            _, one = np.unique(pair, axis=0, return_index=True)
            yield from zip(ids[s[one]].tolist(), ids[t[one]].tolist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int]] = []
        for batch in batches:
            lists = batch.column("set")
            off, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            columns = [batch.column(c).to_pylist() for c in ("key", "lo", "hi", "id", "c", "side")]
            for k, row in enumerate(zip(*columns, strict=True)):
                if held and held[0][:3] != row[:3]:
                    out += bucket(held)
                    held = []
                held.append((*row, flat[off[k] : off[k + 1]].copy()))
        if held:
            out += bucket(held)
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in range(2)], ["a", "b"])

    return run


def near_rows(rows: DataFrame, params: Near = Near()) -> DataFrame:
    """``(rid, doc, n_shingles, root, name)`` for rows ``(rid, doc, text)`` of a written table with unique numbers ``rid``.

    ``root`` is the smallest ``rid`` that links lead to, itself included, and ``name`` the smallest ``doc``
    there, null if all are null.
    """
    p = params
    slim = rows.select(F.col("rid").alias("id"), "text")
    sig = rows.select("rid", "doc", "text").mapInArrow(_signatures(p), "id long, doc long, n_shingles long, k0 long, k1 long, s0 long, s1 long, s2 long, s3 long, bands array<long>")
    sig = stage(sig, "signatures")
    full = sig.where("n_shingles > 0")
    # one class for each distinct set, under its smallest id
    reps = full.groupBy("n_shingles", "k0", "k1").agg(F.min("doc").alias("least"), F.min(F.struct("id", "s0", "s1", "s2", "s3", "bands")).alias("x"))
    reps = stage(reps.select("n_shingles", "k0", "k1", "least", "x.*"), "classes")
    sketch = reps.select("id", "n_shingles", "s0", "s1", "s2", "s3")
    member = reps.select("id", F.explode("bands").alias("key"))
    star = member.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", "key").alias("h"), "id")).alias("m"), F.count("*").alias("n")).where("n > 1").select("key", F.col("m.id").alias("star"))
    held = stage(member.join(star, "key"), "buckets")  # buckets of one class are gone

    def candidates(pairs: DataFrame) -> DataFrame:
        """(a, b) pairs whose sizes and sketches allow a link."""
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct()
        out = pairs.join(sketch.alias("p"), F.col("a") == F.col("p.id")).join(sketch.alias("q"), F.col("b") == F.col("q.id"))
        return out.where(_close(p, "p", "q")).select("a", "b")

    stars = stage(candidates(held.select(F.col("id").alias("x"), F.col("star").alias("y"))), "stars")
    sets = stage(slim.join(held.select("id").distinct(), "id", "left_semi").mapInArrow(_sets(p.shingle), "id long, set array<long>"), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b").join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
        common = F.size(F.array_intersect("sa", "sb"))
        return both.where(100 * common >= p.percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")

    def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
        """Pairs whose ends are not yet in one component."""
        c = comp.select("id", F.col("component_id").alias("c"))
        return pairs.join(c.withColumnsRenamed({"id": "a", "c": "ca"}), "a", "left").join(c.withColumnsRenamed({"id": "b", "c": "cb"}), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    # one star for each class first, then the other stars where they could still join components
    first = stars.groupBy("b").agg(F.min("a").alias("a"))
    links = stage(confirmed(first), "confirmed")
    comp = stage(components(links), "components")
    more = stage(confirmed(apart(stars, comp)), "confirmed")
    if not more.isEmpty():
        links = links.unionByName(more)
        comp = stage(components(links), "components")
    # what the stars of a bucket left in different components
    inside = held.join(comp, "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("c"))
    mixed = inside.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n")).where("lo < hi and n > 2").select("key")
    open_ = stage(inside.join(mixed, "key"), "open")
    linkable = stage(_linkable(p, sets.join(open_.select("id").distinct(), "id", "left_semi")), "linkable")
    open_ = open_.join(linkable, "id")
    crowd = open_.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("all")).where("lo < hi")
    parts = F.ceil(F.greatest(F.col("m") / BLOCK_ROWS, F.col("all") / BLOCK_SHINGLES)).cast("int")
    dealt = open_.join(crowd.select("key", parts.alias("parts")), "key")
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", "id", "c", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    dealt = dealt.join(sets, "id").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    more = stage(dealt.select("key", "lo", "hi", "id", "c", "side", "set").mapInArrow(_across(p), "a long, b long"), "confirmed")
    if not more.isEmpty():
        comp = stage(components(links.unionByName(more)), "components")
    named = reps.select("n_shingles", "k0", "k1", "id", "least").join(comp, "id", "left").withColumn("root", F.coalesce("component_id", "id"))
    name = named.where("component_id is not null").groupBy("component_id").agg(F.min("least").alias("name"))
    named = named.join(name, "component_id", "left").select("n_shingles", "k0", "k1", "root", F.when(F.col("component_id").isNull(), F.col("least")).otherwise(F.col("name")).alias("name"))
    out = sig.select("id", "doc", "n_shingles", "k0", "k1").join(named, ["n_shingles", "k0", "k1"], "left")
    some = F.col("n_shingles") > 0
    return out.select(F.col("id").alias("rid"), "doc", "n_shingles", F.when(some, F.col("root")).otherwise(F.col("id")).alias("root"), F.when(some, F.col("name")).otherwise(F.col("doc")).alias("name"))


def near_duplicates(docs: DataFrame, params: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``docs``.

    A null or blank text has no shingles and links with nothing; a text of fewer words than a shingle
    is one shingle. Every row is a document of its own, also if it repeats another's id or both id and text: rows of
    one id lie in one component only if their texts are linked. ``component_id`` is the smallest id in the component, null
    if all are null; of a component without ids its first row is kept, otherwise each row whose id is
    ``component_id``. Other columns are not read. An empty table gives no rows.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    out = near_rows(stage(rows, "documents"), params)
    kept = F.when(F.col("name").isNull(), F.col("rid") == F.col("root")).otherwise(F.coalesce(F.col("doc") == F.col("name"), F.lit(False)))
    return out.select(F.col("doc").alias(id_col), "n_shingles", F.col("name").alias("component_id"), kept.alias("kept"))
