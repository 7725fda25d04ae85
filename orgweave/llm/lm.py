"""A log-bilinear neural language model over words, trained by noise-contrastive estimation, and add-one unigram scores.

The outputs are the most frequent words one by one, the end of a text, and classes of the other words by their
last three bytes; both their numbers grow with the square root of the corpus. Each of the ``context`` words before a token
has a vector; multiplied by the weights of its place and added up, they predict the token (Mnih and Hinton 2007;
Mnih and Kavukcuoglu 2013, whose weights of places are vectors too). Outputs are dealt to as many groups as each group has
members: the model gives the probability of the group and, inside it, of the output, so a token is normalised
by two short matrix products instead of one over all outputs. Inside its class a word has add-one probability, with room
for one unseen word.

Training goes over every token of the training corpus, ``rounds`` times: in each round the tokens are dealt to tasks, each
trains a copy of the model on all of its tokens, in ``steps`` updates or more, and the copies and their step sizes are
averaged, weighted by tokens. So draws grow with the corpus, work is spread over the executors, and the driver holds one
model. The number of copies grows with the square root of the corpus too. Noise words are
not drawn: their expected numbers under the unigram distribution enter the gradient. The average is taken in blocks of
numbers, in two steps of bounded width.

Counts of the most frequent words, ``frequent`` at most, go to every executor. The words of a text that are not
among them are joined with the full counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textvec
from .common import ready, stage

END = -0x5DEECE66D0123457
#: Numbers of a block of the model that is averaged at once, and copies that meet in the first step.
BLOCK, FAN = 8192, 256
#: Tokens that a task holds and trains on at once, and most tokens of an update.
HELD, MOST = 1 << 23, 1 << 13
#: Tokens of one group that are multiplied at once.
TILE = 32
#: Vectors that one row of weights is laid along at once.
RUN = 64
#: Tokens that are dealt out together, about.
PIECE = 1 << 14
_PARTS = ("word", "place", "group", "group_bias", "member", "member_bias")


@dataclass(frozen=True)
class Lbl:
    """``share`` and ``floor``: words, and likewise classes, are ``floor + share * sqrt(tokens)``."""

    share: float = 0.08
    floor: int = 512
    size: int = 16
    context: int = 6
    rounds: int = 2
    steps: int = 256
    least: int = 256
    noise: int = 64
    rate: float = 0.3
    copies: float = 1 / 256
    frequent: int = 500_000
    seed: int = 7

    def outputs(self, tokens: int) -> int:
        """Words, or classes, of their own in a corpus of so many tokens."""
        return self.floor + math.ceil(self.share * math.sqrt(tokens))


    def tasks(self, tokens: int) -> int:
        """Copies that are trained on so many tokens."""
        return max(1, math.ceil(self.copies * math.sqrt(tokens)))


class Vocabulary(NamedTuple):
    """``hashes`` ascend, with ``counts`` and ``output``, a frequent word's number or -1.

    Outputs are ``words`` words, the end, and ``classes`` classes, which have ``log_class`` (log10 of what add-one divides by).
    """

    hashes: np.ndarray
    counts: np.ndarray
    output: np.ndarray
    words: int
    classes: int
    log_class: np.ndarray


def endings(w: textvec.Words, at: np.ndarray) -> np.ndarray:
    """For each word of those numbers a hash of its last three bytes, lower-cased; not negative."""
    low, end = textvec._lower(), w.end[at]
    size = end - w.start[at]
    last = low[w.buffer[end - 1]].astype(np.uint64)
    second = np.where(size > 1, low[w.buffer[np.maximum(end - 2, 0)]], 0).astype(np.uint64)
    third = np.where(size > 2, low[w.buffer[np.maximum(end - 3, 0)]], 0).astype(np.uint64)
    return (textvec.mix(last | second << np.uint64(8) | third << np.uint64(16)) >> np.uint64(1)).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list[tuple], textvec.Words]]:
    for rows, texts in textvec.blocks(textvec.arrow_rows(batches, *columns), len(columns) - 1):
        yield rows, textvec.words(texts)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = ends = 0

    def merged() -> pa.RecordBatch:
        h, c, n = (np.concatenate([x[k] for x in parts]) for k in range(3))
        parts.clear()
        h, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c[at]), pa.array(np.bincount(inverse, n, len(h)).astype(np.int64))], ["h", "ending", "n"])

    for rows, w in _texts(batches, "text"):
        ends += len(rows)
        h, at, n = np.unique(w.hash.view(np.int64), return_index=True, return_counts=True)
        parts.append((h, endings(w, at), n))
        held += len(h)
        if held > 1 << 22:
            yield merged()
            held = 0
    parts.append((np.array([END]), np.array([-1]), np.array([ends])))
    yield merged()


class Places:
    """Finds hashes in an ascending array by their first bits; only where several share these it searches."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.shift = np.uint64(61 - len(hashes).bit_length())
        slot = self._slot(hashes)
        self.table = np.full(8 << len(hashes).bit_length(), -1, np.int32)
        self.table[slot] = np.arange(len(hashes), dtype=np.int32)
        self.table[slot[1:][slot[1:] == slot[:-1]]] = -2

    def _slot(self, h: np.ndarray) -> np.ndarray:
        # the sign turned, so that slots ascend with signed hashes
        return ((h.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 if absent."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = self.table[self._slot(h)].astype(np.int64)
        several = np.flatnonzero(at == -2)
        at[several] = np.minimum(np.searchsorted(self.hashes, h[several]), len(self.hashes) - 1)
        at[self.hashes[at] != h] = -1  # an empty slot's -1 names the last hash, which the slot doesn't hold
        return at


def encode(w: textvec.Words, v: Vocabulary, places: Places | None = None) -> tuple[np.ndarray, ...]:
    """``(text, output, place)`` of each token; ``place`` is that of its word in ``hashes``, -1 if absent. An end stands after each text's words."""
    n_docs, n = len(w.first) - 1, len(w.hash)
    place = (places or Places(v.hashes)).find(w.hash.view(np.int64))
    number = np.where(place >= 0, v.output[place], -1) if len(v.hashes) else place
    doc = np.repeat(np.arange(n_docs), np.diff(w.first))
    token = np.arange(n) + doc
    end = w.first[1:] + np.arange(n_docs)
    out, where, text = (np.empty(n + n_docs, np.int64) for _ in range(3))
    rare = np.flatnonzero(number < 0)
    out[token], out[end] = number, v.words
    out[token[rare]] = v.words + 1 + endings(w, rare) % v.classes
    where[token], where[end] = place, -1
    text[token], text[end] = doc, np.arange(n_docs)
    return text, out, where


def padded(text: np.ndarray, out: np.ndarray, pad: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A stream with ``width`` pads before each text, and the places of the tokens in it."""
    at = np.arange(len(out)) + (text + 1) * width
    stream = np.full(at[-1] + 1 if len(at) else 0, pad, np.int32)
    stream[at] = out
    return stream, at


class Model:
    """The parameters, as views of one vector; ``seen`` holds what adapts the step sizes."""

    def __init__(self, counts: np.ndarray, p: Lbl):
        """``counts`` of all outputs."""
        self.p, n = p, len(counts)
        unigram = counts + 1.0
        groups = math.ceil(math.sqrt(n))
        members = -(-n // groups)
        by_count = np.argsort(-unigram, kind="stable")
        self.group_of, self.slot_of = np.empty(n, np.int16 if groups < 1 << 15 else np.int64), np.empty(n, np.int64)
        self.group_of[by_count], self.slot_of[by_count] = np.arange(n) % groups, np.arange(n) // groups
        inner = np.zeros((groups, members))
        inner[self.group_of, self.slot_of] = unigram
        outer = inner.sum(axis=1)
        inner, outer = inner / outer[:, None], outer / outer.sum()
        shapes = [(n + 1, p.size), (p.context, p.size), (groups, p.size), (groups,), (groups, members, p.size), (groups, members)]
        self.pad, self.cut = n, np.cumsum([0, *(math.prod(x) for x in shapes)])
        self.shapes = shapes
        real = np.float32
        rng = np.random.default_rng(p.seed)
        self.values = np.empty(self.cut[-1], real)
        self.seen = np.full(self.cut[-1], 1e-4, real)
        self.bind()
        for x in (self.word, self.group, self.member):
            x[...] = rng.standard_normal(x.shape) * 0.1
        self.place[...] = p.context**-0.5
        self.group_bias[...] = np.log(outer)
        self.member_bias[...] = np.log(np.where(inner > 0, inner, 1))
        self.member_bias[inner == 0] = -1e9  # no output has this place
        self.outer_noise, self.inner_noise = (outer * p.noise).astype(real), (inner * p.noise).astype(real)
        self.log_outer = np.log(self.outer_noise)
        self.log_inner = np.log(np.where(inner > 0, self.inner_noise, 1))

    def bind(self) -> None:
        for name, shape, a, b in zip(_PARTS, self.shapes, self.cut[:-1], self.cut[1:], strict=True):
            setattr(self, name, self.values[a:b].reshape(shape))
            setattr(self, f"_{name}", self.seen[a:b].reshape(shape))

    def __getstate__(self) -> dict:
        views = {*_PARTS, *(f"_{x}" for x in _PARTS)}
        return {k: v for k, v in self.__dict__.items() if k not in views}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.bind()

    def load(self, vector: np.ndarray) -> None:
        """Takes over values and step sizes, one after the other in one vector."""
        self.values, self.seen = (x.astype(np.float32) for x in np.split(vector, 2))
        self.bind()

    def contexts(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of all tokens, and the prediction for each but the first ``context``."""
        k = self.p.context
        r = self.word[stream]
        q = np.zeros((len(stream) - k, self.p.size), np.float32)
        one = np.empty_like(q)
        for i in range(k):
            q += _scaled(r[k - 1 - i : len(stream) - 1 - i], self.place[i], one)
        return r, q

    def outer(self, sign: int, shift: np.ndarray) -> np.ndarray:
        """Weights of groups with a bias, transposed."""
        return np.column_stack([self.group * np.float32(sign), shift]).T

    def inner(self, tile: np.ndarray, sign: int, shift: np.ndarray) -> np.ndarray:
        """Weights of the members of the tiles' groups with a bias, transposed."""
        return np.concatenate([self.member * np.float32(sign), shift[:, :, None]], axis=2)[tile].transpose(0, 2, 1)

    def log_probability(self, stream: np.ndarray) -> np.ndarray:
        """Natural logarithms for all tokens of a stream but the first ``context``; those of pads are 0."""
        k = self.p.context
        out = np.zeros(len(stream) - k)
        for a in range(0, len(out), MOST):
            part = stream[a : a + MOST + k]
            _, q = self.contexts(part)
            live = np.flatnonzero(part[k:] != self.pad)
            y = part[k:][live]
            order, g, tile, at = _tiles(self.group_of[y], len(self.group))
            live, y = live[order], y[order]
            q = _biased(q, live)
            got = _log_softmax(q @ self.outer(1, self.group_bias), np.arange(len(y)), g)
            x = _dealt(q, tile, at) @ self.inner(tile, 1, self.member_bias)
            got += _log_softmax(x.reshape(-1, x.shape[2]), at, self.slot_of[y])
            out[a + live] = got
        return out

    def train(self, stream: np.ndarray, rate: float) -> None:
        """One pass over a stream."""
        k = self.p.context
        batch = min(MOST, max(self.p.least, len(stream) // self.p.steps))
        for a in range(0, len(stream) - k, batch):
            self._update(stream[a : a + batch + k], np.float32(rate))

    def _update(self, stream: np.ndarray, rate: np.float32) -> None:
        k = self.p.context
        r, q = self.contexts(stream)
        live = np.flatnonzero(stream[k:] != self.pad)
        y = stream[k:][live]
        if not len(y):
            return
        order, g, tile, at = _tiles(self.group_of[y], len(self.group))
        live, y = live[order], y[order]
        q, row, size = _biased(q, live), np.arange(len(y)), self.p.size
        share = np.float32(len(y))
        error = _nce(q @ self.outer(-1, self.log_outer - self.group_bias), self.outer_noise / share, row, g, share)
        dq = error @ self.group
        d_group = error.T @ q
        d_member = np.zeros((*self.member_bias.shape, size + 1), np.float32)
        dealt = _dealt(q, tile, at)
        x = dealt @ self.inner(tile, -1, self.log_inner - self.member_bias)
        error = _nce(x, (self.inner_noise / share)[tile][:, None, :], at, self.slot_of[y], share)
        empty = np.ones(len(tile) * TILE, bool)
        empty[at] = False
        error.reshape(-1, error.shape[2])[empty] = 0
        dq += (error @ self.member[tile]).reshape(-1, size)[at]
        first = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
        d_member[tile[first]] = np.add.reduceat(error.transpose(0, 2, 1) @ dealt, first, axis=0)
        full = np.zeros((len(stream) - k, self.p.size), np.float32)
        full[live] = dq
        dr, d_place, one = np.zeros_like(r), np.empty_like(self.place), np.empty_like(full)
        for i in range(k):
            x = slice(k - 1 - i, len(stream) - 1 - i)
            dr[x] += _scaled(full, self.place[i], one)
            d_place[i] = _product_sums(full, r[x])
        order = np.argsort(stream.astype(np.uint16) if self.pad < 1 << 16 else stream, kind="stable")
        ordered = stream[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        rows, d_word = ordered[first], np.add.reduceat(dr[order], first, axis=0)
        self._word[rows] += d_word**2
        self.word[rows] -= rate * d_word / np.sqrt(self._word[rows])
        for name, d in (("place", d_place), ("group", d_group[:, :size]), ("group_bias", d_group[:, size]), ("member", d_member[:, :, :size]), ("member_bias", d_member[:, :, size])):
            seen = getattr(self, f"_{name}")
            seen += d * d
            d *= rate
            d /= np.sqrt(seen)
            getattr(self, name).__isub__(d)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows joined by ``RUN`` to long rows, and those left over."""
    whole = len(x) // RUN * RUN
    return x[:whole].reshape(-1, RUN * x.shape[1]), x[whole:]


def _scaled(x: np.ndarray, weights: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Each row times the weights, into ``out``."""
    for part, to, by in zip(_runs(x), _runs(out), (np.tile(weights, RUN), weights), strict=True):
        np.multiply(part, by, out=to)
    return out


def _product_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sums of the columns of ``x * y``."""
    (long_x, short_x), (long_y, short_y) = _runs(x), _runs(y)
    return np.einsum("ij,ij->j", long_x, long_y).reshape(RUN, -1).sum(axis=0) + np.einsum("ij,ij->j", short_x, short_y)


def _biased(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Those rows with a last column of ones, whose weights are biases."""
    out = np.ones((len(rows), q.shape[1] + 1), np.float32)
    out[:, :-1] = q[rows]
    return out


def _tiles(g: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """Deals tokens to tiles of one group each: their order, their groups in it, the tiles' groups, and each token's place in the tiles."""
    order = np.argsort(g, kind="stable")
    size = np.bincount(g, minlength=groups)
    tiles = -(-size // TILE)
    start = (np.cumsum(tiles) - tiles) * TILE - (np.cumsum(size) - size)
    g = g[order]
    return order, g, np.repeat(np.arange(groups), tiles), np.arange(len(g)) + start[g]


def _dealt(q: np.ndarray, tile: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros((len(tile) * TILE, q.shape[1]), np.float32)
    out[at] = q
    return out.reshape(len(tile), TILE, q.shape[1])


def _log_softmax(x: np.ndarray, row: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The logarithms of the targets' shares of their rows; the largest value is taken off only against overflow."""
    true = x[row, target].astype(np.float64)
    with np.errstate(over="ignore"):
        total = (np.exp(x) @ np.ones(x.shape[1], np.float32))[row]
    if not (np.isfinite(total) & (total > 0)).all():
        most = x.max(axis=1, keepdims=True)
        total, true = np.exp(x - most).sum(axis=1)[row], true - most[row, 0]
    return true - np.log(total.astype(np.float64))


def _nce(x: np.ndarray, noise: np.ndarray, row: np.ndarray, target: np.ndarray, share: np.float32) -> np.ndarray:
    """Turns the noise's logarithms less the logits into the gradient by these: rows have their true output once and all outputs at their expected number as noise.

    ``noise`` and the result are parted by ``share``.
    """
    with np.errstate(over="ignore"):
        np.exp(x, out=x)  # the probability of being no noise is 1 / (1 + x)
    x += 1
    flat = x.reshape(-1, x.shape[-1])
    true = (1 / flat[row, target] - 1) / share
    np.divide(noise, x, out=x)
    flat[row, target] += true
    return x


def _encoded(shared, width: str):
    """Outputs of texts in pieces, with the numbers of tokens of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        places = Places(vocabulary.hashes)
        for _, w in _texts(batches, "text"):
            text, out, _ = encode(w, vocabulary, places)
            size = np.bincount(text, minlength=len(w.first) - 1)
            piece = (np.cumsum(size) - size) // PIECE
            first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            texts = np.split(size.astype(np.int32), first[1:])
            outs = np.split(out.astype(width), np.cumsum([x.sum() for x in texts])[:-1])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in part], pa.binary()) for part in (outs, texts)], ["outputs", "sizes"])

    return run


def _trained(p: Lbl, shared, width: str, turn: int, rate: float):
    """One copy of the model, trained on a partition, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vector = shared.value
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng((p.seed, turn, task))
        model.load(vector)
        outs: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = total = 0

        def learn() -> None:
            """Trains on the texts held, in shuffled order."""
            out, size = np.concatenate(outs), np.concatenate(sizes)
            order = rng.permutation(len(size))
            start, size = (np.cumsum(size) - size)[order], size[order]
            text = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(out)) + (start - np.cumsum(size) + size)[text]
            model.train(padded(text, out[at], model.pad, p.context)[0], rate)
            outs.clear()
            sizes.clear()

        for x, n in textvec.arrow_rows(batches, "outputs", "sizes"):
            outs.append(np.frombuffer(x, width))
            sizes.append(np.frombuffer(n, np.int32).astype(np.int64))
            held += len(outs[-1])
            total += len(outs[-1])
            if held > HELD:
                learn()
                held = 0
        if outs:
            learn()
        if total:
            both = np.concatenate([model.values, model.seen])
            for k in range(0, len(both), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([task]), pa.array([k // BLOCK]), pa.array([float(total)]), pa.array([both[k : k + BLOCK].astype(np.float64).tobytes()])], ["task", "block", "tokens", "x"])

    return run


def _average(key: tuple, table: pa.Table) -> pa.Table:
    """Of the copies of one block the mean, weighted by tokens."""
    n = table.column("tokens").to_numpy()
    total = sum(np.frombuffer(x.as_py()) * w for x, w in zip(table.column("x"), n, strict=True)) / n.sum()
    return pa.table({"task": [0], "block": table.column("block")[:1].to_pylist(), "tokens": [n.sum()], "x": [total.tobytes()]})


class Learned(NamedTuple):
    counts: DataFrame
    tokens: int
    distinct: int
    vocabulary: Vocabulary
    model: Model | None


def learn(train: DataFrame, p: Lbl = Lbl()) -> Learned:
    """Word counts and the trained model of all rows ``(text,)``; no model if there are none."""
    spark = train.sparkSession
    counts = stage(train.mapInArrow(_counts, "h long, ending long, n long").where("n > 0").groupBy("h").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words = counts.where(F.col("ending") >= 0)
    classes = p.outputs(tokens)
    top = words.orderBy(F.desc("n"), "h").limit(classes).select("h", "ending", "n").collect()
    number = {r[0]: k for k, r in enumerate(top)}
    # the least count that at most ``frequent`` words reach, on a scale of eighths of a power of two
    level = F.floor(F.log2("n") * 8)
    least, room = 1 << 62, p.frequent
    for x, k in sorted(counts.groupBy(level.alias("x")).agg(F.count("*")).collect(), reverse=True):
        room -= k
        if room < 0:
            break
        least = x
    # the words of the model are among these whatever their counts
    named = spark.createDataFrame([(END,), *((h,) for h in number)], "h long")
    near = counts.where(level >= least).select("h", "n").unionByName(counts.where(level < least).join(F.broadcast(named), "h", "left_semi").select("h", "n")).toArrow()
    hashes, n = near.column("h").to_numpy(), near.column("n").to_numpy()
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    output = np.array([number.get(h, -1) for h in hashes.tolist()], np.int64)
    mass, kinds = np.zeros(classes), np.zeros(classes)
    for c, some, different in words.groupBy((F.col("ending") % classes).alias("c")).agg(F.sum("n"), F.count("*")).collect():
        mass[c], kinds[c] = some, different
    own = np.array([r[1] % classes for r in top], np.int64)
    top_n = np.array([r[2] for r in top], float)
    mass -= np.bincount(own, top_n, classes)
    kinds -= np.bincount(own, minlength=classes)
    vocabulary = Vocabulary(hashes, n, output, len(top), classes, np.log10(mass + kinds + 1))
    if not tokens:
        return Learned(counts, 0, 0, vocabulary, None)
    ends = n[hashes == END].sum()
    model = Model(np.concatenate([top_n, [float(ends)], mass]), p)
    few = output >= 0
    slim = vocabulary._replace(hashes=hashes[few], counts=n[few], output=output[few])
    width = "u2" if model.pad < 1 << 16 else "u4"
    encoded = stage(train.mapInArrow(_encoded(spark.sparkContext.broadcast(slim), width), "outputs binary, sizes binary"), "tokens")
    for turn in range(p.rounds):
        shared = spark.sparkContext.broadcast((model, np.concatenate([model.values, model.seen])))
        schema = "task long, block long, tokens double, x binary"
        copies = encoded.repartition(p.tasks(tokens)).mapInArrow(_trained(p, shared, width, turn, p.rate * (1 - turn / p.rounds)), schema)
        copies = copies.groupBy("block", F.floor(F.col("task") / FAN)).applyInArrow(_average, schema)
        mean = stage(copies.groupBy("block").applyInArrow(_average, schema), "model").toArrow().sort_by("block")
        model.load(np.frombuffer(b"".join(mean.column("x").to_pylist())))
    return Learned(counts, tokens, distinct, vocabulary, model)


def _score(p: Lbl, shared, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, model = shared.value
        log_count = np.log10(np.append(v.counts, 0) + 1.0)
        places = Places(v.hashes)
        end_place = places.find(np.array([END]))[0]
        at = TaskContext.get().partitionId() << 36
        for rows, w in _texts(batches, "id", "held_out", "text"):
            text, out, place = encode(w, v, places)
            n = len(rows)
            end = out == v.words
            place[end] = end_place
            ours = place >= 0
            plain = np.where(ours, log_count[place], 0.0)
            inner = out > v.words
            own = np.zeros(len(out))
            if model:
                stream, where = padded(text, out, model.pad, p.context)
                own = model.log_probability(stream)[where - p.context] / math.log(10)
                own += np.where(inner, plain - v.log_class[np.where(inner, out - v.words - 1, 0)], 0.0)
            rest = ~ours & ~end
            size = np.bincount(text[rest], minlength=n)
            words = w.hash.view(np.int64)[rest[~end]]
            off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(at, at + n)), pa.array([r[0] for r in rows], id_type), pa.array([r[1] for r in rows], pa.bool_()), pa.array(np.bincount(text, minlength=n)),
                    pa.array(np.bincount(text[ours], minlength=n)), pa.array(np.bincount(text, plain, n)), pa.array(np.bincount(text, own, n)), pa.ListArray.from_arrays(pa.array(off), pa.array(words)),
                ],
                ["rid", "id", "held_out", "n_tokens", "n_known", "base", "model", "rest"],
            )
            at += n

    return run


def score(docs: DataFrame, params: Lbl = Lbl(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    The rows whose crc32 of the id as text leaves 2 modulo 7 are held out; the others with an id are learned
    from, repeated rows as often as they stand. Tokens are lower-cased words and one end, so a null or blank text has one
    token. ``base_score`` adds log10((c + 1) / (N + V + 1)) over them; ``score`` is the model's log10 probability of the
    text. Without training rows both are those of the only outcome known, 0. Of words of equal count those of smaller hash
    are in the model. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    held = F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    counts, tokens, distinct, vocabulary, model = learn(docs.where(~held).select(F.col(text_col).alias("text")), params)
    shared = spark.sparkContext.broadcast((vocabulary, model))
    kind = dict(rows.dtypes)["id"]
    scored = rows.mapInArrow(_score(params, shared, to_arrow_type(rows.schema["id"].dataType)), f"rid long, id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, rest array<long>")
    scored = stage(scored, "scores")
    rest = scored.select("rid", F.explode("rest").alias("h")).join(counts.select("h", "n"), "h")
    rest = rest.groupBy("rid").agg(F.sum(F.log10(F.col("n") + 1.0)).alias("more"), F.count("*").alias("seen"))
    more = F.coalesce("more", F.lit(0.0))
    floor = float(np.log10(tokens + distinct + 1))
    out = scored.join(rest, "rid", "left")
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * floor).alias("base_score"), (F.col("model") + more).alias("score"),
    )
