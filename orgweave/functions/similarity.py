"""Jaro-Winkler and Metaphone, which Spark lacks: the one an Arrow function over arrays of pairs, the other an expression."""

from __future__ import annotations

from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..sources.staging import ready


def jaro_winkler_bytes(a: bytes, b: bytes) -> float:
    """On bytes, with a prefix of four at most, weight 0.1, and only where Jaro is over 0.7."""
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(max(n, m) // 2 - 1, 0)
    used = bytearray(m)
    left = bytearray()
    for i in range(n):
        lo, hi = max(0, i - reach), min(m, i + reach + 1)
        j = b.find(a[i], lo, hi)
        while j >= 0 and used[j]:
            j = b.find(a[i], j + 1, hi)
        if j >= 0:
            used[j] = 1
            left.append(a[i])
    k = len(left)
    if not k:
        return 0.0
    right = bytes(b[j] for j in range(m) if used[j])
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    jaro = (k / n + k / m + (k - swaps) / k) / 3
    if jaro <= 0.7:
        return jaro
    same = 0
    while same < min(4, n, m) and a[same] == b[same]:
        same += 1
    return jaro + 0.1 * same * (1 - jaro)


#: Bytes of a text whose places fit one word.
PLACES = 64


#: Pairs that are computed at once.
CHUNK = 8192

_LOW = np.array([(1 << k) - 1 for k in range(PLACES + 1)], np.uint64)
#: For each place of the one text and each reach, the places of the other that it may take.
_WINDOWS = np.array([[_LOW[min(PLACES, i + r + 1)] & ~_LOW[max(0, i - r)] for r in range(PLACES // 2 + 1)] for i in range(PLACES)], np.uint64)


def _coded(texts: list[bytes], codes: np.ndarray) -> np.ndarray:
    """Texts as rows of ``PLACES`` codes, 0 behind their ends; those that are longer are left empty."""
    texts = [x if len(x) <= PLACES else b"" for x in texts]
    rows = np.frombuffer(b"".join(x.ljust(PLACES, b"\0") for x in texts), np.uint8).reshape(-1, PLACES)
    ends = np.array([len(x) for x in texts], np.int64)
    return np.where(np.arange(PLACES) < ends[:, None], codes[rows], 0)


def jaro_winkler_many(a: list[bytes], b: list[bytes], i: np.ndarray | None = None, j: np.ndarray | None = None) -> np.ndarray:
    """``jaro_winkler_bytes`` of many pairs at once, the i-th of ``a`` with the j-th of ``b``; texts of over ``PLACES`` bytes go one by one.

    A word for each text and byte marks the places where it stands, a word for each pair the places of ``b`` that are taken. Byte
    by byte of ``a``, each takes the first free equal place in its reach.
    """
    i, j = (np.arange(len(a)) if x is None else x for x in (i, j))
    out = np.empty(len(i))
    na, nb = (np.array([len(x) for x in texts], np.int64) for texts in (a, b))
    fit = lambda n: (n > 0) & (n <= PLACES)
    short = fit(na)[i] & fit(nb)[j]
    for k in np.flatnonzero(~short):
        out[k] = jaro_winkler_bytes(a[i[k]], b[j[k]])
    every = np.flatnonzero(short)
    if not len(every):
        return out
    used = np.unique(np.frombuffer(b"".join((*a, *b)), np.uint8))
    codes = np.zeros(256, np.int64)
    codes[used] = np.arange(1, len(used) + 1)
    left, right = _coded(a, codes), _coded(b, codes)
    width = len(used) + 1
    places = np.zeros((len(b), width), np.uint64)
    for k in range(PLACES):
        places[np.arange(len(b)), right[:, k]] |= np.uint64(1) << np.uint64(k)
    places[:, 0] = 0  # what stands behind an end is no place
    places = places.ravel()
    for start in range(0, len(every), CHUNK):
        rows = every[start : start + CHUNK]
        x, y, n, m = left[i[rows]], right[j[rows]], na[i[rows]], nb[j[rows]]
        reach, at = np.maximum(np.maximum(n, m) // 2 - 1, 0), j[rows] * width
        taken, mine = np.zeros(len(rows), np.uint64), np.zeros((PLACES, len(rows)), bool)
        for k, letters in enumerate(np.ascontiguousarray(x.T[: int(n.max())])):
            free = places[at + letters] & _WINDOWS[k][reach] & ~taken
            taken |= free & (~free + np.uint64(1))
            mine[k] = free != 0
        mine = np.ascontiguousarray(mine.T)
        theirs = np.unpackbits(taken.astype("<u8")[:, None].view(np.uint8), axis=1, bitorder="little").view(bool)
        k = mine.sum(axis=1)
        moved = np.repeat(np.arange(len(rows)), k)[x[mine] != y[theirs]]
        swaps = np.bincount(moved, minlength=len(rows)) // 2
        jaro = np.where(k > 0, (k / n + k / m + (k - swaps) / np.maximum(k, 1)) / 3, 0.0)
        prefix = np.cumprod((x[:, :4] == y[:, :4]) & (np.arange(4) < np.minimum(n, m)[:, None]), axis=1).sum(axis=1)
        out[rows] = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
    return out


#: Pairs whose words are worked on at once by ``jaro_winkler_levels``, and texts of the second side among them.
TILE, WIDE = 1 << 14, 1024


@cache
def _fewest(least: float, prefix: int) -> np.ndarray:
    """For texts of n and m bytes the fewest in common with which they can reach ``least``, if the prefix is no longer; 255 if none do."""
    n, m, k = np.ogrid[1:256, 1 : PLACES + 1, 1:255]
    jaro = (k / n + k / m + 1) / 3
    may = jaro + np.where(jaro > 0.7, 0.1 * prefix * (1 - jaro), 0) >= least - 1e-9
    return np.pad(np.where(may.any(axis=2), may.argmax(axis=2) + 1, 255), ((1, 0), (1, 0))).astype(np.uint8)


def jaro_winkler_levels(a: list[bytes], b: list[bytes], least: list[float]) -> np.ndarray:
    """For each text of ``a`` with each of ``b``, how many of the similarities ``least``, which rise, ``jaro_winkler_bytes`` reaches.

    As ``jaro_winkler_many``, but texts of ``a`` of one length go with all of ``b`` and nothing is looked up for a pair: byte by byte of
    ``a``, first what it takes of ``b``, then if it equals the byte of ``b`` that is as far from the start among those taken. Texts of
    ``b`` of over ``PLACES`` bytes are compared one by one, where the bytes of both allow the lowest level.
    """
    out = np.zeros((len(a), len(b)), np.int8)
    if not a or not b:
        return out
    na, nb = (np.array([len(x) for x in texts], np.int64) for texts in (a, b))
    levels = np.array(least)
    reached = lambda similarity: (similarity[..., None] >= levels).sum(axis=-1)
    slow = [(np.array([k]), np.flatnonzero(nb)) for k in np.flatnonzero(na > 255)]
    slow += [(np.flatnonzero((na > 0) & (na <= 255)), np.array([q])) for q in np.flatnonzero(nb > PLACES)]
    for rows, others in slow:
        i, j = (x.ravel() for x in np.meshgrid(rows, others, indexing="ij"))
        for at in range(0, len(i), 2048):  # bounds the byte counts
            p, q = i[at : at + 2048], j[at : at + 2048]
            for k in np.flatnonzero(may_reach([a[x] for x in p], [b[x] for x in q], least[0])):
                out[p[k], q[k]] = reached(np.array(jaro_winkler_bytes(a[p[k]], b[q[k]])))
    out[np.ix_(na == 0, nb == 0)] = reached(np.array(1.0))
    used = np.unique(np.frombuffer(b"".join((*a, *b)), np.uint8))
    codes = np.zeros(256, np.intp)
    codes[used] = np.arange(1, len(used) + 1)
    lengths = [(n, np.flatnonzero(na == n)) for n in np.unique(na[(na > 0) & (na <= 255)])]
    lengths = [(int(n), rows, np.stack([codes[np.frombuffer(a[k], np.uint8)] for k in rows])) for n, rows in lengths]
    order = np.argsort(nb, kind="stable")
    for low, bits in ((1, 16), (17, 32), (33, PLACES)):
        word, signed = np.dtype(f"u{bits // 8}").type, np.dtype(f"i{bits // 8}")
        fit = order[(nb[order] >= low) & (nb[order] <= bits)]
        for start in range(0, len(fit), WIDE):
            mine = fit[start : start + WIDE]
            m = nb[mine]
            places = np.zeros((len(used) + 1, len(mine)), word)
            theirs = codes[np.frombuffer(b"".join(b[k].ljust(bits, b"\0") for k in mine), np.uint8).reshape(-1, bits)]
            for i in range(bits):
                held = np.flatnonzero(m > i)
                places[theirs[held, i], held] |= word(1 << i)
            for n, rows, letters in lengths:
                reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
                at = np.arange(n)[:, None]
                ends = np.minimum(at + reach + 1, bits)
                starts = np.minimum(np.maximum(at - reach, 0), bits)
                window = (_LOW[ends] & ~_LOW[starts]).astype(word)
                fewest = [_fewest(least[0], prefix)[n, m] for prefix in (0, 4)]
                step = max(TILE * 64 // bits // len(mine), 1)
                for begin in range(0, len(rows), step):
                    x = letters[begin : begin + step].T
                    shape = (x.shape[1], len(mine))
                    free_places = np.full(shape, ~word(0), word)
                    free, low_bit, took = np.empty(shape, word), np.empty(shape, word), np.empty((n, *shape), word)
                    for i in range(n):
                        np.take(places, x[i], axis=0, out=free, mode="clip")
                        free &= window[i]
                        free &= free_places
                        np.negative(free, out=low_bit)
                        np.bitwise_or(free, low_bit, out=took[i])
                        low_bit &= free
                        free_places ^= low_bit
                    takes = took.view(signed)
                    taken = ~free_places
                    k = np.bitwise_count(taken)
                    open_ = k >= np.where(places[x[0]] & word(1), fewest[1], fewest[0])
                    if not open_.any():
                        continue
                    takes >>= bits - 1  # all bits of what took a byte
                    equal = np.zeros(shape, word)
                    for i in range(n):
                        np.negative(taken, out=low_bit)
                        low_bit &= taken
                        low_bit &= took[i]
                        taken ^= low_bit
                        np.take(places, x[i], axis=0, out=free, mode="clip")
                        free &= low_bit
                        equal |= free
                    p, q = np.nonzero(open_)
                    k = k[p, q].astype(np.int64)
                    swaps = (k - np.bitwise_count(equal[p, q])) // 2
                    found = (k / n + k / m[q] + (k - swaps) / k) / 3
                    same, alike = np.zeros(len(p), np.int64), np.ones(len(p), bool)
                    for i in range(min(n, 4)):
                        alike &= (places[x[i][p], q] >> word(i) & word(1)).astype(bool)
                        same += alike
                    found = np.where(found > 0.7, found + 0.1 * same * (1 - found), found)
                    out[rows[begin + p], mine[q]] = reached(found)
    return out


def _byte_matrix(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each byte in each text, and the first four bytes."""
    length = np.array([len(x) for x in texts])
    row = np.repeat(np.arange(len(texts)), length)
    counts = np.bincount(row * 256 + np.frombuffer(b"".join(texts), np.uint8), minlength=len(texts) * 256)
    return counts.reshape(-1, 256), np.frombuffer(b"".join(x[:4].ljust(4, b"\0") for x in texts), np.uint8).reshape(-1, 4)


def may_reach(a: list[bytes], b: list[bytes], least: float) -> np.ndarray:
    """Which pairs can have that similarity, by the bytes that both hold and the prefix that they share."""
    (ca, pa_), (cb, pb) = _byte_matrix(a), _byte_matrix(b)
    both = np.minimum(ca, cb).sum(axis=1)
    jaro = (both / np.maximum([len(x) for x in a], 1) + both / np.maximum([len(x) for x in b], 1) + 1) / 3
    prefix = np.cumprod(pa_ == pb, axis=1).sum(axis=1)
    return jaro + np.where(jaro > 0.7, 0.1 * prefix * (1 - jaro), 0) >= least - 1e-9


@F.arrow_udf(returnType=DoubleType())
def _jaro_winkler(a: pa.Array, b: pa.Array, least: pa.Array) -> pa.Array:
    """Each distinct pair of texts of a batch is computed once."""
    out = np.full(len(a), np.nan)
    known = np.flatnonzero(np.asarray(pc.and_(a.is_valid(), b.is_valid())))
    if len(known):
        x, y = (c.take(pa.array(known)).dictionary_encode() for c in (a, b))
        xs, ys = ([v.encode() for v in c.dictionary.to_pylist()] for c in (x, y))
        pair, where = np.unique(np.asarray(x.indices).astype(np.int64) * len(ys) + np.asarray(y.indices), return_inverse=True)
        i, j = np.divmod(pair, len(ys))
        open_ = np.maximum(np.array([len(v) for v in xs])[i], np.array([len(v) for v in ys])[j]) <= PLACES
        far = np.flatnonzero(~open_)
        for start in range(0, len(far), 2048):  # bounds the byte counts
            k = far[start : start + 2048]
            open_[k] = may_reach([xs[p] for p in i[k]], [ys[p] for p in j[k]], least[0].as_py())
        found = np.full(len(pair), np.nan)
        found[open_] = jaro_winkler_many(xs, ys, i[open_], j[open_])
        out[known] = found[where]
    return pa.array(out, pa.float64(), mask=np.isnan(out))


#: Bytes that the signs of a text count, and how often each: two counts of every byte fill a word.
COUNTED, COUNTS = "abcdefghijklmnopqrstuvwxyz ", 4
SIGNS = ("head", *(f"bag{k}" for k in range(COUNTS // 2)))


def signs(text: str) -> dict[str, Column]:
    """Words that bound what a column's texts share with others: ``head`` has the first four bytes, ``bag0`` a bit for each counted byte
    that a text has once at least and one for twice, ``bag1`` the same for three times and four times."""
    out = {SIGNS[0]: F.expr(f"CAST(conv(rpad(hex(substring(encode(`{text}`, 'utf-8'), 1, 4)), 8, '0'), 16, 10) AS BIGINT)")}
    for word, name in enumerate(SIGNS[1:]):
        held = (f"greatest(least(octet_length(`{text}`) - octet_length(replace(`{text}`, '{c}', '')) - {2 * word}, 2), 0)" for c in COUNTED)
        out[name] = F.expr(" | ".join(f"shiftleft(shiftleft(1L, {n}) - 1, {2 * at})" for at, n in enumerate(held)))
    return out


def upper_bound(a: Column, b: Column, signs_a: dict[str, Column] | None = None, signs_b: dict[str, Column] | None = None) -> Column:
    """What Jaro-Winkler can reach at most, by the lengths in bytes alone, or with the ``signs`` of both by what they show to differ."""
    x, y = F.octet_length(a), F.octet_length(b)
    if signs_a is None or signs_b is None:
        jaro = (2 + F.least(x, y) / F.greatest(x, y, F.lit(1))) / 3
        return jaro + 0.4 * (1 - jaro)
    only = lambda s, t: reduce(Column.__add__, (F.bit_count(s[k].bitwiseAND(F.bitwise_not(t[k]))) for k in SIGNS[1:]))
    both = F.greatest(F.least(x - only(signs_a, signs_b), y - only(signs_b, signs_a)), F.lit(1))  # two empty texts are equal
    jaro = (both / F.greatest(x, F.lit(1)) + both / F.greatest(y, F.lit(1)) + 1) / 3
    differ = signs_a["head"].bitwiseXOR(signs_b["head"])
    prefix = F.when(differ >= 1 << 24, 0.0).when(differ >= 1 << 16, 0.1).when(differ >= 1 << 8, 0.2).when(differ > 0, 0.3).otherwise(0.4)
    return jaro + prefix * (1 - jaro)


def add_similarity(pairs: DataFrame, a: str, b: str, out: str, least: float = 0.0, only: str | None = None) -> DataFrame:
    """``pairs`` with the Jaro-Winkler similarity of two columns.

    Computed only for unequal texts whose lengths, and if one is long also bytes and prefix, allow ``least``; other
    unequal ones get null, equal texts 1. ``only`` names a boolean column: where it is false, unequal texts get null too.
    Callers compare with at least ``least``. Nothing is shuffled: a block of pairs is computed by whole arrays.
    """
    ready(pairs.sparkSession)
    x, y = F.col(a), F.col(b)
    open_ = x.isNotNull() & y.isNotNull() & (x != y) & (upper_bound(x, y) >= least)
    open_ = open_ & F.col(only) if only else open_
    return pairs.withColumn(out, F.when(x == y, F.lit(1.0)).otherwise(_jaro_winkler(F.when(open_, x), F.when(open_, y), F.lit(float(least)))))


# Philips's rules of 1990, as SQL that more than one engine reads: the code of each letter but vowels. x.p, x.c, x.n and x.m
# are the letter before, the letter, and the two after it; x.r is five from the letter on. Outside the word are blanks.
_VOWELS = "('A', 'E', 'I', 'O', 'U')"
_CODES = {
    "B": "CASE WHEN x.p = 'M' AND x.n = ' ' THEN '' ELSE 'B' END",
    "C": "CASE WHEN x.n = 'I' AND x.m = 'A' THEN 'X' WHEN x.n IN ('I', 'E', 'Y') THEN CASE WHEN x.p = 'S' THEN '' ELSE 'S' END WHEN x.n = 'H' AND x.p <> 'S' THEN 'X' ELSE 'K' END",
    "D": "CASE WHEN x.n = 'G' AND x.m IN ('E', 'I', 'Y') THEN 'J' ELSE 'T' END",
    "G": f"CASE WHEN x.n = 'H' THEN CASE WHEN x.m IN {_VOWELS} THEN 'K' ELSE '' END WHEN x.n = 'N' THEN CASE WHEN x.m = ' ' OR x.r = 'GNED ' THEN '' ELSE 'K' END WHEN x.n IN ('I', 'E', 'Y') THEN CASE WHEN x.p = 'D' THEN '' ELSE 'J' END ELSE 'K' END",
    "H": f"CASE WHEN x.n IN {_VOWELS} AND x.p NOT IN ('C', 'S', 'P', 'T', 'G') THEN 'H' ELSE '' END",
    "K": "CASE WHEN x.p = 'C' THEN '' ELSE 'K' END",
    "P": "CASE WHEN x.n = 'H' THEN 'F' ELSE 'P' END",
    "Q": "'K'",
    "S": "CASE WHEN x.n = 'H' OR x.n = 'I' AND x.m IN ('O', 'A') THEN 'X' ELSE 'S' END",
    "T": "CASE WHEN x.n = 'I' AND x.m IN ('O', 'A') THEN 'X' WHEN x.n = 'H' THEN '0' WHEN x.n = 'C' AND x.m = 'H' THEN '' ELSE 'T' END",
    "V": "'F'",
    "W": f"CASE WHEN x.n IN {_VOWELS} THEN 'W' ELSE '' END",
    "X": "'KS'",
    "Y": f"CASE WHEN x.n IN {_VOWELS} THEN 'Y' ELSE '' END",
    "Z": "'S'",
}
#: A letter's code; a letter that repeats the one before has none, but for C, and a vowel only at the start.
METAPHONE_CODE = f"CASE WHEN x.c = x.p AND x.c <> 'C' THEN '' WHEN x.c IN {_VOWELS} THEN CASE WHEN x.p = ' ' THEN x.c ELSE '' END " + " ".join(f"WHEN x.c = '{c}' THEN {code}" for c, code in _CODES.items()) + " ELSE x.c END"
#: The letters before, here, next, after that, and five from here, of a word between blanks.
METAPHONE_WINDOW = {"p": "substr(z, k, 1)", "c": "substr(z, k + 1, 1)", "n": "substr(z, k + 2, 1)", "m": "substr(z, k + 3, 1)", "r": "substr(z, k + 1, 5)"}


def metaphone_letters(word: str, every: str = "") -> str:
    """SQL of a word's letters in upper case, its start respelled, between blanks. ``every`` is what makes a replacement global."""
    out = f"upper(regexp_replace({word}, '[^A-Za-z]', ''{every}))"
    for start, to in (("AE", "E"), ("[GKP]N", "N"), ("WR", "R"), ("X", "S"), ("WH", "W")):
        out = f"regexp_replace({out}, '^{start}', '{to}')"
    return f"concat(' ', {out}, '     ')"


def metaphone(word: str) -> Column:
    """Metaphone of a column's words; the empty text if a word has no letters, null if it is null."""
    window = ", ".join(f"'{k}', {v}" for k, v in METAPHONE_WINDOW.items())
    codes = f"transform(transform(sequence(1, length(z) - 6), k -> named_struct({window})), x -> {METAPHONE_CODE})"
    # an array of one binds the word, so that its letters are read once
    return F.expr(f"transform(array({metaphone_letters(word)}), z -> CASE WHEN length(z) = 6 THEN '' ELSE array_join({codes}, '') END)[0]")


def add_metaphone(df: DataFrame, word: str, out: str) -> DataFrame:
    """``df`` with the Metaphone of a column's words."""
    return df.withColumn(out, metaphone(f"`{word}`"))
