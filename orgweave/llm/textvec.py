"""Words of many texts at once, as numpy arrays over one byte buffer.

A word is a run of bytes other than the six ASCII white-space bytes; A-Z are lower-cased. UTF-8 keeps
those bytes out of longer characters, so this equals splitting the text itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1
#: Bytes of text handled in one array.
BLOCK = 1 << 19


@lru_cache(1)
def _lower() -> np.ndarray:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    return low


@lru_cache(1)
def _digits() -> np.ndarray:
    """What each byte adds to a hash, before its place multiplies it."""
    return _lower().astype(np.uint64) + np.uint64(1)


@lru_cache(8)
def _powers(log2: int, base: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    for k in range(log2):
        out = np.concatenate([out, out * np.uint64(pow(base, 1 << k, 1 << 64))])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finalises 64-bit values so that every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Arrays over the words of all texts; ``first[d]:first[d + 1]`` are those of text ``d``."""

    buffer: np.ndarray
    text_start: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words(texts: list[bytes]) -> Words:
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    text_start = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=text_start[1:])
    solid = np.empty(len(buffer) + 2, bool)
    solid[0] = solid[-1] = False
    np.logical_and(buffer != 32, buffer - np.uint8(9) > 4, out=solid[1:-1])  # 9 to 13 and 32 are white space
    turns = np.flatnonzero(solid[1:] ^ solid[:-1])
    start, end = turns[::2], turns[1::2]
    log2 = max(1, int(len(buffer)).bit_length())
    sums = np.zeros(len(buffer) + 1, np.uint64)
    digits = _digits()[buffer]
    digits *= _powers(log2, _BASE)[: len(buffer)]
    np.cumsum(digits, out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * _powers(log2, _INVERSE)[start])
    return Words(buffer, text_start, start, end, hashed, np.searchsorted(start, text_start))


def blocks(rows: Iterable[tuple], text_at: int, size: int = BLOCK) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """Groups rows so that each group's texts are about ``size`` bytes; a longer text is a group of its own."""
    held: list[tuple] = []
    texts: list[bytes] = []
    total = 0
    for row in rows:
        text = (row[text_at] or "").encode("utf-8", "surrogatepass")
        if held and total + len(text) > size:
            yield held, texts
            held, texts, total = [], [], 0
        held.append(row)
        texts.append(text)
        total += len(text) + 1
    if held:
        yield held, texts


def arrow_rows(batches: Iterable, *columns: str) -> Iterator[tuple]:
    """Rows of Arrow record batches as tuples of the named columns."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
