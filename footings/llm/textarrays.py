"""Texts as numpy arrays inside a task: code points, words and word hashes of a block of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_CHARS = 400_000         # texts are taken together up to this size; a longer text is a block of its own
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0x9FB21C651E98DF25


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _flags(test) -> np.ndarray:
    return np.fromiter((test(chr(c)) for c in range(0x10000)), bool, 0x10000)


SPACE = _flags(str.isspace)
_CODES = mixed(np.arange(0x10000, dtype=np.uint64))


def blocks(texts: list[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts that together stay near `limit` characters."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, k
            start, size = k, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each followed by a line end, and where each text starts (one more at the end)."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return points, starts


def word_bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the maximal runs without white space."""
    solid = ~SPACE[np.minimum(points, 0xFFFF)]
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if len(solid) and solid[0]:
        edge = np.concatenate([[0], edge])
    return edge[::2], edge[1::2]


def powers(count: int) -> np.ndarray:
    out = np.full(count, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, a polynomial in its code points, scrambled."""
    if not len(starts):
        return np.empty(0, np.uint64)
    codes = _CODES[points & 0xFFFF] + (points >> 16).astype(np.uint64) * _M2
    sizes = ends - starts
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    where = inside + np.repeat(starts, sizes)
    terms = codes[where] * powers(int(sizes.max()))[inside]
    return mixed(np.add.reduceat(terms, np.cumsum(sizes) - sizes))
