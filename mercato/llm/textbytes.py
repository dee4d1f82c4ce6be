"""Vectorised work on the UTF-8 bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 18
U64 = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = LETTER[ord("A") : ord("Z") + 1] = True
LETTER[128:] = True

_random = np.random.default_rng(20240229)
BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15 | 5)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
SEQUENCE = U64(0xD1342543DE82EF95)


class Slice:
    """Some rows of a batch: their bytes and, by row, where they begin and end."""

    def __init__(self, first: int, offsets: np.ndarray, data: np.ndarray):
        self.first, self.offsets, self.data = first, offsets, data

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """A null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Slice(at, offsets[at : upto + 1] - offsets[at], data[offsets[at] : offsets[upto]])
        at = upto


_powers = np.ones(1, U64)


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    global _powers
    if base != BASE:
        return np.cumprod(np.concatenate(([U64(1)], np.full(n, base, U64))))[:n]
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate(([U64(1)], np.full(max(n, SLICE_BYTES), BASE, U64))))
    return _powers[:n]


_inverses = np.ones(1, U64)


def inverses(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        _inverses = np.cumprod(np.concatenate(([U64(1)], np.full(max(n, SLICE_BYTES), BASE_INVERSE, U64))))
    return _inverses


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads each bit over all 64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def unique(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; faster here than hashing them."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums for `span_hash`, one more than there are bytes."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODES[data] * powers(len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, wherever it stands."""
    raw = (prefix[ends] - prefix[starts]) * inverses(len(prefix))[starts]
    return mixed(raw + (ends - starts).astype(U64) * SEQUENCE)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that stay within a row."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and by row the index of its first word (one
    more entry than rows)."""
    starts, ends = runs(~SPACE[piece.data], piece.offsets)
    return starts, ends, np.searchsorted(starts, piece.offsets)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    total = np.zeros(len(hashes) - n + 1, U64)
    factor = 1
    for k in range(n):
        total += hashes[k : k + len(total)] * U64(factor)
        factor = factor * int(SEQUENCE) % (1 << 64)
    return mixed(total + U64(n))
