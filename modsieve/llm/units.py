"""Vectorised work on the bytes and words of many texts at once, for Arrow batches.

A *chunk* is a run of whole documents whose UTF-8 bytes lie one after another in
one array, about ``CHUNK_BYTES`` of them (more only if one document is longer), so
memory follows the chunk and not the Arrow batch. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

U64 = np.uint64
_BYTE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)

WHITE = bytes([0x20, *range(0x09, 0x0E)])
NOT_SPACE = np.array([b not in WHITE for b in range(256)])
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        full = np.full(max(n, 2 * len(_POWERS)), _BASE)
        full[0] = 1
        _POWERS = np.multiply.accumulate(full)
    return _POWERS


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, document offsets)``; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, docs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the offsets of each document's words."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(docs), np.int64)
    mask = is_word[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    inner = docs[:-1][docs[:-1] < len(data)]
    begins[inner] = mask[inner]
    stops = mask.copy()
    stops[:-1] &= ~mask[1:]
    last = docs[1:][docs[1:] > 0] - 1
    stops[last] = mask[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, docs)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; spans are in order, not empty and do not overlap."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    flat = data[place + np.repeat(starts, lengths)]
    terms = _BYTE[flat] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def grams(units: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` units, by doubling; the caller drops runs over an edge."""
    if len(units) < n:
        return np.zeros(0, np.uint64)
    total, covered, block, size = None, 0, units.astype(np.uint64), 1
    left = n
    while left:
        if left & 1:
            part = block[covered : covered + len(units) - n + 1]
            total = part.copy() if total is None else total * U64(0xD6E8FEB86659FD93) + part
            covered += size
        left >>= 1
        if left:
            block = mix(block[:-size] * U64(0xA0761D6478BD642F) + block[size:])
            size *= 2
    return mix(total + U64(n))


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every run of ``width`` values."""
    if len(values) < width:
        return values[:0]
    out, size = values, 1
    while 2 * size <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    if size < width:
        rest = width - size
        out = pick(out[: len(out) - rest], out[rest:])
    return out


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest hash of some window of ``width`` hashes (all tied places)."""
    if len(hashes) == 0:
        return np.zeros(0, np.int64)
    if len(hashes) <= width:
        return np.flatnonzero(hashes == hashes.min())
    least = sliding(hashes, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(sliding(padded, width, np.maximum) == hashes)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags of the ``n`` places that lie in some span."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0
