"""Document features: hashed words and word beginnings, and the shape of the text."""

from __future__ import annotations

import numpy as np

from modsieve.llm import units

BITS = 20
DIMENSION = 1 << BITS
PREFIX_BYTES = (4, 5, 6, 7)
_ASCII = 96  # one shape feature for each printable ASCII letter's share
SHAPES = _ASCII + 7
_UPPER = np.array([65 <= b <= 90 for b in range(256)])


def terms(data: np.ndarray, docs: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the different hashed words and word beginnings of a chunk.

    With ``kept`` only places it marks are given, which spares sorting all the others.
    """
    low = units.LOWER[data]
    starts, ends, offsets = units.words(low, docs, units.ALNUM)
    owner = np.repeat(np.arange(len(docs) - 1), np.diff(offsets))
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(low), "<u8", padded, strides=(1,))[starts] if len(starts) else np.zeros(0, np.uint64)
    found = []
    for number, size in enumerate((None, *PREFIX_BYTES)):
        if size is None:
            hashed = units.hash_spans(low, starts, ends)
        else:
            bits = (8 * np.minimum(ends - starts, size)).astype(np.uint64)
            front = eight & ((units.U64(1) << bits) - units.U64(1))
            hashed = units.mix(front + units.U64(number << 56))
        place = (hashed >> units.U64(64 - BITS)).astype(np.int64)
        if kept is None:
            found.append(owner * DIMENSION + place)
        else:
            use = kept[place]
            found.append(owner[use] * DIMENSION + place[use])
    keys = np.unique(np.concatenate(found))
    return keys // DIMENSION, keys % DIMENSION


def shapes(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Shares (of bytes or words) that tell prose from tables, shouting, symbols and repetition.

    Shares of short texts are drawn towards zero.
    """
    n = len(docs) - 1
    out = np.zeros((n, SHAPES))
    if len(data) == 0:
        return out
    owner = np.repeat(np.arange(n), np.diff(docs))
    place = np.where((data >= 32) & (data < 127), data - np.uint8(32), np.uint8(_ASCII - 1))
    marks = np.bincount(owner * _ASCII + place, minlength=n * _ASCII).reshape(n, _ASCII)
    out[:, :_ASCII] = np.sqrt(marks / (np.diff(docs) + 60)[:, None])
    starts, ends, offsets = units.words(data, docs, units.NOT_SPACE)
    if len(starts):
        of = np.repeat(np.arange(n), np.diff(offsets))
        count = np.diff(offsets) + 10
        hashed = units.hash_spans(data, starts, ends)
        last = np.maximum(ends - 3, starts)
        same = np.zeros(len(starts), bool)
        same[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
        flags = (
            _UPPER[data[starts]],
            _UPPER[data[starts]] & _UPPER[data[last]] & (ends - starts > 1),
            ~units.ALNUM[data[ends - 1]],
            ~units.ALNUM[data[last]],
            ~units.ALNUM[data[starts]],
            same,
        )
        for i, flag in enumerate(flags):
            out[:, _ASCII + i] = np.bincount(of[flag], minlength=n) / count
        out[:, SHAPES - 1] = np.minimum(np.bincount(of, ends - starts, minlength=n) / count / 20, 2)
    return out
