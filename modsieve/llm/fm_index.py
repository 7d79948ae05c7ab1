"""Substring dedup by words with a compressed FM-index per shard.

Word windows that repeat are found by ``repeats``. Each shard indexes its runs: the
Burrows-Wheeler transform of their words lies in a wavelet tree of packed bits with sampled
counts, and backward search for every window of the runs gives its interval of suffixes, all
windows step by step together. A window whose interval holds a place before its own occurs
earlier. Patterns have at most ``length`` words, so suffixes are sorted by that many only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.llm import units
from modsieve.llm.repeats import Windows, distinct_ids, given_ids, repeated_windows, with_spans

LENGTH = 20
ANCHOR = 10


class Bits:
    """Packed bits with the number of ones before each word of 64."""

    def __init__(self, flags: np.ndarray):
        padded = np.zeros(-(-(len(flags) + 1) // 64) * 64, bool)
        padded[: len(flags)] = flags
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (units.U64(1) << (at & 63).astype(np.uint64)) - units.U64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletTree:
    """Ranks of symbols in a sequence, one level of bits for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append((bit, Bits(ones), int((~ones).sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        low, high = np.zeros(len(at), np.int64), at.astype(np.int64)
        for bit, bits, zeros in self.levels:
            one = (symbols >> bit) & 1 == 1
            a, b = bits.rank(low), bits.rank(high)
            low = np.where(one, zeros + a, low - a)
            high = np.where(one, zeros + b, high - b)
        return high - low


class FMIndex:
    """Backward search in a text of whole numbers; suffixes are sorted by ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        rank, size = text.astype(np.int64), 1
        while size <= depth:
            follow = np.zeros(len(rank), np.int64)
            follow[:-size] = rank[size:] + 1
            _, rank = np.unique(rank * (int(rank.max()) + 2) + follow, return_inverse=True)
            size *= 2
        self.places = np.argsort(rank, kind="stable")
        largest = int(text.max())
        self.tree = WaveletTree(text[self.places - 1], largest)
        count = np.bincount(text, minlength=largest + 1)
        self.first = np.concatenate([[0], np.cumsum(count)])

    def intervals(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the rows of ``patterns``."""
        last = patterns[:, -1]
        low, high = self.first[last], self.first[last + 1]
        for j in range(patterns.shape[1] - 2, -1, -1):
            c = patterns[:, j]
            low = self.first[c] + self.tree.rank(c, low)
            high = self.first[c] + self.tree.rank(c, high)
        return low, high

    def earliest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest place in each interval; intervals are equal or apart."""
        different, at = np.unique(low, return_inverse=True)
        ends = np.zeros(len(different), np.int64)
        ends[at] = high
        padded = np.append(self.places, len(self.places))
        cuts = np.stack([different, ends], axis=1).ravel()
        return np.minimum.reduceat(padded, cuts)[::2][at]


def shared_windows(length: int):
    def shared(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Flags of the windows that occur at an earlier place of the shard."""
        runs = len(starts)
        _, symbols = np.unique(text, return_inverse=True)
        t = np.zeros(len(text) + runs, np.int64)
        t[np.arange(len(text)) + np.repeat(np.arange(runs), sizes)] = symbols + 1
        index = FMIndex(t, length)
        first = starts + np.arange(runs)
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        out = np.zeros(len(at), bool)
        for k in range(0, len(at), 1 << 16):
            some = at[k : k + (1 << 16)]
            low, high = index.intervals(t[some[:, None] + np.arange(length)])
            out[k : k + len(some)] = index.earliest(low, high) < some
        return out

    return shared


def _words(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, offsets = units.words(data, docs, units.NOT_SPACE)
    return units.hash_spans(data, starts, ends), offsets


def drop_repeats(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """One row per document row: ``id, kept (text), n_words, spans (array of [a, b) in words)``.

    ``spans`` are the maximal runs of words covered by a window of ``length`` words whose
    sequence also starts earlier: in a document with a smaller id, or before in the same one.
    ``kept`` is the remaining words joined by one space. All is judged on the input. Words lie
    between ASCII white space, unchanged, and are compared by 64-bit hashes. Null and empty
    texts have no words. Repeated rows are one document; rows with one id and different texts are
    different documents, in the order of the texts' digests. A row without an id keeps all its
    words and is no other's model. Other columns are ignored.
    """
    if not 1 <= anchor <= length:
        raise ValueError("the anchor must be no longer than the window")
    w = Windows(length, anchor, True, _words)
    given = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts, numbers = distinct_ids(given)
    spans = repeated_windows(texts, w, lambda data, u: u, "u8", shared_windows(length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            wanted = batch.column(2)
            for first, last, data, docs in units.chunks(batch.column(1)):
                kept, found, sizes = [], [], []
                for i in range(first, last):
                    body = data[docs[i - first] : docs[i - first + 1]].tobytes()
                    words = body.split()  # bytes split at the same ASCII white space
                    sizes.append(len(words))
                    starts = wanted[i].as_py()
                    spans_here: list[dict] = []
                    if starts:
                        a = np.array([r["start"] for r in starts])
                        b = np.minimum(a + [r["n"] - 1 + length for r in starts], len(words))
                        gone = units.cover(len(words), np.minimum(a, len(words)), b)
                        spans_here = [{"a": int(x), "b": int(y)} for x, y in zip(*units.runs(gone))]
                        words = [x for x, out in zip(words, gone.tolist()) if not out]
                    found.append(spans_here)
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(kept, pa.string()),
                        pa.array(sizes, pa.int64()),
                        pa.array(found, pa.list_(kind)),
                    ],
                    names=["id", "kept", "n_words", "spans"],
                )

    schema = "id bigint, kept string, n_words bigint, spans array<struct<a:bigint,b:bigint>>"
    found = with_spans(texts, spans).mapInArrow(run, schema)
    return given_ids(found, numbers).withColumnRenamed("id", id_col)
