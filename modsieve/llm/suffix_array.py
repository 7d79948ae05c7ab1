"""Exact substring dedup with difference-cover suffix arrays.

Byte windows that repeat are found by ``repeats``: content decides which shard a window is
judged in, so equal windows meet although no shard sees the whole corpus. Each shard builds
the suffix array of its runs by the difference cover {1, 2} mod 3: the triples at those
places are sorted and named; while names repeat, the names are sorted by the same method;
the remaining suffixes are ordered by their first unit and the rank that follows, and merged
in. Two neighbours in the array with a common prefix of ``length`` bytes repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.llm import units
from modsieve.llm.repeats import Windows, distinct_ids, given_ids, repeated_windows, with_spans

LENGTH = 400
ANCHOR = 250


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of whole numbers from 0 on (fewer than 2**21 units)."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    s = s.astype(np.int64) + 1
    width = int(s.max()) + 1
    t = np.concatenate([s, np.zeros(3, np.int64)])
    place = np.arange(n + (n % 3 == 1))  # one more place, so that the two halves do not touch
    ones, twos = place[place % 3 == 1], place[place % 3 == 2]
    cover = np.concatenate([ones, twos])
    triple = (t[cover] * width + t[cover + 1]) * width + t[cover + 2]
    order = np.argsort(triple, kind="stable")
    sorted_triple = triple[order]
    name = np.empty(len(cover), np.int64)
    name[order] = np.cumsum(np.concatenate([[0], sorted_triple[1:] != sorted_triple[:-1]]))
    if name.max() + 1 < len(cover):
        order = suffix_array(name)
    sampled = cover[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = np.arange(1, len(sampled) + 1)
    sampled = sampled[sampled < n]
    # The remaining suffixes: first unit, then the rank of the rest.
    big = len(cover) + 2
    rest = np.arange(0, n, 3)
    short = t[rest] * big + rank[rest + 1]
    rest = rest[np.argsort(short, kind="stable")]
    short = np.sort(short)
    long = (t[rest] * width + t[rest + 1]) * big + rank[rest + 2]
    # Merge: how many of the rest come before each sampled suffix.
    after_one = t[sampled] * big + rank[sampled + 1]
    after_two = (t[sampled] * width + t[sampled + 1]) * big + rank[sampled + 2]
    before = np.where(sampled % 3 == 1, np.searchsorted(short, after_one), np.searchsorted(long, after_two))
    out = np.full(n, -1, np.int64)
    out[np.arange(len(sampled)) + before] = sampled
    out[out < 0] = rest
    return out


def shared_windows(length: int):
    def shared(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Flags of the windows whose neighbour in suffix order has the same first bytes."""
        runs = len(starts)
        # A lowest separator ends each run.
        t = np.zeros(len(text) + runs, np.int64)
        shift = np.repeat(np.arange(runs), sizes)
        t[np.arange(len(text)) + shift] = text.astype(np.int64) + 1
        order = suffix_array(t)
        first = starts + np.arange(runs)
        at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        window = np.zeros(len(t), bool)
        window[at] = True
        order = order[window[order]]
        prefix = units.grams(units.mix(t.astype(np.uint64)), length)
        same = prefix[order[1:]] == prefix[order[:-1]]
        found = np.zeros(len(t), bool)
        found[order[1:][same]] = True
        found[order[:-1][same]] = True
        return found[at]

    return shared


def _bytes(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return units.mix(data.astype(np.uint64) + units.U64(1)), docs


def drop_repeats(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """One row per document row: ``id, kept (binary), n_bytes, spans (array of [a, b) in bytes)``.

    ``spans`` are the maximal runs of bytes covered by a string of ``length`` bytes that also
    starts anywhere else, in this document or another; ``kept`` is what is left (a cut may
    split a character). All is judged on the input. Null and empty texts have no bytes.
    Repeated rows are copies of each other; rows with one id and different texts are different documents. A row without an id keeps all its bytes and is no
    copy of another. Other columns are ignored.
    """
    if not 1 <= anchor <= length:
        raise ValueError("the anchor must be no longer than the window")
    w = Windows(length, anchor, False, _bytes)
    given = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts, numbers = distinct_ids(given)
    spans = repeated_windows(texts, w, lambda data, u: data, "u1", shared_windows(length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            wanted = batch.column(2)
            for first, last, data, docs in units.chunks(batch.column(1)):
                kept, found = [], []
                for i in range(first, last):
                    body = data[docs[i - first] : docs[i - first + 1]]
                    starts = wanted[i].as_py()
                    if not starts:
                        kept.append(body.tobytes())
                        found.append([])
                        continue
                    a = np.array([r["start"] for r in starts])
                    b = np.minimum(a + [r["n"] - 1 + length for r in starts], len(body))
                    gone = units.cover(len(body), np.minimum(a, len(body)), b)
                    kept.append(body[~gone].tobytes())
                    found.append([{"a": int(x), "b": int(y)} for x, y in zip(*units.runs(gone))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(kept, pa.binary()),
                        pa.array(np.diff(docs), pa.int64()),
                        pa.array(found, pa.list_(kind)),
                    ],
                    names=["id", "kept", "n_bytes", "spans"],
                )

    schema = "id bigint, kept binary, n_bytes bigint, spans array<struct<a:bigint,b:bigint>>"
    found = with_spans(texts, spans).mapInArrow(run, schema)
    return given_ids(found, numbers).withColumnRenamed("id", id_col)
