"""Benchmark decontamination by winnowing.

Of every ``width`` neighbouring k-grams of words the one with the smallest hash is a
fingerprint. A shared run of ``k + width - 1 = window`` words holds the same fingerprint
on both sides, so no shared window is missed. Fingerprints that meet are extended to the
left and right as long as the words agree. An item with fewer words than a window is one
short window and is looked up whole.

The benchmark is the small, fixed side: its fingerprints go to the tasks in blocks of at
most ``block_words`` words (some MB), one pass over the documents for each block, so what
is broadcast is bounded whatever the benchmark's size. Documents are never shuffled; when
there are several blocks, only the ids and word ranges of hits are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.llm import units

BLOCK_WORDS = 500_000
_SPAN = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def word_hashes(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, and the offsets of each document's words."""
    low = units.LOWER[data]
    starts, ends, offsets = units.words(low, docs, units.ALNUM)
    return units.hash_spans(low, starts, ends), offsets


class Fingerprints:
    """The fingerprints of one block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str]], window: int, k: int):
        self.names = [name for name, _ in items]
        self.window, self.k, self.width = window, k, window - k + 1
        self.words, self.bounds = np.zeros(0, np.uint64), np.zeros(1, np.int64)
        for _, _, data, docs in units.chunks(pa.array([t for _, t in items], pa.large_string()), 1 << 62):
            self.words, self.bounds = word_hashes(data, docs)
        places: dict[int, list[int]] = {}
        for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist()):
            if b - a >= window:
                found = units.winnow(units.grams(self.words[a:b], k), self.width)
                places.setdefault(0, []).extend((a + found).tolist())
            elif b > a:
                places.setdefault(b - a, []).append(a)
        self.tables = {}
        for size, at in places.items():
            hashed = [units.grams(self.words[p : p + (size or k)], size or k)[0] for p in at]
            order = np.argsort(np.array(hashed, np.uint64), kind="stable")
            self.tables[size] = (np.array(hashed, np.uint64)[order], np.array(at, np.int64)[order])

    def hits(self, words: np.ndarray, offsets: np.ndarray) -> dict[int, set[tuple[int, int, int]]]:
        """For each document of a chunk: item number and word range of every extended hit.

        Fingerprints are taken over the whole chunk: runs over a document's edge only add some.
        """
        out: dict[int, set[tuple[int, int, int]]] = {}
        for size, (known, places) in self.tables.items():
            grams = units.grams(words, size or self.k)
            own = np.arange(len(grams)) if size else units.winnow(grams, self.width)
            low = np.searchsorted(known, grams[own], side="left")
            high = np.searchsorted(known, grams[own], side="right")
            met = high > low
            docs = np.searchsorted(offsets, own[met], side="right") - 1
            reached: dict[tuple[int, int], int] = {}
            for doc, d, a, b in zip(docs.tolist(), own[met].tolist(), low[met].tolist(), high[met].tolist()):
                for p in places[a:b].tolist():
                    if reached.get((doc, d - p), -1) > d:
                        continue  # inside a run that is already extended
                    hit = self.extend(words, int(offsets[doc]), int(offsets[doc + 1]), d, p)
                    reached[doc, d - p] = hit[2]
                    if hit[2] - hit[1] >= min(self.window, int(self.bounds[hit[0] + 1] - self.bounds[hit[0]])):
                        out.setdefault(doc, set()).add(hit)
        return out

    def extend(self, words: np.ndarray, first: int, last: int, d: int, p: int) -> tuple[int, int, int]:
        item = int(np.searchsorted(self.bounds, p, side="right")) - 1
        back = min(d - first, p - int(self.bounds[item]))
        same = words[d - back : d][::-1] == self.words[p - back : p][::-1]
        back = back if same.all() else int(np.argmin(same))
        ahead = min(last - d, int(self.bounds[item + 1]) - p)
        same = words[d : d + ahead] == self.words[p : p + ahead]
        ahead = ahead if same.all() else int(np.argmin(same))
        return item, d - back, d + ahead


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    k: int = 6,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document row: ``id, n_words, n_hit, items (array), spans (array of [a, b))``.

    A word is hit when it lies in an occurrence of ``window`` consecutive words of an item
    (of the whole item if it has fewer). Words are compared by 64-bit hashes of their
    lower-cased bytes; ``spans`` are word ranges. Null and empty texts have no words and no
    hits, on either side. Repeated documents give repeated rows; items with equal texts all
    count, under one name once; an item without a name hits but is not listed. Other columns
    are ignored. Without a benchmark nothing is hit.
    """
    if not 1 <= k <= window:
        raise ValueError("k must lie between 1 and the window")
    context = documents.sparkSession.sparkContext
    kind = documents.schema[id_col].dataType.simpleString()
    narrow = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, text_key binary, n_words bigint, n_hit bigint, items array<string>, spans array<struct<a:bigint,b:bigint>>"

    def scan(block: Fingerprints) -> DataFrame:
        shared = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: Fingerprints = shared.value
            for batch in batches:
                for first, last, data, docs in units.chunks(batch.column(1)):
                    words, offsets = word_hashes(data, docs)
                    found = known.hits(words, offsets)
                    n_hit = np.zeros(last - first, np.int64)
                    items: list[list[str]] = [[] for _ in range(last - first)]
                    spans: list[list[dict]] = [[] for _ in range(last - first)]
                    for doc, hits in found.items():
                        item, start, end = np.array(sorted(hits), np.int64).T
                        flags = units.cover(int(offsets[doc + 1] - offsets[doc]), start - offsets[doc], end - offsets[doc])
                        n_hit[doc] = flags.sum()
                        items[doc] = sorted({known.names[i] for i in item.tolist()} - {None})
                        spans[doc] = [{"a": int(a), "b": int(b)} for a, b in zip(*units.runs(flags))]
                    columns = [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array(items, pa.list_(pa.string())),
                        pa.array(spans, pa.list_(_SPAN)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "text_key", "n_words", "n_hit", "items", "spans"])

        return keyed.mapInArrow(run, schema)

    blocks = list(_blocks(benchmark, item_col, item_text_col, block_words, window, k))
    key = F.lit(None).cast("binary") if len(blocks) == 1 else F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    keyed = narrow.select("id", "text", key.alias("text_key"))
    scans = [scan(b) for b in blocks]
    result = scans[0] if len(scans) == 1 else _merge(scans)
    return result.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", "spans")


def _blocks(
    benchmark: DataFrame, item_col: str, text_col: str, limit: int, window: int, k: int
) -> Iterator[Fingerprints]:
    """The benchmark in blocks of about ``limit`` words, fetched one partition at a time."""
    block: list[tuple[str | None, str]] = []
    size, made = 0, 0
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).cast("string"), text_col)
    for name, text in rows.toLocalIterator():
        block.append((name, text))
        size += len(text.split()) + 1
        if size >= limit:
            yield Fingerprints(block, window, k)
            block, size, made = [], 0, made + 1
    if block or not made:
        yield Fingerprints(block, window, k)


def _merge(scans: list[DataFrame]) -> DataFrame:
    """Put together what the blocks found; only hits move, by id and text digest."""
    hits = scans[0].where("n_hit > 0")
    for other in scans[1:]:
        hits = hits.unionByName(other.where("n_hit > 0"))
    both = hits.groupBy("id", "text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("all"),
    )
    # Ranges in order of their starts become their union.
    union = F.expr(
        """aggregate(all, cast(array() as array<struct<a:bigint,b:bigint>>), (done, x) ->
           if(size(done) > 0 and x.a <= element_at(done, -1).b,
              concat(slice(done, 1, size(done) - 1),
                     array(named_struct('a', element_at(done, -1).a, 'b', greatest(element_at(done, -1).b, x.b)))),
              concat(done, array(x))))"""
    )
    both = both.select("id", "text_key", "items", union.alias("spans"))
    total = F.expr("aggregate(spans, 0L, (n, x) -> n + x.b - x.a)")
    rows = scans[0].select("id", "text_key", "n_words").alias("r")
    joined = rows.join(both.alias("h"), F.expr("r.id <=> h.id and r.text_key <=> h.text_key"), "left")
    joined = joined.select(
        "r.id",
        "r.n_words",
        F.coalesce("h.items", F.expr("cast(array() as array<string>)")).alias("items"),
        F.coalesce("h.spans", F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)")).alias("spans"),
    )
    return joined.withColumn("n_hit", total)
