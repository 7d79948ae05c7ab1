"""Ranked lexical search: term at a time with a limited set of accumulators.

Documents are read once into rows of the asked terms' counts, which are stored; the corpus
figures (documents, terms, document frequencies) are sums over all of them. Queries are then
answered over runs of documents: a query's posting lists are taken rarest term first, each
document met gets an accumulator, and no more are made as soon as all remaining terms
together cannot lift a new document to the k-th partial score. The survivors go on to be
updated exactly. A task carries its k best from run to run, so later runs stop earlier, and
sends back k rows for each query; these are merged by rank.

Queries go to the tasks in blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modsieve.llm import units
from modsieve.session import cut_lineage

#: Bytes of query text in a block: what is broadcast is a few times this.
BLOCK_BYTES = 4 << 20
#: Postings that one run of documents holds at most (one document may hold more).
RUN_POSTINGS = 1 << 20
PIECE_BYTES = 1 << 20


def pieces(data: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[np.ndarray]:
    """A text's bytes in pieces of about ``limit``, cut where no term is cut."""
    first = 0
    while first < len(data):
        last = min(first + limit, len(data))
        while last < len(data) and units.ALNUM[data[last]]:
            gap = np.flatnonzero(~units.ALNUM[data[last : last + limit]])
            last = last + int(gap[0]) if len(gap) else min(last + limit, len(data))
        yield data[first:last]
        first = last


def term_hashes(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms with A-Z lower-cased, and the offsets of each text's terms."""
    low = units.LOWER[data]
    starts, ends, offsets = units.words(low, docs, units.ALNUM)
    return units.hash_spans(low, starts, ends), offsets


class Queries:
    """A block of queries: their names, and their terms with repeats as numbers of a vocabulary."""

    def __init__(self, rows: list[tuple[object, str]]):
        self.names = [name for name, _ in rows]
        hashes, bounds = np.zeros(0, np.uint64), np.zeros(len(rows) + 1, np.int64)
        texts = pa.array([text for _, text in rows], pa.large_string())
        for _, _, data, docs in units.chunks(texts, 1 << 62):
            hashes, bounds = term_hashes(data, docs)
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        self.terms = [np.unique(number[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are asked terms, and the terms' numbers."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        known = np.flatnonzero(self.vocabulary[at] == hashes) if len(self.vocabulary) else np.zeros(0, np.int64)
        return known, at[known]


def count_terms(queries: Queries, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, terms in all, offsets, asked terms, their counts)`` by chunks of texts."""
    size = np.int64(max(1, len(queries.vocabulary)))
    for first, last, data, docs in units.chunks(texts):
        # Only a chunk of one text can be longer than a piece.
        parts = [(data, docs)] if last - first > 1 else [(p, np.array([0, len(p)])) for p in pieces(data)]
        total, keys, counts = np.zeros(last - first, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part, ends in parts:
            hashes, offsets = term_hashes(part, ends)
            total += np.diff(offsets)
            at, number = queries.numbers(hashes)
            doc = np.searchsorted(offsets, at, side="right") - 1
            new, times = np.unique(doc * size + number, return_counts=True)
            if len(keys):
                both = np.concatenate([keys, new])
                keys, where = np.unique(both, return_inverse=True)
                counts = np.bincount(where, np.concatenate([counts, times]), len(keys)).astype(np.int64)
            else:
                keys, counts = new, times
        yield first, last, total, np.searchsorted(keys // size, np.arange(last - first + 1)), keys % size, counts


class Scorer:
    """A block's queries with the corpus figures; keeps the best documents of a task."""

    def __init__(self, queries: Queries, documents: int, terms: int, frequencies: np.ndarray, k: int):
        self.n, self.length, self.k = documents, terms, k
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64
        )
        self.lists = []
        for numbers, times in queries.terms:
            use = frequencies[numbers] > 0
            numbers, times = numbers[use], times[use]
            order = np.lexsort((numbers, frequencies[numbers]))  # rarest first
            self.lists.append((numbers[order].tolist(), times[order].tolist()))
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.lists]

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """Each document's ``m``; products that no long holds are taken in Python's integers."""
        if 25 * self.n * int(n.max(initial=0)) < 1 << 63:
            return 75 + 25 * n * self.n // max(1, self.length)
        return np.array([75 + 25 * int(x) * self.n // self.length for x in n], np.int64)

    def add(self, ids: np.ndarray, n: np.ndarray, offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        """Rank one run of documents into the best so far."""
        owner = np.repeat(np.arange(len(ids)), np.diff(offsets))
        order = np.argsort(terms, kind="stable")
        terms, owner, tf = terms[order], owner[order], counts[order]
        part = self.weights[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * self.lengths(n)[owner]))
        there, first = np.unique(terms, return_index=True)
        edges = [*first.tolist(), len(terms)]
        top = np.maximum.reduceat(part, first).tolist() if len(first) else []
        lists = {t: (owner[a:b], part[a:b], m) for t, a, b, m in zip(there.tolist(), edges, edges[1:], top)}
        for q, (numbers, times) in enumerate(self.lists):
            own = [(*lists[t], c) for t, c in zip(numbers, times) if t in lists]
            if own:
                self.best[q] = self.merge(self.best[q], *self.accumulate(own, len(ids), self.best[q][0]), ids)

    def accumulate(self, lists: list, n: int, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best, and their whole scores."""
        score = np.zeros(n, np.int64)
        rest = sum(most * times for _, _, most, times in lists)  # what the remaining terms can add
        least = int(before[-1]) if len(before) == self.k else 0
        open_, left = True, None
        for docs, part, most, times in lists:
            if open_ and (rest < least or np.count_nonzero(score > rest) >= self.k):
                # A new document would stay below the k-th partial score.
                open_ = False
                if len(alive := score[score > 0]) >= self.k:
                    least = max(least, int(np.partition(alive, -self.k)[-self.k]))
                left = score + rest >= max(least, 1)
                left &= score > 0
            rest -= most * times
            if open_:
                score[docs] += times * part
            else:
                use = left[docs]
                score[docs[use]] += times * part[use]
        found = np.flatnonzero(score > 0 if left is None else left & (score > 0))
        found = found[score[found] >= least]
        return found, score[found]

    def merge(self, best, found: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scores, names = np.concatenate([best[0], scores]), np.concatenate([best[1], ids[found]])
        order = np.lexsort((names, -scores))[: self.k]
        return scores[order], names[order]


def _runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + RUN_POSTINGS, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def _rank(counted: DataFrame, queries: Queries, terms: int, frequencies: np.ndarray, documents: int, k: int) -> DataFrame:
    shared = counted.sparkSession.sparkContext.broadcast((queries, frequencies))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df = shared.value
        scorer = Scorer(known, documents, terms, df, k)
        for batch in batches:
            ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            numbers, counts = batch.column(2), batch.column(3)
            offsets = numbers.offsets.to_numpy() - numbers.offsets[0].as_py()
            numbers, counts = numbers.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
            for a, b in _runs(offsets):
                some = slice(offsets[a], offsets[b])
                scorer.add(ids[a:b], n[a:b], offsets[a : b + 1] - offsets[a], numbers[some], counts[some])
        for q, (scores, names) in enumerate(scorer.best):
            if len(scores):
                columns = [pa.array(np.full(len(scores), q)), pa.array(names), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["q", "id", "score"])

    return counted.mapInArrow(run, "q long, id long, score long")


def _count(documents: DataFrame, queries: Queries) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Queries = shared.value
        for batch in batches:
            for first, last, total, offsets, numbers, counts in count_terms(known, batch.column(1)):
                columns = [
                    batch.column(0).slice(first, last - first),
                    pa.array(total, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(counts, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tfs"])

    return documents.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def ranked_search(
    documents: DataFrame,
    queries: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    k: int = 20,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query id, rank, doc id, score``: each query's ``k`` best documents with a score above 0.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with
    A-Z lower-cased; they are compared by 64-bit hashes. With N documents that have terms, L
    terms in all and n in a document, a term that is found in df documents has the weight
    ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``, and a document's score is the sum over the query's
    terms, repeats included, of ``w * ((10**9 * tf) div (1000 * tf + 12 * m))`` with
    ``m = 75 + (25 * n * N) div L``. Equal scores go to the smaller id.

    Null and empty texts have no terms on either side: such documents count nowhere, such
    queries have no rows. Documents without an id count in all figures but cannot be named and are
    not returned. Repeated documents are ranked each for itself; equal queries (id and text) are
    asked once, queries with one id and different texts each have their own ranks. Other columns
    are ignored. Empty tables give an empty result.
    """
    spark = documents.sparkSession
    kind = queries.schema[query_id_col].dataType.simpleString()
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = queries.select(F.col(query_id_col).alias("name"), F.col(query_text_col).alias("text"))
    asked = cut_lineage(asked.where("text <> ''").distinct())
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("name", "text"), F.lit(blocks))
    answers = []
    for b in range(blocks):
        # A block is bounded; it is let go before the next one is read.
        some = Queries([tuple(r) for r in asked.where(block == b).collect()])
        counted = cut_lineage(_count(texts, some).where("n > 0"))
        total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        found = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
        frequencies = np.zeros(len(some.vocabulary), np.int64)
        for row in found.collect():  # one row for each asked term at most
            frequencies[row["t"]] = row["df"]
        best = _rank(counted.where("id is not null"), some, total[1] or 0, frequencies, total[0], k)
        place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
        best = best.withColumn("rank", place).where(F.col("rank") <= k)
        # As many names as the block has queries.
        names = spark.createDataFrame([(q, name) for q, name in enumerate(some.names)], f"q long, name {kind}")
        ranked = best.join(F.broadcast(names), "q").select("name", "rank", "id", "score")
        answers.append(ranked if blocks == 1 else cut_lineage(ranked))
    out = answers[0]
    for other in answers[1:]:
        out = out.unionByName(other)
    return out.select(F.col("name").alias(query_id_col), "rank", F.col("id").alias(id_col), "score")
