"""Exact top-k search by inner product: MaxScore over the posting lists of dimensions.

A term is a dimension; its posting list holds the rows in which it is not zero. What a query can
gain from a list is bounded by its own component times the largest or the smallest one of the
list. The lists with the smallest bounds, as long as these add up to no more than a share of
the k-th best score so far, are not essential: a row without enough from the other lists
cannot enter. Essential lists are traversed; the others are probed in order of their bounds, and only for the rows that can
still compete. Rows are taken in chunks, and the k-th best score rises from chunk
to chunk. Lists that hold most rows are stored as columns of a table. Every shard returns
its best rows, and the shards are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modsieve.llm import shards
from modsieve.session import cut_lineage

CHUNK_ROWS = 4096
PROBES = 8
#: Bounds of the lists that are only probed, against the k-th best score; below 1 fewer rows are probed.
SHARE = 0.25
#: Lists are stored as such if less than this share of the components is not zero.
SPARSE = 0.125
SCHEMA = "q long, id long, score long"


class Postings:
    """A shard's posting lists, cut at the chunks' edges."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, chunk: int = CHUNK_ROWS):
        self.ids, self.codes, self.chunk = ids, codes, chunk
        self.low = np.minimum(codes.min(axis=0, initial=0), 0)
        self.high = np.maximum(codes.max(axis=0, initial=0), 0)
        filled = codes != 0
        self.lists = None
        if filled.sum() < SPARSE * codes.size:
            edges = np.arange(0, len(ids) + chunk, chunk)
            rows = [np.flatnonzero(column) for column in filled.T]
            self.lists = [(r, codes[r, d], np.searchsorted(r, edges)) for d, r in enumerate(rows)]

    def traverse(self, query: np.ndarray, dims: np.ndarray, number: int) -> np.ndarray:
        """What the rows of a chunk get from the lists ``dims``."""
        low = number * self.chunk
        codes = self.codes[low : low + self.chunk]
        if self.lists is None:
            some = np.zeros_like(query)
            some[dims] = query[dims]
            return codes @ some
        part = np.zeros(len(codes), codes.dtype)
        for d in dims.tolist():
            rows, values, at = self.lists[d]
            a, b = at[number], at[number + 1]
            part[rows[a:b] - low] += query[d] * values[a:b]
        return part

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the ``k`` best rows (fewer if there are fewer) without rows of id ``own``."""
        used = np.flatnonzero(query != 0)
        bound = np.maximum(query[used] * self.low[used], query[used] * self.high[used])
        order = np.argsort(bound, kind="stable")
        used, bound = used[order], bound[order]
        until = np.cumsum(bound)  # what a row can gain from the first lists at most
        scores, ids = np.zeros(0, self.codes.dtype), np.zeros(0, np.int64)
        for number in range(-(-len(self.ids) // self.chunk)):
            least = scores[-1] if len(scores) == k else None
            cut = 0
            if least is not None and least > 0:
                cut = int(np.searchsorted(until, least * SHARE, side="right"))
            part = self.traverse(query, used[cut:], number)
            rest = until[cut - 1] if cut else 0
            rows = np.flatnonzero(part + rest >= least) if least is not None else np.arange(len(part))
            part, rows = part[rows], rows + number * self.chunk
            other = self.ids[rows] != own
            found, names = self.probe(query, used[:cut], bound[:cut], rows[other], part[other], least)
            if not len(found):
                continue
            scores, ids = np.concatenate([scores, found]), np.concatenate([ids, names])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
        return scores, ids

    def probe(self, query, dims, bound, rows, part, least) -> tuple[np.ndarray, np.ndarray]:
        """Whole scores of the rows that reach ``least``, from the lists left, largest bounds first."""
        rest = bound.sum()
        for end in range(len(dims), 0, -PROBES):
            if not len(rows):
                break
            some = slice(max(0, end - PROBES), end)
            part = part + self.codes[rows[:, None], dims[some]] @ query[dims[some]]
            rest = rest - bound[some].sum()
            alive = part + rest >= least
            rows, part = rows[alive], part[alive]
        return part, self.ids[rows]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    scale: float = 64.0,
    shard_components: int = shards.SHARD_COMPONENTS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` rows with the highest inner product.

    Components become ``floor(scale * x)``; products and sums are exact (a score that no long
    can hold becomes the nearest long). Equal scores go to the smaller id. Rows with a query's
    id are its own and no candidates for it. Rows of ``vectors`` and ``queries`` without an id, with a null
    vector or with a null or non-finite component take no part; a shorter vector counts as filled
    up with zeros. Repeated rows are candidates each for itself, equal queries are asked once. Other
    columns are ignored; an empty table on either side gives an empty result.
    """
    rows = cut_lineage(shards.sound_vectors(vectors, id_col, vector_col))
    asked = shards.numbered(shards.sound_vectors(queries, id_col, vector_col))

    def index(part: shards.Part) -> shards.Exact:
        return shards.Exact(part, lambda codes: Postings(part.ids, codes))

    def search(shard: shards.Exact, part: shards.Part) -> pa.RecordBatch:
        known, queries = shard.fit(part.codes)
        q, ids, scores = [], [], []
        for number, own, query in zip(part.q.tolist(), part.ids.tolist(), queries):
            best, names = known.best(own, query, k)
            q.extend([number] * len(best))
            ids.extend(names.tolist())
            scores.extend(shards.to_long(best))
        return pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["q", "id", "score"]
        )

    found = shards.meet(
        rows, asked.withColumn("extra", F.array().cast("array<long>")), index, search, SCHEMA, scale, shard_components
    )
    # At most k rows of each shard: the merge sorts nothing else.
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    names = asked.select("q", F.col("id").alias("query_id"))
    return ranked.join(names, "q").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
