"""Hard negatives by a vertical scan of whole-number vectors (branch and bound on dimensions).

A shard keeps one column for each dimension. For an anchor the columns are read in order of
its components' size. What the columns not read yet can still add lies between two sums of
the anchor's products with their smallest and largest values; so each row's score has bounds that
narrow with every step, and rows that no answer can need leave the bitmap. A first scan finds
the nearest rows of the anchor's label; they fix windows of scores. A second scan keeps the
rows of other labels whose bounds still touch a window, until their scores are exact.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modsieve.llm import shards
from modsieve.session import cut_lineage

STEP = 8
SCHEMA = "q long, place long, id long, label string, score long"


class Columns:
    """A shard by columns, with the range of each column."""

    def __init__(self, part: shards.Part, codes: np.ndarray):
        self.ids, self.columns = part.ids, np.ascontiguousarray(codes.T)
        names, self.labels = np.unique(np.array(part.label, object).astype(str), return_inverse=True)
        self.names = {name: i for i, name in enumerate(names.tolist())}
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def same_label(self, label: str) -> np.ndarray:
        return self.labels == self.names.get(label, -1)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, needed: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are ``needed`` by their bounds to the end, and their scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[: np.count_nonzero(anchor)]
        ends = anchor[order] * self.low[order], anchor[order] * self.high[order]
        least, most = np.minimum(*ends), np.maximum(*ends)
        least_left, most_left = least.sum(), most.sum()
        score = np.zeros(len(rows), self.columns.dtype)
        for i in range(0, len(order), STEP):
            dims = order[i : i + STEP]
            score = score + anchor[dims] @ self.columns[dims[:, None], rows]
            least_left, most_left = least_left - least[i : i + STEP].sum(), most_left - most[i : i + STEP].sum()
            keep = needed(score + least_left, score + most_left)
            if not keep.all():
                rows, score = rows[keep], score[keep]
            if not len(rows):
                break
        return rows, score


def kth_largest(values: np.ndarray, k: int):
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


def reaches_best(k: int) -> Callable:
    """Rows whose upper bound reaches the ``k``-th largest lower bound."""

    def needed(lower, upper):
        return upper >= kth_largest(lower, k) if len(lower) > k else np.ones(len(lower), bool)

    return needed


def touches(windows: list[tuple[int, int]], k: int) -> Callable:
    """Rows that may be among the ``k`` largest inside some window ``[low, high]``."""

    def needed(lower, upper):
        keep = np.zeros(len(lower), bool)
        for low, high in windows:
            inside = (upper >= low) & (lower <= high)
            certain = lower[(lower >= low) & (upper <= high)]
            if len(certain) >= k:
                inside &= upper >= kth_largest(certain, k)
            keep |= inside
        return keep

    return needed


def best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, equal ones by id."""
    return np.lexsort((ids[rows], -scores))[:k]


def _batch(found: list[tuple[int, int, int, str, int]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    columns = zip(*found) if found else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["q", "place", "id", "label", "score"]
    )


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    shard_components: int = shards.SHARD_COMPONENTS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank``.

    Components become ``floor(scale * x)``, scores are exact inner products, higher ones come
    first and equal ones by id. An anchor's positives are its first rows of the same label. For
    each of them the first rows of another label follow whose score times 100 lies between
    ``low_percent`` and ``high_percent`` times the positive's score; with a negative
    positive score there are none in ``[80, 100]``.

    Rows and anchors without an id or label, with a null vector, or with a null or non-finite
    component take no part. Rows with an anchor's id are its own, neither positive nor negative.
    Repeated rows count each for itself (so a repeated positive has its negatives twice, under
    two ``positive_rank``); equal anchors are asked once. Shorter vectors count as filled up with
    zeros; scores beyond a long become the nearest long, windows are taken from those. Other columns are
    ignored; an empty table on either side gives an empty result.
    """
    rows = cut_lineage(shards.sound_vectors(vectors, id_col, vector_col, label_col))
    asked = shards.numbered(shards.sound_vectors(anchors, id_col, vector_col, label_col))

    def index(part: shards.Part) -> shards.Exact:
        return shards.Exact(part, lambda codes: Columns(part, codes))

    def nearest(shard: shards.Exact, part: shards.Part) -> pa.RecordBatch:
        known, queries = shard.fit(part.codes)
        found = []
        for q, own, label, anchor in zip(part.q.tolist(), part.ids.tolist(), part.label, queries):
            bitmap = known.same_label(label) & (known.ids != own)
            left, scores = known.scan(anchor, np.flatnonzero(bitmap), reaches_best(positives))
            for i in best(left, scores, known.ids, positives):
                found.append((q, 0, int(known.ids[left[i]]), label, *shards.to_long([scores[i]])))
        return _batch(found)

    def in_windows(shard: shards.Exact, part: shards.Part) -> pa.RecordBatch:
        known, queries = shard.fit(part.codes)
        found = []
        for q, own, label, anchor, extra in zip(part.q.tolist(), part.ids.tolist(), part.label, queries, part.extra):
            # Whole scores with low_percent * p <= 100 * score <= high_percent * p.
            windows = [(-(-low_percent * p // 100), high_percent * p // 100) for p in extra]
            bitmap = ~known.same_label(label) & (known.ids != own)
            left, scores = known.scan(anchor, np.flatnonzero(bitmap), touches(windows, negatives))
            for place, (low, high) in enumerate(windows, 1):
                inside = np.flatnonzero((scores >= low) & (scores <= high))
                for i in inside[best(left[inside], scores[inside], known.ids, negatives)]:
                    name = int(known.ids[left[i]])
                    found.append((q, place, name, None, *shards.to_long([scores[i]])))
        return _batch(found)

    none = F.array().cast("array<long>")
    near = shards.meet(rows, asked.withColumn("extra", none), index, nearest, SCHEMA, scale, shard_components)
    # Few rows of each shard are merged here and below, never the shard.
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    near = near.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= positives)
    near = cut_lineage(near.select("q", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))

    ordered = F.array_sort(F.collect_list(F.struct("place", "positive_score")))  # at most ``positives``
    windows = near.groupBy("q").agg(F.transform(ordered, lambda s: s["positive_score"]).alias("extra"))
    far = shards.meet(rows, asked.join(windows, "q"), index, in_windows, SCHEMA, scale, shard_components)
    order = Window.partitionBy("q", "place").orderBy(F.desc("score"), "id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    far = far.select("q", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = asked.select("q", F.col("id").alias("anchor_id"))
    return far.join(near, ["q", "place"]).join(names, "q").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        F.col("place").cast("int").alias("positive_rank"),
    )
