"""One logistic regression for each fold, all fitted side by side.

Every model leaves one fold out, so a row counts for all models but one. Each scan of the
stored sparse counts evaluates all models at their own points: it gives every model's loss and
gradient, summed per task and then by Spark. The driver holds the coefficients, whose number
is fixed by the number of hash buckets and folds, and takes the models' steps in turn.
The objective is that of Spark's own regression over TF-IDF features: mean log loss plus the
L2 penalty on standardised coefficients; the inverse document frequencies cancel out in it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modsieve.operators.partials import ROWS, SUMS, emit, lists, pieces, summed

HISTORY = 10
ARMIJO, WOLFE = 1e-4, 0.9


@dataclass(frozen=True)
class FoldModels:
    """Coefficients of raw counts (one row for each fold), intercepts, and scans of the rows."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    scans: int


def moments(rows: DataFrame, n: int, buckets: int) -> tuple[np.ndarray, ...]:
    """By fold (the last one: all rows in none of them): rows, positives, and for each bucket the
    sums, the sums of squares and the numbers of rows that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((3 * (n + 1), buckets))
        heads = np.zeros((n + 1, 2))
        for batch in pieces(batches):
            places, offsets = lists(batch.column("places"))
            counts, _ = lists(batch.column("counts"))
            label, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            fold = np.where((fold >= 0) & (fold < n), fold, n)
            heads += np.stack([np.bincount(fold, w, n + 1) for w in (np.ones(len(fold)), label)], axis=1)
            cell = np.repeat(fold, np.diff(offsets)) * buckets + places
            for i, w in enumerate((counts, counts**2, (counts > 0).astype(float))):
                table[i :: 3] += np.bincount(cell, w, (n + 1) * buckets).reshape(n + 1, buckets)
        yield from emit(np.hstack([table, np.repeat(heads, 3, axis=0)]))

    whole = summed(rows.mapInArrow(run, SUMS), 3 * (n + 1), buckets + 2)
    return whole[0::3, buckets], whole[0::3, buckets + 1], whole[0::3, :buckets], whole[1::3, :buckets], whole[2::3, :buckets]


def evaluate(rows: DataFrame, n: int, coefficients: np.ndarray, intercepts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every model's summed log loss, and its derivatives by intercept and raw coefficients: one scan."""
    buckets = coefficients.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((np.ascontiguousarray(coefficients.T), intercepts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_place, constant = shared.value
        table = np.zeros((n, buckets + 2))
        for batch in pieces(batches):
            places, offsets = lists(batch.column("places"))
            counts, _ = lists(batch.column("counts"))
            label, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            owner = np.repeat(np.arange(len(label)), np.diff(offsets))
            for k in range(n):
                margin = constant[k] + np.bincount(owner, by_place[places, k] * counts, len(label))
                used = fold != k
                off = (np.exp(-np.logaddexp(0, -margin)) - label) * used
                table[k, :buckets] += np.bincount(places, counts * off[owner], buckets)
                table[k, buckets] += off.sum()
                table[k, buckets + 1] += (np.logaddexp(0, margin) - label * margin)[used].sum()
        yield from emit(table)

    whole = summed(rows.mapInArrow(run, SUMS), n, buckets + 2)
    shared.destroy()
    return whole[:, buckets + 1], whole[:, buckets], whole[:, :buckets]


def descend(start: np.ndarray, steps: int, tolerance: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Limited-memory quasi-Newton steps; yields the points to evaluate, returns the last one."""
    at, history = start, deque(maxlen=HISTORY)
    value, slope = yield at
    for _ in range(steps):
        way = slope.copy()
        scales = []
        for s, y in reversed(history):
            scales.append((s @ way) / (y @ s))
            way -= scales[-1] * y
        if history:
            s, y = history[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), scale in zip(history, reversed(scales)):
            way += (scale - (y @ way) / (y @ s)) * s
        down = -(way @ slope)
        if down >= 0:
            break
        step, low, high = 1.0 if history else 1.0 / max(1.0, float(np.linalg.norm(way))), 0.0, np.inf
        for _ in range(20):  # bisection for a step that falls far enough and is not too short
            trial = at - step * way
            new_value, new_slope = yield trial
            if new_value > value + ARMIJO * step * down:
                high = step
            elif -(way @ new_slope) < WOLFE * down:
                low = step
            else:
                break
            step = (low + high) / 2 if high < np.inf else 2 * step
        if new_value >= value:
            break
        done = value - new_value <= tolerance * max(abs(value), abs(new_value), 1e-12)
        if (trial - at) @ (new_slope - slope) > 0:
            history.append((trial - at, new_slope - slope))
        at, value, slope = trial, new_value, new_slope
        if done:
            break
    return at


def fit_folds(
    rows: DataFrame, n: int, buckets: int, *, reg: float, steps: int, min_documents: int = 1, tolerance: float = 1e-6
) -> FoldModels:
    """Fit the ``n`` models over ``rows``: ``places, counts, label (double), fold``, labels not null.

    A model whose rows all have one label gives that label with certainty, as Spark's does.
    """
    size, positive, total, squares, documents = moments(rows, n, buckets)
    size, positive = size.sum() - size[:n], positive.sum() - positive[:n]
    if (size == 0).any():
        raise ValueError(f"no labelled rows to fit folds {np.flatnonzero(size == 0).tolist()}")
    total, squares, documents = (x.sum(axis=0) - x[:n] for x in (total, squares, documents))
    variance = (squares - total**2 / size[:, None]) / np.maximum(size - 1, 1)[:, None]
    # A bucket in no row, in every row, or in too few of them has a weight of zero in TF-IDF.
    kept = (variance > 1e-12) & (documents < size[:, None]) & (documents >= min_documents)
    unit = np.where(kept, 1 / np.sqrt(np.where(kept, variance, 1)), 0)
    mean = total / size[:, None] * unit
    mixed = (positive > 0) & (positive < size)
    share = np.clip(positive / size, 1e-12, 1 - 1e-12)

    def raw(point: np.ndarray, k: int) -> tuple[np.ndarray, float]:
        return point[:-1] * unit[k], point[-1] - point[:-1] @ mean[k]

    points, scans = {}, 0
    searches = {k: descend(np.append(np.zeros(buckets), np.log(share[k] / (1 - share[k]))), steps, tolerance) for k in np.flatnonzero(mixed)}
    asked = {k: next(search) for k, search in searches.items()}
    while asked:
        coefficients, intercepts = np.zeros((n, buckets)), np.zeros(n)
        for k, point in asked.items():
            coefficients[k], intercepts[k] = raw(point, k)
        loss, by_intercept, by_place = evaluate(rows, n, coefficients, intercepts)
        scans += 1
        following = {}
        for k, point in asked.items():
            beta = point[:-1]
            value = loss[k] / size[k] + reg / 2 * beta @ beta
            slope = (by_place[k] * unit[k] - mean[k] * by_intercept[k]) / size[k] + reg * beta
            try:
                following[k] = searches[k].send((value, np.append(slope, by_intercept[k] / size[k])))
            except StopIteration as end:
                points[k] = end.value
        asked = following
    coefficients, intercepts = np.zeros((n, buckets)), np.where(positive > 0, np.inf, -np.inf)
    for k, point in points.items():
        coefficients[k], intercepts[k] = raw(point, k)
    return FoldModels(coefficients, intercepts, scans)


def predicted(models: FoldModels, rows: DataFrame, places: str, counts: str, fold: str) -> Column:
    """Each row's probability by the model that left its fold out."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("double")
    def probability(places: pa.Array, counts: pa.Array, fold: pa.Array) -> pa.Array:
        def of(places: pa.Array, counts: pa.Array, k: np.ndarray) -> np.ndarray:
            at, offsets = lists(places)
            times, _ = lists(counts)
            owner = np.repeat(np.arange(len(k)), np.diff(offsets))
            margin = np.bincount(owner, shared.value.coefficients[k[owner], at] * times, len(k)) + shared.value.intercepts[k]
            return np.exp(-np.logaddexp(0, -margin))

        k = fold.to_numpy(zero_copy_only=False)
        cut = [slice(i, i + ROWS) for i in range(0, len(k), ROWS)]
        return pa.array(np.concatenate([np.zeros(0), *[of(places[c], counts[c], k[c]) for c in cut]]))

    return probability(places, counts, fold)
