"""Queries streamed past shards of rows, and vectors as matrices of whole numbers.

Rows are dealt to shards of bounded size by their place in a stored table, so copies and hot
ids spread evenly. Queries are dealt in bounded runs; each run meets each shard in one group:
the shard's rows come first and make an index, the queries follow batch by batch. A task
holds one shard and one batch of queries, whatever the tables' sizes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.session import cut_lineage

#: Vector components of a shard: tens of MB in a task with its index.
SHARD_COMPONENTS = 1 << 22
#: A shard smaller than this is not split for the sake of idle cores.
LEAST_COMPONENTS = 1 << 18
#: Queries that one task answers from one shard, so a lost task costs minutes.
RUN_QUERIES = 1 << 14
MAX_TASKS = 100_000


class Part(NamedTuple):
    """Rows of one kind: ids, vectors as exact whole numbers, and the other columns."""

    ids: np.ndarray
    codes: np.ndarray
    label: list
    q: np.ndarray
    extra: list


def sound_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """``(id, v, label)`` of the rows with an id, a label (if asked for) and a finite vector."""
    kind = df.schema[vector_col].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    label = F.lit("") if label_col is None else F.col(label_col).cast("string")
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"), label.alias("label")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return rows.where("id is not null and v is not null and label is not null").where(finite)


def numbered(queries: DataFrame) -> DataFrame:
    """The different queries, stored, each with a number ``q`` of its own."""
    stored = cut_lineage(queries.distinct())
    return stored.withColumn("q", F.monotonically_increasing_id())


def matrix(vectors: pa.ListArray, width: int, scale: float) -> np.ndarray:
    """``floor(scale * x)`` of every component; missing components of short vectors are zero."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < lengths[:, None]] = np.floor(values * scale)
    return out


def whole(codes: np.ndarray) -> np.ndarray:
    """The same numbers as Python's own integers, which have no bounds."""
    out = np.empty(codes.shape, object)
    out.flat[:] = [int(x) for x in codes.ravel()]
    return out


class Exact:
    """A shard's index over numbers in which all scores of the queries at hand are exact.

    Doubles hold whole numbers up to 2**53; for larger scores the index is made once more
    over Python's integers.
    """

    def __init__(self, part: Part, make: Callable[[np.ndarray], object]):
        self.part, self.make, self.index, self.double = part, make, None, True
        self.most = float(np.abs(part.codes).max(initial=0)) * max(1, part.codes.shape[1])

    def fit(self, queries: np.ndarray) -> tuple[object, np.ndarray]:
        """The index, and the queries in its kind of numbers."""
        if self.double and self.most * float(np.abs(queries).max(initial=0)) >= 2.0**53:
            self.double, self.index = False, None
        if self.index is None:
            self.index = self.make(self.part.codes if self.double else whole(self.part.codes))
        return self.index, queries if self.double else whole(queries)


def to_long(scores) -> list[int]:
    """Whole numbers as 64-bit ones; what no long can hold becomes the nearest long."""
    return [min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores]


def meet(
    rows: DataFrame,
    queries: DataFrame,
    index: Callable[[Part], object],
    answer: Callable[[object, Part], pa.RecordBatch | None],
    schema: str,
    scale: float,
    shard_components: int = SHARD_COMPONENTS,
) -> DataFrame:
    """What ``answer(index(shard), queries)`` gives for every shard and every batch of queries.

    ``rows`` is stored: ``id, v, label``; ``queries`` has ``q`` and ``extra`` (longs) as well.
    """
    spark = rows.sparkSession
    sizes = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    asked = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(sizes[1] or 0, asked[1] or 0)
    total = sizes[0] * max(1, width)
    idle = min(spark.sparkContext.defaultParallelism, -(-total // LEAST_COMPONENTS))
    shards = max(1, -(-total // shard_components), idle)
    runs = max(1, -(-asked[0] // RUN_QUERIES))

    def spread(n: int):
        return F.sequence(F.lit(0), F.lit(n - 1))

    def group(shard, run):
        return (shard.cast("long") * runs + run).alias("pair")

    own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    left = rows.withColumn("shard", own).withColumn("run", F.explode(spread(runs))).select(
        group(F.col("shard"), F.col("run")), F.lit(0).alias("kind"), "id", "v", "label",
        F.lit(None).cast("long").alias("q"), F.lit(None).cast("array<long>").alias("extra"),
    )
    run = F.pmod(F.xxhash64("q"), F.lit(runs))
    right = queries.withColumn("run", run).withColumn("shard", F.explode(spread(shards))).select(
        group(F.col("shard"), F.col("run")), F.lit(1).alias("kind"), "id", "v", "label", "q", "extra"
    )
    tasks = min(4 * shards * runs, MAX_TASKS)
    dealt = left.unionByName(right).repartition(tasks, "pair").sortWithinPartitions("pair", "kind")

    def part(batches: list[pa.RecordBatch]) -> Part:
        table = pa.Table.from_batches(batches).combine_chunks()
        vectors = table["v"].chunk(0) if table["v"].num_chunks else pa.array([], table.schema.field("v").type)
        return Part(
            table["id"].to_numpy(),
            matrix(vectors, width, scale),
            table["label"].to_pylist(),
            table["q"].to_numpy(),
            table["extra"].to_pylist() if table["q"].null_count == 0 else [],
        )

    def run_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, known = None, [], None
        for batch in batches:
            pair = batch.column(0).to_numpy()
            kind = batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(pair) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if pair[a] != at:
                    at, held, known = pair[a], [], None
                piece = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(piece)
                elif held or known is not None:
                    if known is None:
                        known, held = index(part(held)), []
                    found = answer(known, part([piece]))
                    if found is not None and found.num_rows:
                        yield found

    return dealt.mapInArrow(run_tasks, schema)
