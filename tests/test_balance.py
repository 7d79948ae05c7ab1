"""Folds balanced on every label: properties on awkward label tables."""

import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modsieve.operators import balance, folds


def check(rows, labels, n, slack=1):
    """Cells always within one; sizes and label values within ``slack``."""
    cells, values, sizes = Counter(), Counter(), Counter()
    for r in rows:
        tup = tuple(r[c] for c in labels)
        cells[tup, r["fold"]] += 1
        sizes[r["fold"]] += 1
        for c, v in zip(labels, tup):
            values[c, v, r["fold"]] += 1
    for counts, most in ((cells, 1), (values, slack)):
        for key in {k[:-1] for k in counts}:
            spread = [counts[(*key, f)] for f in range(n)]
            assert max(spread) - min(spread) <= most, (key, spread)
    spread = [sizes[f] for f in range(n)]
    assert max(spread) - min(spread) <= slack


def test_ten_labels_with_all_combinations(spark):
    """Dealing the sorted rows gives the last label to half of the folds; the search balances all."""
    labels = [f"y{i}" for i in range(10)]
    rows = [(i, *bits) for i, bits in enumerate(itertools.product([0, 1], repeat=10))]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} int" for c in labels))
    dealt = folds.dealt_kfold(df, labels, 10, 1).where("y9 = 1").groupBy("fold").count().count()
    assert dealt == 5
    folded = folds.multilabel_stratified_kfold(df, labels, 10, 1).collect()
    assert len(folded) == 1024
    check(folded, labels, 10)


@pytest.mark.parametrize("rows, n, kinds", [(1, 3, [2, 2]), (7, 10, [2, 3]), (500, 7, [2, 2, 2, 40]), (3000, 5, [3, 5, 2, 2, 2, 2])])
def test_random_labels(spark, rows, n, kinds):
    rng = np.random.default_rng(rows)
    names = [f"y{i}" for i in range(len(kinds))]
    data = [(i, *[None if rng.random() < 0.1 else str(int(k * rng.random() ** 2)) for k in kinds]) for i in range(rows)]
    df = spark.createDataFrame(data, "row_id long, " + ", ".join(f"{c} string" for c in names))
    folded = folds.multilabel_stratified_kfold(df, names, n, 5).collect()
    assert sorted(r.row_id for r in folded) == list(range(rows))
    check(folded, names, n)


def test_many_blocks_make_up_for_each_other(spark, monkeypatch):
    monkeypatch.setattr(balance, "BLOCK_CELLS", 128)
    labels = [f"y{i}" for i in range(10)]
    number = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("long")
    df = spark.range(5000).select(F.col("id").alias("row_id"), *[F.shiftright(number, i).bitwiseAND(1).alias(c) for i, c in enumerate(labels)])
    check(folds.multilabel_stratified_kfold(df, labels, 10, 1).collect(), labels, 10)


def test_folds_do_not_depend_on_partitioning(spark, partitions):
    df = spark.range(900).select(F.col("id").alias("row_id"), (F.col("id") % 7).alias("a"), (F.col("id") * 31 % 11).alias("b"), F.lit(None).cast("int").alias("c"))
    found = []
    for n in (1, 16):
        partitions(n)
        folded = folds.multilabel_stratified_kfold(df.repartition(n), ["a", "b", "c"], 6, 3)
        found.append(sorted((r.row_id, r.fold) for r in folded.collect()))
    assert found[0] == found[1]


def test_no_rows(spark):
    df = spark.createDataFrame([], "row_id long, a int, b int")
    assert folds.multilabel_stratified_kfold(df, ["a", "b"], 5, 1).collect() == []
    assert folds.label_balance(folds.multilabel_stratified_kfold(df, ["a", "b"], 5, 1), ["a", "b"], 5).collect() == []


def test_label_balance_counts(spark):
    df = spark.createDataFrame([(1, "x", 0), (2, "x", 1), (3, None, 1)], "row_id long, a string, fold int")
    got = {(r.label, r.value): (r.n_rows, r.counts) for r in folds.label_balance(df, ["a"], 2).collect()}
    assert got == {("a", "x"): (2, [1, 1]), ("a", None): (1, [0, 1]), ("*", ""): (3, [1, 2])}


def test_repair_ends_with_even_counts():
    rng = np.random.default_rng(2)
    codes = np.hstack([rng.integers(0, 2, (400, 6)) + 2 * np.arange(6), np.full((400, 1), 12)])
    rest = rng.integers(1, 8, 400)
    offset = np.zeros((13, 8))
    offset[3] = [9, -9, 3, -3, 0, 0, 0, 0]
    offset[2] = -offset[3]
    took, off = balance.solve(codes, rest, 8, offset, 1)
    assert (took.sum(axis=1) == rest).all()
    assert (off.max(axis=1) - off.min(axis=1) < 1.5).all()
