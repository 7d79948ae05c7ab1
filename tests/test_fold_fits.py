"""All folds fitted in one pass against the separate fits and against a plain gradient."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modsieve.operators import fold_fits, model
from modsieve.operators.folds import fold_filter, stratified_kfold


@pytest.fixture(scope="module")
def folded(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        label = None if i % 40 == 7 else int(rng.random() < 0.3)
        words = rng.choices(["spam", "buy", "now", "win"] if label and rng.random() < 0.7 else ["kind", "nice", "talk", "win"], k=rng.randrange(1, 9))
        rows.append((i, "rule", " ".join(words + rng.choices(["x1", "x2", "x3", "y4"], k=3)), f"s{i % 3}", label))
    df = spark.createDataFrame(rows, "row_id long, rule string, body string, subreddit string, rule_violation int")
    return stratified_kfold(df, "rule_violation", 4, 1).cache()


def separate(folded, n, params):
    out = {}
    for k in range(n):
        train, valid = fold_filter(folded, k, n)
        scored = model.score(model.train_text_classifier(train, params), valid)
        out.update({r.row_id: r.prediction for r in scored.collect()})
    return out


@pytest.mark.parametrize("reg, steps, close", [(0.05, 100, 2e-3), (0.01, 20, 0.03)])
def test_same_predictions_as_separate_fits(folded, reg, steps, close):
    params = model.TrainParams(buckets=1 << 10, reg=reg, max_iter=steps)
    got = model.out_of_fold(folded, 4, params)
    assert got.columns == [*folded.columns, "prediction"]
    found, want = {r.row_id: r.prediction for r in got.collect()}, separate(folded, 4, params)
    assert found.keys() == want.keys() and len(found) == 400
    assert max(abs(found[i] - want[i]) for i in want) < close


def sparse(spark, rows):
    return spark.createDataFrame(rows, "places array<int>, counts array<double>, label double, fold int")


def test_gradient_and_scans(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (60, 12)) * (rng.random((60, 12)) < 0.4)
    y, fold = (rng.random(60) < 0.4).astype(float), rng.integers(0, 5, 60)
    rows = sparse(spark, [(np.flatnonzero(r).tolist(), r[r > 0].astype(float).tolist(), float(t), int(f)) for r, t, f in zip(x, y, fold)])
    weights, constant = rng.normal(size=(3, 12)), rng.normal(size=3)
    loss, by_intercept, by_place = fold_fits.evaluate(rows.repartition(4), 3, weights, constant)
    for k in range(3):
        use = fold != k
        margin = x[use] @ weights[k] + constant[k]
        off = 1 / (1 + np.exp(-margin)) - y[use]
        assert by_place[k] == pytest.approx(off @ x[use]) and by_intercept[k] == pytest.approx(off.sum())
        assert loss[k] == pytest.approx(np.log1p(np.exp(margin)).sum() - y[use] @ margin)
    few, many = (fold_fits.fit_folds(rows, n, 12, reg=0.1, steps=15) for n in (2, 5))
    assert max(few.scans, many.scans) <= 15 * 2  # a scan serves all models
    assert many.coefficients.shape == (5, 12)


def test_one_label_and_no_rows(spark):
    rows = [([0], [1.0], 1.0, 0), ([1], [2.0], 0.0, 1), ([1], [1.0], 0.0, 1), ([], [], 0.0, 1)]
    found = fold_fits.fit_folds(sparse(spark, rows), 2, 4, reg=0.1, steps=5)
    assert found.intercepts.tolist() == [-np.inf, np.inf] and not found.coefficients.any()
    with pytest.raises(ValueError, match="folds \\[1\\]"):
        fold_fits.fit_folds(sparse(spark, rows).where("fold = 1"), 2, 4, reg=0.1, steps=5)


def test_rows_without_a_fold_are_not_scored(folded):
    odd = folded.withColumn("fold", F.when(F.col("row_id") < 20, F.lit(None).cast("int")).when(F.col("row_id") < 30, 9).otherwise(F.col("fold")))
    got = model.out_of_fold(odd, 4, model.TrainParams(buckets=1 << 8, max_iter=5)).select("row_id").collect()
    assert sorted(r.row_id for r in got) == list(range(30, 400))
