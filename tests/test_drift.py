"""Sparse features, projection and profiles against plain numpy."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modsieve.operators import drift


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    out = [" ".join(rng.choices(words[i % 3 * 5 :], weights[i % 3 * 5 :], k=rng.randrange(1, 40))) for i in range(150)]
    return [*out, None, "", "x", "only unseen terms here", out[0], out[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "d long, t string").repartition(3).cache()


def plain(texts, dimension):
    """Vocabulary and dense TF-IDF rows."""
    bags = []
    for t in texts:
        w = re.findall(r"\w{2,}", (t or "").lower())
        bags.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    total, df = Counter(), Counter()
    for b in bags:
        total.update(b)
        df.update(b.keys())
    known = sorted(sorted(total, key=lambda t: (-total[t], t))[:dimension])
    table = np.array([[b[t] * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t in known] for b in bags])
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return bags, known, table / np.where(norm > 0, norm, 1)


def test_counts_in_the_row(docs, texts):
    counted = drift.term_counts(docs, "t", ["d"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("regexp_extract_all") == 1
    got = {}
    for r in counted.collect():
        assert got.setdefault(r.d, {}).setdefault(r.term, r.tf) == r.tf
    bags, _, _ = plain(texts, 10)
    assert got == {i: dict(b) for i, b in enumerate(bags) if b}


@pytest.mark.parametrize("dimension", [30, 5000])
def test_features_are_sparse_and_equal_to_plain_weights(docs, texts, dimension):
    _, known, table = plain(texts, dimension)
    rows = drift.feature_table(docs, "t", ["d"], dimension).collect()
    assert {type(r.features).__name__ for r in rows} == {"SparseVector"}
    got = np.zeros(table.shape)
    for r in rows:
        got[r.d] = r.features.toArray()
    assert got == pytest.approx(table, abs=1e-12)
    weights = {(r.d, r.term): r.weight for r in drift.tfidf(docs, "t", ["d"], dimension).collect()}
    assert weights == pytest.approx({(i, known[j]): table[i, j] for i, j in zip(*np.nonzero(table))})


def test_vocabulary_from_a_sketch(docs):
    assert drift.term_model(docs, "t", 25, sketch=True) == drift.term_model(docs, "t", 25)


def test_projection_equals_singular_vectors(docs, texts):
    _, _, table = plain(texts, 60)
    features = drift.feature_table(docs, "t", ["d"], 60)
    train = F.col("d") % 3 != 0
    placed = sorted(map(tuple, drift.project_2d(features, train).collect()))
    use = np.arange(len(texts)) % 3 != 0
    centre = table[use].mean(axis=0)
    axes = np.linalg.svd(table[use] - centre, full_matrices=False)[2][:2].T
    want = (table - centre) @ axes
    got = np.array([p[1:] for p in placed])
    assert [p[0] for p in placed] == list(range(len(texts)))
    for i in range(2):
        sign = np.sign(got[:, i] @ want[:, i])
        assert got[:, i] == pytest.approx(sign * want[:, i], abs=1e-7)
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "vector_to_array" not in plan


def test_projection_without_spread(spark):
    same = spark.createDataFrame([(1, "aa bb"), (2, "aa bb"), (3, None)], "d long, t string")
    placed = drift.project_2d(drift.feature_table(same, "t", ["d"], 5), F.col("d") < 3).collect()
    assert [(abs(r.x) < 1e-9, abs(r.y) < 1e-9) for r in placed] == [(True, True)] * 3
    none = drift.project_2d(drift.feature_table(same.limit(0), "t", ["d"], 5), F.lit(True))
    assert none.columns == ["d", "x", "y"] and none.collect() == []
    wordless = drift.feature_table(same.where("d = 3"), "t", ["d"], 5)
    assert [(r.x, r.y) for r in drift.project_2d(wordless, F.lit(True)).collect()] == [(0.0, 0.0)]


def test_profile_compares_without_the_reference(spark, docs, texts, tmp_path):
    ref, cur = docs.where("d % 2 = 0"), docs.where("d % 2 = 1")
    made = drift.reference_profile(ref, "t", 50, 20)
    profile = drift.read_profile(spark, drift.write_profile(spark, made, str(tmp_path / "p")))
    assert profile == made and profile.rows == ref.count()
    summary, bars = drift.compare_to_profile(profile, cur, "t")
    row = summary.first()
    # The same figures from plain rows, over the vocabulary of the reference.
    bags, known, table = plain(texts[0::2], 50)
    n = len(texts[0::2])
    df = Counter(t for b in bags for t in b)
    other = np.array([[b[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in known] for b in plain(texts[1::2], 1)[0]])
    norm = np.linalg.norm(other, axis=1, keepdims=True)
    a, b = table.mean(axis=0), (other / np.where(norm > 0, norm, 1)).mean(axis=0)
    cosine = a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    assert row.cosine_mean_similarity == pytest.approx(cosine, abs=1e-4)
    assert row.euclidean_mean_distance == pytest.approx(math.sqrt(2 - 2 * cosine), abs=1e-4)
    assert 0.2 < row.common_x <= 1 and row.rows == len(texts[1::2])
    sums = bars.groupBy("dimension").agg(F.sum("reference_share").alias("a"), F.sum("share").alias("b")).collect()
    assert all(r.a == pytest.approx(1) and r.b == pytest.approx(1) for r in sums)
    same = drift.compare_to_profile(profile, ref, "t")[0].first()
    assert (same.cosine_mean_similarity, same.common_x, same.common_y) == (1.0, 1.0, 1.0)
    empty = drift.compare_to_profile(profile, cur.limit(0), "t")[0].first()
    assert (empty.rows, empty.cosine_mean_similarity, empty.common_x) == (0, None, 0.0)


def test_drift_returns_the_projection_tables(docs):
    found = drift.detect_drift(docs, "t", ["d"], n_splits=3, dimension=30, trees=3)
    assert found.summary.count() == 1
    assert found.projected.columns == ["doc", "fold", "side", "held_out", "x", "y"] and found.projected.count() == docs.count()
    mass = found.histogram.groupBy("dimension", "side").agg(F.sum(F.col("density") * F.col("width")).alias("m")).collect()
    assert len(mass) == 4 and all(r.m == pytest.approx(1) for r in mass)
