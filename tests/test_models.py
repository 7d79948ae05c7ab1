"""Triplets, metrics, drift, classifier, streams, the whole run."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modsieve.operators import drift, metrics, model, triplet
from modsieve.plans.prepare import NamedTable, SplitConfig, prepare_splits
from modsieve.operators.drift import read_profile
from modsieve.plans.run import DriftConfig, PseudoConfig, RunConfig, TripletConfig, run
from modsieve.spec import TableSpec
from modsieve.streaming.track import append_stream, stream_score_and_track, violation_rate

SPEC = TableSpec(
    columns={"row_id": "int64", "rule": "str", "body": "str", "subreddit": "str", "rule_violation": "int64"},
    features=("rule", "body"),
    target="rule_violation",
)


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        rule, label = ("a" if i < 160 else "b"), int(i % 4 == 0)
        word = "spam buy now" if label else "kind nice talk"
        rows.append((i, rule, f"{word} {rng.choice(['x', 'y', 'z'])} number {i}", f"s{i % 5}", label))
    rows += [(1000, "lone", "only one", "s0", 0)]
    return spark.createDataFrame(rows, "row_id long, rule string, body string, subreddit string, rule_violation int")


@pytest.mark.parametrize("prefer", [[], ["subreddit"]])
@pytest.mark.parametrize("turned", [False, True])
def test_triplets_are_dealt_evenly(reviews, prefer, turned):
    long = triplet.triplets_long(reviews, n_samples=3, n_negatives=4, reversed=turned, prefer=prefer).collect()
    label = {r.row_id: r for r in reviews.collect()}
    body = {r.body: r for r in label.values()}
    anchors = [r for r in label.values() if r.rule != "lone" and r.rule_violation == int(turned)]
    assert len(long) == len(anchors) * 12
    assert all(body[t.negative].rule_violation == 1 - int(turned) and body[t.negative].rule == t.anchor for t in long)
    used = Counter((t.anchor, t.negative) for t in long)
    for rule in ("a", "b"):
        counts = [n for (r, _), n in used.items() if r == rule]
        assert max(counts) - min(counts) <= (2 if prefer else 1)
    if prefer:
        near = [t for t in long if body[t.negative].subreddit == label[t.row_id].subreddit]
        assert len(near) >= len({(t.anchor, t.negative) for t in near})


def test_wide_triplets_and_rejects(reviews):
    wide = triplet.triplets(reviews, n_samples=1, n_negatives=2)
    assert wide.columns == ["anchor", "positive", "negative_0", "negative_1"] and wide.count() == 180
    assert triplet.triplets(reviews, n_samples=1, n_negatives=1).columns == ["anchor", "positive", "negative"]
    assert [r.row_id for r in triplet.without_opposite(reviews).collect()] == [1000]


def test_one_card_serves_many_anchors(spark):
    many = spark.range(3000).select(
        F.col("id").alias("row_id"), F.lit("r").alias("rule"), F.col("id").cast("string").alias("body"), (F.col("id") == 0).cast("int").alias("rule_violation")
    )
    long = triplet.triplets_long(many, n_samples=1, n_negatives=2)
    assert long.count() == 2 * 2999 and long.select("negative").distinct().count() == 1


def test_triplets_do_not_depend_on_partitioning(reviews, partitions):
    got = []
    for n in (1, 64):
        partitions(n)
        got.append(sorted(map(tuple, triplet.deal(reviews.repartition(n)).collect())))
    assert got[0] == got[1]


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_brute_force(spark):
    rng = random.Random(1)
    rows = [("t" if i % 2 else None, round(rng.random(), 1 + 5 * (i % 2)), int(rng.random() < 0.3)) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    for group, auc in ((r.g, r.auc) for r in metrics.roc_auc(df, "s", "y", ["g"]).collect()):
        assert auc == pytest.approx(brute_auc([(s, y) for g, s, y in rows if g == group]))
    whole = metrics.roc_auc(df, "s", "y").first()
    turned = metrics.roc_auc(df.withColumn("s", -F.col("s")), "s", "y").first()
    assert whole.auc == pytest.approx(brute_auc([(s, y) for _, s, y in rows])) and whole.auc + turned.auc == pytest.approx(1)


def test_one_class_groups_are_left_out_and_counted(spark):
    df = spark.createDataFrame([("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.5, 1)], "g string, s double, y int")
    row = metrics.column_averaged_auc(df, "s", "y", ["g"]).first()
    assert (row.auc, row.n_groups, row.n_one_class) == (1.0, 1, 1)


def test_running_sums_over_many_values(spark):
    df = spark.range(5000).select((F.col("id") * F.lit(0.1)).alias("v"), (F.col("id") % 7).alias("n"))
    got = [(r.v, r.n, r.n_before) for r in metrics.running_before(df, "v", ["n"]).orderBy("v").collect()]
    assert len(got) == 5000
    before = 0
    for _, n, b in got:
        assert b == before
        before += n


def test_softmax_ensemble_sharpen(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [-1.0, 1.0])], "row_id long, l array<double>")
    probs = {r.row_id: r.p for r in df.select("row_id", metrics.positive_probability(F.col("l")).alias("p")).collect()}
    assert probs[1] == 0.5 and probs[2] == pytest.approx(np.exp(1) / (np.exp(1) + np.exp(-1)))
    preds = spark.createDataFrame([(1, 0.2, 1.0), (1, 0.8, 3.0), (2, 0.4, 1.0)], "row_id long, prediction double, weight double")
    assert {r.row_id: round(r.prediction, 6) for r in metrics.ensemble_mean(preds, weight="weight").collect()} == {1: 0.65, 2: 0.4}
    assert [round(r.prediction, 6) for r in metrics.sharpen(preds, "prediction").select("prediction").collect()] == [round(0.8**0.5, 6)]


def test_terms(spark):
    df = spark.createDataFrame([(1, "The a the_Cat sat. É2"), (2, "x"), (3, None)], "d long, t string")
    got = sorted(r.term for r in drift.terms(df, "t", ["d"]).collect())
    assert got == sorted(["the", "the_cat", "sat", "é2", "the the_cat", "the_cat sat", "sat é2"])


def test_drift_of_a_shuffled_half_is_small(spark, reviews):
    half = F.col("row_id") % 2 == 0
    same = drift.detect_drift(reviews.filter(half), "body", ["row_id"], reviews.filter(~half & (F.col("rule_violation") == 0)), dimension=40, trees=5).summary.first()
    other = drift.detect_drift(
        reviews.filter(F.col("rule_violation") == 0), "body", ["row_id"], reviews.filter(F.col("rule_violation") == 1), dimension=40, trees=5
    ).summary.first()
    assert other.cosine_mean_similarity < same.cosine_mean_similarity
    assert other.accuracy > 0.95 and other.auc_score > 0.95
    assert other.euclidean_mean_distance == pytest.approx((2 - 2 * other.cosine_mean_similarity) ** 0.5, abs=1e-3)


QUICK = model.TrainParams(buckets=1 << 10, max_iter=5)


@pytest.fixture(scope="module")
def fitted(reviews):
    return model.train_text_classifier(reviews, QUICK)


def test_scores_keep_the_columns(reviews, fitted):
    scored = model.score(fitted, reviews)
    assert scored.columns == [*reviews.columns, "prediction"]
    assert metrics.roc_auc(scored, "prediction", "rule_violation").first().auc > 0.99
    many = model.score_many({"m1": fitted, "m2": fitted}, reviews)
    assert many.count() == 2 * reviews.count()


def test_external_models_keep_the_contract(reviews):
    scored = model.score_external(lambda prompts: prompts.str.contains("spam").astype(float), reviews)
    assert scored.columns == [*reviews.columns, "prediction"]
    assert metrics.accuracy(scored, "prediction", "rule_violation").first().accuracy == 1.0


def test_out_of_fold_scores_every_row_once(reviews):
    folded = reviews.withColumn("fold", (F.col("row_id") % 3).cast("int"))
    stacked = model.out_of_fold(folded, 3, QUICK)
    assert stacked.count() == reviews.count() == stacked.select("row_id").distinct().count()


def test_stream_equals_batch(spark, reviews, fitted, tmp_path):
    source = str(tmp_path / "in")
    reviews.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(reviews.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    stream_score_and_track(stream, fitted, out, str(tmp_path / "state")).awaitTermination()
    tracked = {r.id: r.violation for r in spark.read.parquet(out).collect()}
    batch = {r.row_id: r.prediction for r in model.score(fitted, reviews).collect()}
    assert tracked == batch


def test_late_rows_are_dropped_and_closed_windows_equal_batch(spark, tmp_path):
    schema = "body string, violation double, timestamp timestamp"
    first = [("a", 0.9, f"2024-01-01 {h:02d}:30:00") for h in range(6)]
    late = [("late", 0.9, "2024-01-01 00:10:00"), ("c", 0.1, "2024-01-01 09:30:00")]
    source = str(tmp_path / "in")
    for rows in (first, late):
        part = spark.createDataFrame(rows, "body string, violation double, t string")
        part.select("body", "violation", F.to_timestamp("t").alias("timestamp")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        append_stream(violation_rate(stream), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {r.window_start.hour: r.n_rows for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {h: 1 for h in range(6)}


def test_parts_overlap_as_asked(reviews):
    splits = prepare_splits([NamedTable("t", reviews, SPEC), NamedTable("u", reviews.withColumn("rule_violation", F.when(F.col("row_id") % 2 == 0, F.col("rule_violation"))), SPEC, "test")], SplitConfig())
    counts = {r["part"]: r["count"] for r in splits.rows.groupBy("part").count().collect()}
    assert counts.pop("valid") in (72, 73, 74) and counts == {"train": 241 + 121, "test": 120}


def test_whole_run(spark, reviews, tmp_path):
    tables = [NamedTable("t", reviews, SPEC), NamedTable("u", reviews.filter("row_id < 50").withColumn("rule_violation", F.lit(None).cast("int")), SPEC, "test")]
    result = run(spark, tables, RunConfig(str(tmp_path), {"m": QUICK}, SplitConfig(materialise=True)))
    assert result.predictions.count() == 50
    row = result.metrics.first()
    assert row.roc_auc > 0.9 and row.accuracy > 0.9


def test_run_with_drift_pseudo_labels_triplets_and_an_ensemble(spark, reviews, tmp_path):
    tables = [NamedTable("t", reviews.filter("row_id % 3 > 0"), SPEC), NamedTable("u", reviews.filter("row_id % 3 = 0").withColumn("rule_violation", F.lit(None).cast("int")), SPEC, "test")]
    models = {"first": QUICK, "teacher": model.TrainParams(buckets=1 << 9, max_iter=20, reg=0.001)}
    config = RunConfig(
        str(tmp_path), models, SplitConfig(materialise=True), drift=DriftConfig(n_splits=3, dimension=20, trees=3),
        pseudo=PseudoConfig("teacher", 0.3), triplets=TripletConfig(1, 2), weights={"teacher": 3.0, "first": 1.0},
    )
    result = run(spark, tables, config)
    n_test = reviews.filter("row_id % 3 = 0").count()
    by_model = {(r.row_id, r.model): r.prediction for r in result.predictions.collect()}
    assert len(by_model) == 2 * n_test
    mixed = {r.row_id: r.prediction for r in result.ensemble.collect()}
    assert len(mixed) == n_test
    for i, p in mixed.items():
        assert p == pytest.approx((3 * by_model[i, "teacher"] + by_model[i, "first"]) / 4)
    # The pseudo-labelled rows are those that the teacher is sure about.
    pseudo = {r.row_id: r.rule_violation for r in spark.read.parquet(f"{tmp_path}/pseudo_train").collect()}
    sure = {i: int(p > 0.7) for (i, m), p in by_model.items() if m == "teacher" and (p > 0.7 or p < 0.3)}
    assert pseudo == sure and len(sure) > 20
    assert {r.model for r in result.metrics.collect()} == {"first", "teacher"}
    assert result.triplets.columns == ["anchor", "positive", "negative_0", "negative_1"] and result.triplets.count() > 50
    # Text columns that are no categories: rule, body, subreddit of this layout.
    summary = spark.read.parquet(f"{tmp_path}/drift/t/body/summary").first()
    assert 0.5 < summary.cosine_mean_similarity <= 1
    assert spark.read.parquet(f"{tmp_path}/drift/u/body/against_t/histogram").filter("density > 0").count() > 4
    assert spark.read.parquet(f"{tmp_path}/drift/u/body/against_t/projected").count() == reviews.count()
    assert read_profile(spark, f"{tmp_path}/drift/t/body/profile").rows == reviews.filter("row_id % 3 > 0").count()
