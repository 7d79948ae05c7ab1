"""Numbering, folds, splits, samples."""

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from modsieve.keys import number_rows, seeded, uniform
from modsieve.operators import folds


@pytest.fixture(scope="module")
def rows(spark):
    # One stratum holds most rows, one is null, one has a single row.
    stratum = F.expr("CASE WHEN id < 700 THEN 'hot' WHEN id < 960 THEN 'b' WHEN id < 999 THEN NULL ELSE 'lone' END")
    return spark.range(1000).select(F.col("id").alias("row_id"), stratum.alias("rule"), (F.col("id") % 3 == 0).cast("int").alias("rule_violation"))


def test_number_rows_equals_plain_row_number(rows):
    key = seeded(5, "x", "row_id")
    plain = F.row_number().over(Window.partitionBy("rule").orderBy(key, "row_id")) - 1
    size = F.count(F.lit(1)).over(Window.partitionBy("rule"))
    numbered = number_rows(rows, ["rule"], key, ["row_id"], size="size").withColumn("p", F.lit(0))
    want = rows.select("row_id", plain.alias("want"), size.alias("want_size"))
    wrong = numbered.join(want, "row_id").filter((F.col("pos") != F.col("want")) | (F.col("size") != F.col("want_size")))
    assert numbered.count() == 1000 and wrong.count() == 0


def test_weighted_numbering_is_a_running_sum(rows):
    key = seeded(5, "w", "row_id")
    window = Window.partitionBy("rule").orderBy(key, "row_id").rowsBetween(Window.unboundedPreceding, -1)
    numbered = number_rows(rows, ["rule"], key, ["row_id"], weight=F.col("row_id") % 4)
    want = rows.select("row_id", F.coalesce(F.sum(F.col("row_id") % 4).over(window), F.lit(0)).alias("want"))
    assert numbered.join(want, "row_id").filter("pos <> want").count() == 0


@pytest.mark.parametrize("labels", [[], ["rule_violation"], ["rule", "rule_violation"]])
def test_folds_do_not_depend_on_partitioning(rows, partitions, labels):
    results = []
    for n in (1, 64):
        partitions(n)
        folded = folds.make_folds(rows.repartition(n), 7, 3, labels)
        results.append(sorted((r.row_id, r.fold) for r in folded.select("row_id", "fold").collect()))
    assert results[0] == results[1]


def test_every_row_in_one_fold_and_balanced(rows):
    folded = folds.multilabel_stratified_kfold(rows, ["rule", "rule_violation"], 10, 1).collect()
    assert len(folded) == 1000 and len({r.row_id for r in folded}) == 1000
    overall = Counter(r.fold for r in folded)
    assert max(overall.values()) - min(overall.values()) <= 1
    cells = Counter((r.rule, r.rule_violation, r.fold) for r in folded)
    for cell in {(r.rule, r.rule_violation) for r in folded}:
        sizes = [cells.get((*cell, k), 0) for k in range(10)]
        assert max(sizes) - min(sizes) <= 1


def test_few_rows_of_two_labels(spark):
    """A rare second label among rows that the first label splits evenly."""
    df = spark.range(12).select(F.col("id").alias("row_id"), (F.col("id") % 4).alias("shade"), (F.col("id") == 5).alias("rare"))
    folded = folds.multilabel_stratified_kfold(df, ["shade", "rare"], 5, 99).collect()
    assert sorted(Counter(r.fold for r in folded).values()) == [2, 2, 2, 3, 3]


def test_fold_type_follows_labels():
    assert folds.choose_fold_type(None) == "kfold"
    assert folds.choose_fold_type("rule") == "skfold"
    assert folds.choose_fold_type(["rule"], "mlskfold") == "skfold"
    assert folds.choose_fold_type(["rule", "label"]) == "mlskfold"
    with pytest.raises(ValueError):
        folds.choose_fold_type(None, "other")


def test_split_granularity_is_exact():
    assert folds.split_granularity([1, 0.3]) == 10
    assert folds.split_granularity([0.01, 0.3]) == 100
    assert folds.split_granularity([0.29, 0.57]) == 100  # 0.29 * 100 is not whole in floating point
    assert folds.split_granularity([0.125]) == 1000


def test_valid_folds_wrap_around():
    assert folds.split_folds(1, 0.3, 10) == (list(range(10)), [0, 1, 2])
    assert folds.split_folds(0.8, 0.2, 10) == (list(range(8)), [8, 9])


def test_overlap_is_reported(rows):
    folded = folds.kfold(rows, 10, 1)
    train, valid, overlap = folds.fraction_split(folded, 1, 0.3)
    assert train.count() == 1000 and valid.count() == 300 and overlap.first().overlap == 300
    _, _, none = folds.fraction_split(folded, 0.7, 0.3)
    assert none.first().overlap == 0


def test_fold_filter_outside_the_range(rows):
    folded = folds.kfold(rows, 5, 1)
    for k in (-1, 5):
        train, valid = folds.fold_filter(folded, k, 5)
        assert train.count() == 1000 and valid is None


def test_samples_and_holdout(rows):
    assert folds.sample_fraction(rows, 0.123, 1).count() == 123
    assert 200 < folds.sample_fraction(rows, 0.25, 1, exact=False).count() < 300
    held = folds.stratified_holdout(rows, ["rule"], 0.2, 1).filter("held_out").groupBy("rule").count().collect()
    assert {r["rule"]: r["count"] for r in held} == {"hot": 140, "b": 52, None: 8}


def test_lengths_are_dealt_in_order(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(20)], "row_id long, n int")
    dealt = folds.length_dealt_folds(df, F.col("n"), 5, 1)
    for row in dealt.groupBy("n").agg(F.collect_set("fold").alias("f")).collect():
        assert sorted(row.f) == [0, 1, 2, 3, 4]


def test_uniform_is_in_the_unit_interval(rows):
    u = uniform(seeded(1, "u", "row_id"))
    r = rows.agg(F.min(u), F.max(u), F.avg(u)).first()
    assert 0 <= r[0] and r[1] < 1 and abs(r[2] - 0.5) < 0.05


def test_the_shared_folder_comes_from_the_session():
    from types import SimpleNamespace

    from modsieve.session import shared_dir

    named = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: "/shared/work"))
    assert shared_dir(named) == "/shared/work"
    context = SimpleNamespace(master="yarn", applicationId="a", getCheckpointDir=lambda: None)
    unnamed = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    with pytest.raises(RuntimeError):
        shared_dir(unnamed)


@pytest.mark.parametrize("threshold", ["-1"])
def test_numbering_without_broadcasts(spark, rows, threshold):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = sorted(map(tuple, folds.multilabel_stratified_kfold(rows, ["rule"], 4, 1).select("row_id", "fold").collect()))
    for n in names:
        spark.conf.set(n, threshold)
    try:
        after = sorted(map(tuple, folds.multilabel_stratified_kfold(rows, ["rule"], 4, 1).select("row_id", "fold").collect()))
    finally:
        for n in names:
            spark.conf.unset(n)
    assert before == after
