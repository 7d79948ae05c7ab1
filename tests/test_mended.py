"""Cases that once lost rows, text or reports."""

import json
import os

import pytest
from pyspark.sql import functions as F

from modsieve.operators import augment as A
from modsieve.operators import clean, drift, metrics, profile
from modsieve.operators import validate as V
from modsieve.operators.reshape import encode_labels, zero_shot
from modsieve.plans.prepare import NamedTable, SplitConfig, prepare_splits
from modsieve.plans.run import validate_stage
from modsieve.sources import tables
from modsieve.spec import SYNTHETIC, TableSpec

RULED = TableSpec(
    columns={"row_id": "int64", "body": "str", "rule": "str", "rule_violation": "int32"},
    features=("rule", "body"),
    target="rule_violation",
    categorical=("rule", "rule_violation"),
)


def test_all_classes_are_listed(spark):
    df = spark.createDataFrame([(f"r{i % 23}", i % 2) for i in range(69)], "rule string, rule_violation int")
    rows = profile.class_distribution(df, ["rule", "rule_violation"]).collect()
    assert {r["class"]: (r.n_rows, r.n_classes) for r in rows if r["column"] == "rule"} == {f"r{i}": (3, 23) for i in range(23)}
    assert profile.target_distribution(df, ["rule"]).count() == 46


def test_washing_deletes_no_letter(spark):
    text = "don’t – Straße “x” œuvre Łódź Æsir 東京 हिन्दी éte ﬁn ½ naïve"
    df = spark.createDataFrame([(1, text)], "row_id long, body string")
    assert clean.wash_text(df).first().body == "don't - Strasse \"x\" oeuvre Lodz AEsir 東京 हिन्दी ete fin ½ naive"
    left = clean.wash_text(df)
    assert [tuple(r) for r in clean.not_ascii(left, ["body"]).collect()] == [("body", 1)]


def test_gate_returns_every_dataset(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", "y"), (4, "b", "y"), (5, "c", None)]
    df = spark.createDataFrame(rows, "row_id long, dataset string, body string")
    report = spark.createDataFrame([("a", 1), ("b", 0)], "dataset string, n_duplicates long")
    got = clean.redundancy_gate(df, report, ["body"], ["row_id"])
    assert sorted(r.row_id for r in got.collect()) == [1, 3, 4, 5]


def test_examples_need_a_key_but_any_will_do(spark):
    columns = "part_no int, row_id int, body string, rule string, rule_violation int, positive_example_1 string, positive_example_2 string, negative_example_1 string, negative_example_2 string"
    df = spark.createDataFrame([(1, 7, "b", "r", 1, "p", "q", "m", "n")], columns)
    spec = TableSpec(
        columns={c.split()[0]: "str" for c in columns.split(", ")}, features=("rule", "body"), target="rule_violation", key=("part_no", "row_id")
    )
    rows = prepare_splits([NamedTable("t", df, spec)], SplitConfig(train_splits=(1, 0))).rows
    assert sorted(r.body for r in rows.collect()) == ["b", "m", "n", "p", "q"]
    with pytest.raises(ValueError):
        zero_shot(df.drop("part_no", "row_id"), spec, key=("part_no", "row_id"))


def test_csv_goes_by_name(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write("rule,body,extra,rule_violation\nr1,b1,e,1\nr2,b2,e,oops\nr3,b3,e,\n")
    df = tables.read_sources(spark, {"x": path}, {"x": SYNTHETIC})["x"]
    assert {(r.rule, r.body, r.rule_violation) for r in df.collect()} == {("r1", "b1", "1"), ("r2", "b2", "oops"), ("r3", "b3", None)}
    assert V.absent_columns(df, SYNTHETIC) == ["subreddit"]
    assert [(r["column"], r.n_uncastable) for r in V.dtype_mismatch(df, SYNTHETIC).collect()] == [("rule_violation", 1)]
    fits = tables.read_csv(spark, path, TableSpec(columns={"body": "str", "rule": "str"}, features=("body",)), multi_line=False)
    assert fits.columns == ["rule", "body"]


def test_copies_without_a_key(spark):
    rows = [("r", "b", "s", 1)] * 3 + [("r", None, "s", 0), ("r", "c", "s", 0)]
    df = spark.createDataFrame(rows, "rule string, body string, subreddit string, rule_violation int")
    result = V.validate(df, SYNTHETIC)
    assert sorted(r.body for r in result.valid.collect()) == ["b", "c"]
    assert sorted((r.body or "", r.reject_reason) for r in result.rejected.collect()) == [("", "missing"), ("b", "duplicate"), ("b", "duplicate")]
    found = {r.metric: r.value for r in result.report.filter("check = 'data_redundancy'").collect()}
    report = V.duplicate_report(df, SYNTHETIC).first()
    assert (found["n_duplicates"], found["purity"]) == (report.n_duplicates, report.purity) == (2, 60)


def test_fatal_layout_is_reported(spark, tmp_path):
    good = spark.createDataFrame([(1, "b", "r", 1), (2, "c", "r", 0)], "row_id long, body string, rule string, rule_violation int")
    given = [
        NamedTable("good", good, RULED),
        NamedTable("bad", good.drop("rule"), RULED),
        NamedTable("test", good.drop("rule_violation"), RULED, "test"),
        NamedTable("answers", good.select("row_id"), RULED, "submission"),
    ]
    with pytest.raises(V.LayoutError):
        validate_stage(spark, given, str(tmp_path))

    def lines(folder):
        path = tmp_path / folder
        return [json.loads(x) for f in os.listdir(path) if f.endswith(".json") for x in open(path / f)]

    assert {(x["check"], x.get("value")) for x in lines("report/bad")} == {("missing_columns", None), ("status", 0.0)}
    assert ("status", 1.0) in {(x["check"], x.get("value")) for x in lines("report/good")}
    assert lines("submission/answers_test")[0]["accepted"] is True
    assert any(x["metric"] == "n_classes" for x in lines("statistics/good"))
    result = V.validate(good.drop("rule"), RULED, strict=False)
    assert result.valid.count() == 0 and result.rejected.count() == 2 and not result.ok


def test_one_pronunciation_per_word(spark):
    df = spark.createDataFrame([(i, "tomato tomato tomato") for i in range(5)], "row_id long, body string")
    lexicon = spark.createDataFrame([("tomato", "B 1", 1), ("tomato", "A 2", 2)], "word string, phones string, place int")
    assert {r.body for r in A.phonetic_swap(df, "body", lexicon, 1, ["row_id"]).collect()} == {"b b b"}
    assert {r.body for r in A.phonetic_swap(df, "body", lexicon.drop("place"), 1, ["row_id"]).collect()} == {"a a a"}


def test_urls_after_cleaning(spark):
    rows = [(i, f"see https://x{i}.org/page/a{i} now", "r") for i in range(8)]
    df = spark.createDataFrame(rows, "row_id long, body string, rule string")
    out = A.augment(df, [("url_cleaner", 1.0), ("random_url", 1.0)], A.Context(3), include_original=False)
    assert all("https://x" in r.body for r in out.collect()) and out.count() == 8


def test_no_spread_no_failure(spark):
    same = spark.createDataFrame([("a b",), ("c d",), (None,)], "text string")
    assert {(r.x, r.density) for r in profile.length_density(same, "text", points=3).collect()} == {(2.0, None)}
    assert profile.length_density(same.limit(0), "text", points=3).count() == 0
    weights = spark.createDataFrame([(1, "a", 1.0)], "doc int, term string, weight double")
    assert tuple(drift.mean_vector_drift(weights, F.col("doc") == 2).first()) == (None, None)
    points = spark.createDataFrame([(True, 1.0, 2.0), (False, 1.0, 3.0)], "s boolean, x double, y double")
    bars = drift.projection_histogram(points, F.col("s")).collect()
    assert {(b.dimension, b.bin, b.density is None) for b in bars} == {("x", 0, True), ("y", 0, False), ("y", 49, False)}
    scored = spark.createDataFrame([(1, 0.5, 1.0), (1, 0.7, -1.0), (2, 0.5, 2.0)], "row_id int, prediction double, w double")
    assert {tuple(r) for r in metrics.ensemble_mean(scored, weight="w").collect()} == {(1, None), (2, 0.5)}


def test_codes_of_many_labels(spark, partitions):
    partitions(5)
    df = spark.createDataFrame([(f"c{i:04d}",) for i in range(700)] * 2 + [(None,)], "label string")
    got = {r.label: r.label_le for r in encode_labels(df, ["label"]).collect()}
    assert got == {None: None, **{f"c{i:04d}": i for i in range(700)}}

