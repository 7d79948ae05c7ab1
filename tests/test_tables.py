"""Validation, cleaning, reshaping, sources."""

import statistics

import pytest
from pyspark.sql import functions as F

from modsieve.operators import clean, profile, reshape, validate as V
from modsieve.sources import tables
from modsieve.spec import REVIEWS, TableSpec

SPEC = TableSpec(
    columns={"row_id": "int64", "rule": "str", "body": "str", "rule_violation": "int64"},
    features=("rule", "body"),
    target="rule_violation",
)
SCHEMA = "row_id long, rule string, body string, rule_violation int"


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(
        [
            (5, "a", "x", 0), (1, "a", "x", 1), (2, "a", None, 0), (3, "a", None, 0), (4, None, "x", 1), (6, "b", "x", 1),
        ],
        SCHEMA,
    )


def test_valid_and_rejected_make_the_input(dirty):
    result = V.validate(dirty, SPEC)
    assert sorted(r.row_id for r in result.valid.collect()) == [1, 6]
    assert {r.row_id: r.reject_reason for r in result.rejected.collect()} == {5: "duplicate", 3: "duplicate", 2: "missing", 4: "missing"}
    lines = {(r.check, r.metric): r.value for r in result.report.collect()}
    assert lines["data_redundancy", "purity"] == 66.6667 and lines["missing_rows", "purity"] == 50.0
    assert result.ok


def test_a_hot_group_keeps_its_first_row(spark):
    copies = spark.range(5000).select(F.col("id").alias("row_id"), F.lit("a").alias("rule"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("body"), F.lit(0).alias("rule_violation"))
    kept = clean.dedupe(copies, ["rule", "body"], ["row_id"])
    assert kept.count() == 5000 - 1666 and kept.filter("body = 'hot'").first().row_id == 0
    assert clean.dedupe(kept, ["rule", "body"], ["row_id"]).count() == kept.count()


def test_layout_errors_are_fatal(dirty):
    with pytest.raises(V.LayoutError):
        V.validate(dirty.drop("body"), SPEC)
    with pytest.raises(V.LayoutError):
        V.validate(dirty.withColumn("body", F.lit(1)), SPEC)
    lenient = V.validate(dirty.drop("body"), SPEC, strict=False)
    assert not lenient.ok and lenient.report.first().column == "body"


def test_target_is_not_required_of_test_files_and_spec_stays(dirty):
    unlabelled = dirty.drop("rule_violation")
    assert V.absent_columns(unlabelled, SPEC, train=False) == []
    assert V.absent_columns(unlabelled, SPEC) == ["rule_violation"]
    assert "rule_violation" in SPEC.columns


def test_nullable_integers_pass(spark):
    df = spark.createDataFrame([(1, "a", "b", None)], SCHEMA)
    assert V.type_conflicts(df, SPEC) == []


def test_empty_table_is_pure(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.duplicate_report(empty, SPEC).first().purity == 100
    assert V.missing_rows_report(empty, SPEC).first().purity == 100


def test_submission_must_align(spark):
    a, b = spark.range(5).withColumnRenamed("id", "row_id"), spark.range(1, 6).withColumnRenamed("id", "row_id")
    row = V.submission_aligned(a, b).first()
    assert (row.accepted, row.not_submitted, row.not_in_test) == (True, 1, 1)


def test_wash(spark):
    text = "Café – see https://x.org/a?b=1 or www.foo.com, mail joe@mail.example.org, call 555-123-4567 🙂 ok 12!"
    df = spark.createDataFrame([(1, text), (2, None)], "row_id long, body string")
    washed = {r.row_id: r.body for r in clean.wash_text(df).collect()}
    assert washed == {1: "Cafe - see <URL> or <URL> mail <EMAIL>, call <PHONE>  ok 12!", 2: None}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", text\nsecond line', "r", 1), (2, "é漢字", None, None)], "row_id long, body string, rule string, rule_violation int")
    spec = TableSpec(columns={"row_id": "int64", "body": "str", "rule": "str", "rule_violation": "int32"}, features=("rule", "body"))
    path = tables.write_stage(df, str(tmp_path), ["cleaned", "zero_shot"], "set", "csv")
    assert path.endswith("cleaned_zero_shot_set")
    back = tables.read_sources(spark, {"set": path}, {"set": spec}, with_file=True)["set"]
    assert sorted(map(tuple, back.drop("file").collect())) == sorted(map(tuple, df.collect()))
    assert back.filter("file like '%.csv'").count() == 2


def test_tracking_appends_by_day(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.25)], "row_id long, body string, p double")
    path = str(tmp_path / "track")
    for day in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):
        tables.track_predictions(df, path, F.lit(day).cast("timestamp"), "p")
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(path).filter("day = '2024-01-02'").count() == 1


def test_file_roles(spark):
    names = ["train.csv", "test.csv", "sample_submission.csv", "test_sub.csv"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.role for r in df.select("name", tables.file_role(F.col("name")).alias("role")).collect()}
    assert got == {"train.csv": ["train"], "test.csv": ["test"], "sample_submission.csv": ["submission"], "test_sub.csv": ["test", "submission"]}


def test_conform_union_skips_unfit_tables(dirty):
    stacked = tables.conform_union([dirty, dirty.drop("body")], [SPEC, SPEC])
    assert stacked.count() == 6 and stacked.columns == ["rule", "body", "rule_violation"]
    with pytest.raises(ValueError):
        tables.conform_union([dirty.drop("body")], [SPEC])


def test_zero_shot_originals_win(spark):
    df = spark.createDataFrame(
        [(1, "r", "b1", 0, "b1", "p2", "n1", None), (2, "r", "b2", 1, "p2", "b1", "n1", "n2")],
        "row_id long, rule string, body string, rule_violation int, positive_example_1 string, positive_example_2 string, negative_example_1 string, negative_example_2 string",
    )
    got = {(r.body, r.slot, r.rule_violation) for r in reshape.zero_shot(df, REVIEWS).collect()}
    assert got == {("b1", 0, 0), ("b2", 0, 1), ("p2", 1, 1), ("n1", 3, 0), ("n2", 4, 0), (None, 4, 0)}
    assert reshape.zero_shot(df, REVIEWS, distinct=False).count() == 10


def test_label_gate_is_null_safe(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 7)], "row_id long, rule_violation int")
    train, test = reshape.label_gate(df)
    assert {r.row_id for r in train.collect()} == {1, 2} and {r.row_id for r in test.collect()} == {3, 4}


@pytest.mark.parametrize("count", [1, 2, 3, 7, 100])
def test_length_stats_against_the_standard_library(spark, count):
    lengths = [(i * i) % 23 + 1 for i in range(count)]
    df = spark.createDataFrame([(" ".join(["w"] * n),) for n in lengths], "body string")
    got = profile.length_stats(df, "body").first()
    assert (got["sum"], got["min"], got["max"]) == (sum(lengths), min(lengths), max(lengths))
    assert got["median"] == statistics.median(lengths) and got["mean"] == round(statistics.mean(lengths), 4)
    if count == 1:
        assert got["variance"] is None and got["p25"] is None
        return
    assert got["variance"] == pytest.approx(statistics.variance(lengths), abs=1e-4)
    cuts, fine = statistics.quantiles(lengths), statistics.quantiles(lengths, n=100)
    want = [fine[0], *cuts, fine[-1]]
    assert [got[c] for c in ("p01", "p25", "p50", "p75", "p99")] == pytest.approx([round(v, 4) for v in want])


def test_words_are_cut_at_any_white_space(spark):
    text = "a b　c d\x1ce\x85f  g\n"
    df = spark.createDataFrame([(text,)], "body string")
    assert profile.length_stats(df, "body").first()["sum"] == len(text.split()) == 7


def test_class_distribution_with_null_class(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "rule string, rule_violation int")
    got = {(r["class"], r.n_rows, r.n_classes) for r in profile.class_distribution(df, ["rule"]).collect()}
    assert got == {("a", 2, 1), (None, None, 1)}


def test_density_sums_to_one(spark):
    df = spark.createDataFrame([(" ".join(["w"] * (1 + i % 9)),) for i in range(200)], "body string")
    points = sorted((r.x, r.density) for r in profile.length_density(df, "body").collect())
    step = points[1][0] - points[0][0]
    assert len(points) == 200 and sum(d for _, d in points) * step == pytest.approx(1, abs=0.01)


def test_a_clean_table_has_an_empty_report(dirty):
    assert V.missing_columns(dirty, SPEC).collect() == []
    assert V.dtype_mismatch(dirty, SPEC).collect() == []
    assert V.dtype_mismatch(dirty, SPEC).columns == ["column", "dtype", "found", "n_uncastable"]


def test_text_that_should_be_whole_numbers(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",)], "row_id string")
    spec = TableSpec(columns={"row_id": "int64"}, features=("row_id",))
    assert tuple(V.dtype_mismatch(df, spec).first()) == ("row_id", "int64", "string", 2)


def test_label_codes_keep_nulls_and_rows(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "row_id long, rule string")
    got = {r.row_id: r.rule_le for r in reshape.encode_labels(df, ["rule"]).collect()}
    assert got == {1: 1, 2: 0, 3: None, 4: 1}


def test_statistics_report(dirty, spark):
    spec = TableSpec(columns=SPEC.columns, features=SPEC.features, target=SPEC.target, categorical=("rule", "rule_violation"))
    report = {(r.column, r.metric, r["class"], r.target): r.value for r in profile.statistics_report(dirty, spec).collect()}
    assert report["rule", "n_classes", None, None] == 2 and report["rule", "class_rows", "a", None] == 4
    assert report["rule", "target_rows", "a", "1"] == 1 and report["body", "total_vocabs", None, None] == 4
    nothing = TableSpec(columns={}, features=())
    assert profile.statistics_report(dirty, nothing).count() == 0


def test_report_is_written_as_json(dirty, spark, tmp_path):
    path = tables.write_report(V.validate(dirty, SPEC).report, str(tmp_path / "report"))
    assert spark.read.json(path).filter("metric = 'n_duplicates'").first().value == 2


def test_whole_rows_are_the_fallback_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "n long, t string")
    assert clean.dedupe(df, ["absent"], ["n"]).count() == 2 and clean.dedupe(df, None, []).count() == 2
    assert clean.dedupe(df, ["t"], ["n"]).collect() == [(1, "a")]
