"""Tables as large ones are stored, and steps whose cost must not outgrow their input."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import modsieve.plans.run as plan
from modsieve.catalog import QUERIES
from modsieve.catalog.fixtures import arriving
from modsieve.functions.repair import damage_decoding, repair_decoding
from modsieve.operators import drift, fold_fits, partials, reshape, triplet, validate
from modsieve.operators.model import COUNTS, TrainParams, score, train_text_classifier
from modsieve.plans.prepare import NamedTable, Splits
from modsieve.plans.run import RunConfig, run
from modsieve.spec import COLUMNS, REVIEWS, TableSpec


def _documents(spark, n=40):
    words = ["alpha beta gamma", "delta epsilon zeta"]
    rows = [(i, f"{words[i % 2]} word{i}", "en", f"s{i % 3}", 20) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_streams_of_files_and_folders(spark, tmp_path):
    documents = _documents(spark)
    documents.repartition(3).write.parquet(f"{tmp_path}/folder/documents.parquet")
    documents.coalesce(1).write.parquet(f"{tmp_path}/one")
    (tmp_path / "file").mkdir()
    next((tmp_path / "one").glob("part-*.parquet")).rename(tmp_path / "file" / "documents.parquet")
    for kind in ("folder", "file"):
        out = f"{tmp_path}/{kind}-out"
        arriving(spark, f"{tmp_path}/{kind}", "documents").writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", f"{tmp_path}/{kind}-state"
        ).trigger(availableNow=True).start().awaitTermination()
        assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == list(range(40))


def test_stream_query_over_folders(spark, tmp_path):
    documents = _documents(spark)
    documents.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = documents.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic", "1 as quality").where("doc_id < 30")
    labels.repartition(2).write.parquet(f"{tmp_path}/labels.parquet")
    found = QUERIES["stream_track_facts"](spark, str(tmp_path)).collect()
    assert len(found) == 40 and {r.n_wrong for r in found} == {0}


def _plain_model(texts, dimension):
    """The most frequent words and pairs by plain counting, with the numbers of texts that have them."""
    total, rows = Counter(), Counter()
    for text in texts:
        words = re.findall(r"\w{2,}", (text or "").lower())
        found = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        total.update(found)
        rows.update(found.keys())
    best = sorted(total, key=lambda t: (-total[t], t.encode()))[:dimension]
    return {t: math.log((1 + len(texts)) / (1 + rows[t])) + 1 for t in best}


def test_terms_are_the_most_frequent_words_and_pairs(spark):
    rng = random.Random(3)
    for n_words, dimension in ((6, 20), (60, 25), (4000, 30), (5, 500)):
        texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), n_words)}" for _ in range(rng.randrange(30))) for _ in range(80)] + [None, "", "a b"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
        model, want = drift.term_model(df, "t", dimension), _plain_model(texts, dimension)
        assert model.terms == sorted(want)
        assert all(math.isclose(i, want[t]) for t, i in zip(model.terms, model.idf))
    tied = [f"a{i:03} b{i:03}" for i in range(300)]  # all equally frequent: only the order tells
    df = spark.createDataFrame([(t,) for t in tied], "t string")
    assert drift.term_model(df, "t", 7).terms == sorted(_plain_model(tied, 7))


def test_rare_pairs_are_not_counted(spark, monkeypatch):
    counted, plain = [], drift._counting
    monkeypatch.setattr(drift, "_counting", lambda first, second, bigrams: counted.append((first, second)) or plain(first, second, bigrams))
    rows = [(f"common words stay {'the same ' * 3}rare{i} seldom{i}",) for i in range(200)]
    assert len(drift.term_model(spark.createDataFrame(rows, "t string"), "t", 5).terms) == 5
    assert all(len(words) == 5 for words in counted[0])


def test_terms_are_counted_before_the_folds_are_dealt(spark, monkeypatch):
    seen, plain = [], drift.term_model
    monkeypatch.setattr(drift, "term_model", lambda df, *a: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or plain(df, *a))
    docs = spark.createDataFrame([(i, f"{'red green' if i % 2 else 'blue black'} word{i % 7}") for i in range(40)], "d long, t string")
    assert drift.detect_drift(docs, "t", ["d"], dimension=6, trees=2).summary.count() == 1
    assert "Window" not in seen[0] and "Join" not in seen[0]


def test_equal_triplets_go_before_their_texts_move(spark, monkeypatch):
    texts = ["one", "two", "one", None, "two", "one", None, "three"]
    rows = [(i, "r" if i < 20 else "q", texts[i % 8], i % 3 % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, rule string, body string, rule_violation int")
    long = triplet.triplets_long(df, n_samples=3, n_negatives=2)
    hands = {}
    for r in long.collect():
        hands.setdefault((r.anchor, r.positive, r.row_id, r.sample), {})[r.slot] = r.negative
    want = {(a, p, h[0], h[1]) for (a, p, _, _), h in hands.items()}
    assert len(want) < len(hands)
    found = triplet.triplets(df, n_samples=3, n_negatives=2)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "first(negative" not in plan  # no grouping carries the texts of triplets
    twice = triplet.triplets(df.unionAll(df.where("row_id < 3")), n_samples=3, n_negatives=2).collect()
    assert len(twice) == len(set(twice))


@pytest.mark.parametrize("unique", [False, True])
def test_texts_of_triplets_move_once_a_block(spark, monkeypatch, unique):
    rows = [(f"k{i}", "r" if i % 5 else "q", None if i == 7 else f"text {i}" * (i % 3), int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id string, rule string, body string, rule_violation int").repartition(3)
    body, rule = {r[0]: r[2] for r in rows}, {r[0]: r[1] for r in rows}
    dealt = triplet.deal(df.drop("body"), n_samples=3, n_negatives=4).collect()
    want = sorted(((d.row_id, d.sample, d.slot, rule[d.row_id], body[d.row_id], body[d.card]) for d in dealt), key=str)
    hands = {}
    for d in dealt:
        hands.setdefault((d.row_id, d.sample), {})[d.slot] = body[d.card]
    wide = {(rule[k], body[k], *[h[i] for i in range(4)]) for (k, _), h in hands.items()}
    for settings in ({}, {"CHUNK": 4, "BLOCK_CARDS": 6, "OUT_BYTES": 40}):
        for name, value in settings.items():
            monkeypatch.setattr(triplet, name, value)
        long = triplet.triplets_long(df, n_samples=3, n_negatives=4)
        assert sorted(map(tuple, long.collect()), key=str) == want
        found = triplet.triplets(df, n_samples=3, n_negatives=4, unique_texts=unique)
        got = [tuple(r) for r in found.collect()]
        assert set(got) == wide and (unique or len(got) == len(wide))
        for made in (long, found):
            plan = made._jdf.queryExecution().optimizedPlan().toString()
            last = plan.index("MapInArrow")  # nothing moves behind it, and no grouping or join before it has a row's negatives
            assert "Repartition" not in plan[:last] and "Aggregate" not in plan[:last] and "negative" not in plan[last:].split("\n", 1)[1]
    none = triplet.triplets_long(df.where("rule_violation = 0"), n_samples=3, n_negatives=4)
    assert none.count() == 0


def test_sparse_rows_are_expanded_in_small_pieces(spark, monkeypatch):
    n, buckets = 3 * partials.ROWS + 5, 40
    rng = np.random.default_rng(5)
    places = [sorted(rng.choice(buckets, rng.integers(0, 6), replace=False).tolist()) for _ in range(n)]
    batch = pa.RecordBatch.from_pydict({"places": pa.array(places, pa.list_(pa.int32())), "n": range(n)})
    cut = list(partials.pieces(iter([batch.slice(3)])))
    assert [b.num_rows for b in cut] == [partials.ROWS] * 3 + [2]
    found = [p for b in cut for at, ends in [partials.lists(b.column("places"))] for p in np.split(at, ends[1:-1])]
    assert [p.tolist() for p in found] == places[3:]

    rows = [(i, p, [1.0 + (i + x) % 3 for x in p], i % 2 * 1.0, i % 3) for i, p in enumerate(places)]
    df = spark.createDataFrame(rows, "id int, places array<int>, counts array<double>, label double, fold int").repartition(2)
    models = fold_fits.fit_folds(df, 3, buckets, reg=0.01, steps=4)
    scored = df.select("id", fold_fits.predicted(models, df, "places", "counts", "fold").alias("p")).collect()
    for r in scored:
        _, at, times, _, k = rows[r.id]
        assert math.isclose(r.p, 1 / (1 + math.exp(-(models.coefficients[k][at] @ np.array(times) + models.intercepts[k]))), rel_tol=1e-9)


def test_repair_reads_each_pass_once(spark):
    texts = ["é € “naïve” 東京", "plain", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = df.select(damage_decoding(damage_decoding(F.col("t"))).alias("w"))
    found = wrong.select(repair_decoding(F.col("w"), passes=2).alias("t"))
    assert [r.t for r in found.collect()] == texts
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") + plan.count("RegExpExtractAll(") <= 2


@pytest.mark.parametrize("most", [10**6, 0])
def test_first_rows_by_keys_alone(spark, monkeypatch, most):
    monkeypatch.setattr(validate, "MOST_LATER", most)
    rows = [(i, f"r{i % 2}", None if i % 7 == 0 else f"b{i % 5}", f"s{i % 3}") for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, rule string, body string, subreddit string")
    least, texts = {}, {}
    for i, rule, body, subreddit in rows:
        least.setdefault((rule, body), i)
        texts[rule, body] = min(texts.get((rule, body), subreddit), subreddit)
    tagged = validate.tag_first(df, ["rule", "body"], ["row_id"])
    assert {r.row_id for r in tagged.where("is_first").collect()} == set(least.values())
    assert tagged.count() == 40
    assert ("BroadcastHashJoin" in tagged._jdf.queryExecution().executedPlan().toString()) == (most > 0)
    copies = validate.tag_first(df.drop("row_id"), ["rule", "body"], ["rule", "body", "subreddit"])  # no key: rows are numbered
    firsts = copies.where("is_first").collect()
    assert {(r.rule, r.body): r.subreddit for r in firsts} == texts and len(firsts) == len(texts) and copies.count() == 40


@pytest.mark.parametrize("most", [200_000, 0])
def test_examples_of_checked_rows(spark, monkeypatch, most):
    monkeypatch.setattr(reshape, "MOST_FRESH", most)
    names = [*COLUMNS.positive_examples, *COLUMNS.negative_examples]
    rows = [(i % 30, f"b{i}", f"r{i % 3}", i % 2, f"b{i + 3}", f"x{i % 4}", None, f"x{i % 5}") for i in range(40)]  # ids repeat
    df = spark.createDataFrame(rows, f"row_id long, body string, rule string, rule_violation int, {' string, '.join(names)} string")
    want = reshape.zero_shot(df, REVIEWS)
    got = reshape.zero_shot(df, REVIEWS, checked=True)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("slot > 0").count() > 10


def test_stored_counts_hold_no_texts(spark, tmp_path):
    spec = TableSpec({"row_id": "int64", "rule": "str", "body": "str", "rule_violation": "int64"}, ("rule", "body"), "rule_violation")
    df = spark.range(60).select(F.col("id").alias("row_id"), F.lit("r").alias("rule"), F.concat(F.lit("word"), "id").alias("body"), (F.col("id") % 2).alias("rule_violation"))
    tables = [NamedTable("t", df, spec), NamedTable("u", df.withColumn("rule_violation", F.lit(None).cast("long")), spec, "test")]
    result = run(spark, tables, RunConfig(str(tmp_path), {"m": TrainParams(buckets=1 << 9, max_iter=2)}))
    assert result.predictions.count() == 60
    assert set(spark.read.parquet(f"{tmp_path}/counted_512").columns) == {"part", "row_id", "rule_violation", COUNTS}


def test_rows_become_counts_in_small_batches(spark, tmp_path, monkeypatch):
    """The memory of the counting follows its batches, whose size another function in the same job tells."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual, sizes = spark.conf.get(setting), set()

    @F.arrow_udf("int")
    def seen(keys: pa.Array) -> pa.Array:
        return pa.array([len(keys)] * len(keys), pa.int32())

    def write(counted, *_, **__):
        sizes.update(r[0] for r in counted.select(seen("row_id")).distinct().collect())
        counted.write.parquet(f"{tmp_path}/counted")
        return f"{tmp_path}/counted"

    monkeypatch.setattr(plan, "write_stage", write)
    df = spark.range(1000).coalesce(1).select(F.col("id").alias("row_id"), F.lit("r").alias("rule"), F.concat(F.lit("word"), "id").alias("body"), F.lit("train").alias("part"))
    assert plan._counts(Splits(df), 1 << 9, "").rows.count() == 1000 and max(sizes) <= 256
    assert spark.conf.get(setting) == usual


def test_a_model_runs_once_per_row(spark):
    df = spark.createDataFrame([("r", f"word{i % 3}", i % 2) for i in range(20)], "rule string, body string, rule_violation int")
    fitted = train_text_classifier(df, TrainParams(buckets=1 << 9, max_iter=2))
    found = score(fitted, df).filter(F.col("prediction").isNotNull()).groupBy("prediction").count()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(UDF(UDF(UDF(") == 1
