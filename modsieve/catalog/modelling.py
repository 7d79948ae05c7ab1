"""Queries: split preparation, classifier training and scoring, streams, the whole run."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import arriving, reviews, reviews_examples, reviews_test, table, track_stream, with_tables
from modsieve.catalog.folding import SEED, folds_sql, md5_of
from modsieve.catalog.registry import query
from modsieve.catalog.reshaping import GATED
from modsieve.catalog.storage import fresh
from modsieve.operators.folds import stratified_kfold
from modsieve.operators.metrics import roc_auc
from modsieve.operators.model import TrainParams, out_of_fold, score, score_many, train_many, train_text_classifier
from modsieve.plans.prepare import NamedTable, SplitConfig, prepare_splits
from modsieve.plans.run import RunConfig, run
from modsieve.spec import REVIEWS, SYNTHETIC, TableSpec
from modsieve.streaming.track import latest, stream_score_and_track, update_stream, violation_rate

LABELLED = TableSpec(
    columns={"row_id": "int64", "body": "str", "rule": "str", "subreddit": "str", "rule_violation": "int64"},
    features=("rule", "body"),
    target="rule_violation",
)


def _tables(spark, sf):
    return [
        NamedTable("examples", reviews_examples(spark, sf), REVIEWS),
        NamedTable("plain", reviews(spark, sf).drop("row_id", "n_chars"), SYNTHETIC),
        NamedTable("arriving", reviews(spark, sf).unionByName(reviews_test(spark, sf)), LABELLED, "test"),
    ]


def folded_sql(source: str, key: str) -> str:
    return f"SELECT *, (row_number() OVER (ORDER BY rule, rule_violation, {md5_of('fold', key)}, {key}) - 1) % 10 AS fold FROM {source}"


@query(
    "prepare_splits",
    with_tables(
        "reviews reviews_test reviews_examples",
        GATED
        + f""", e1 AS (SELECT * FROM reviews_examples QUALIFY row_number() OVER (PARTITION BY rule, body ORDER BY row_id) = 1),
        e2 AS (SELECT row_id, 0 AS slot, rule, body, rule_violation FROM e1
               UNION ALL SELECT row_id, 1, rule, positive_example_1, 1 FROM e1 UNION ALL SELECT row_id, 2, rule, positive_example_2, 1 FROM e1
               UNION ALL SELECT row_id, 3, rule, negative_example_1, 0 FROM e1 UNION ALL SELECT row_id, 4, rule, negative_example_2, 0 FROM e1),
        e3 AS (SELECT * FROM e2 QUALIFY row_number() OVER (PARTITION BY rule, body ORDER BY slot, row_id) = 1),
        e4 AS ({folded_sql('e3', 'row_id, slot')}),
        p1 AS (SELECT DISTINCT rule, body, subreddit, rule_violation FROM reviews),
        p2 AS (SELECT * FROM p1 QUALIFY row_number() OVER (PARTITION BY rule, body ORDER BY subreddit, rule_violation) = 1),
        p3 AS ({folded_sql('p2', 'rule, body, subreddit')}),
        a1 AS (SELECT * FROM both_sides QUALIFY row_number() OVER (PARTITION BY rule, body ORDER BY row_id) = 1),
        parts AS (
               SELECT 'train' AS part, 'examples' AS dataset, row_id, slot, rule, body, rule_violation FROM e4
               UNION ALL SELECT 'valid', 'examples', row_id, slot, rule, body, rule_violation FROM e4 WHERE fold < 3
               UNION ALL SELECT 'train', 'plain', NULL, NULL, rule, body, rule_violation FROM p3
               UNION ALL SELECT 'valid', 'plain', NULL, NULL, rule, body, rule_violation FROM p3 WHERE fold < 3
               UNION ALL SELECT CASE WHEN rule_violation IN (0, 1) THEN 'train' ELSE 'test' END, 'arriving', row_id, NULL, rule, body, rule_violation FROM a1)""",
        """SELECT part, dataset, coalesce(row_id, -1) AS row_id, coalesce(slot, -1) AS slot, rule, body,
                  coalesce(rule_violation, -1) AS rule_violation FROM parts""",
    ),
)
def _(spark, sf):
    rows = prepare_splits(_tables(spark, sf), SplitConfig(seed=SEED, materialise=True, search=False)).rows
    known = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("row_id", "slot", "rule_violation")]
    return rows.select("part", "dataset", "rule", "body", *known)


QUICK = TrainParams(buckets=1 << 14, max_iter=10)


def _shown():
    return F.round("prediction", 6).alias("prediction")


def _unlikely(column: str = "prediction"):
    """Scores that are no probabilities, or that say nothing about their rows."""
    return F.count_if(~F.coalesce(F.col(column).between(0, 1), F.lit(False))).alias("n_wrong"), (F.countDistinct(column) > 1).alias("varied")


@query("train_text_classifier")
def _(spark, sf):
    """Row counts, and how well the classifier ranks its own training rows."""
    train = reviews(spark, sf)
    scored = score(train_text_classifier(train, QUICK), train)
    return roc_auc(scored, "prediction", "rule_violation")


@query(
    "train_text_classifier_ranks",
    with_tables(
        "reviews",
        "",
        """SELECT count(*) FILTER (WHERE rule_violation = 1) AS n_positive, count(*) FILTER (WHERE rule_violation = 0) AS n_negative,
                  'ranked' AS verdict FROM reviews""",
    ),
)
def _(spark, sf):
    train = reviews(spark, sf)
    found = roc_auc(score(train_text_classifier(train, QUICK), train), "prediction", "rule_violation")
    return found.select("n_positive", "n_negative", F.when(F.col("auc") > 0.9, "ranked").otherwise("not ranked").alias("verdict"))


@query("score")
def _(spark, sf):
    model = train_text_classifier(reviews(spark, sf), QUICK)
    return score(model, reviews_test(spark, sf)).select("row_id", "rule", _shown())


@query(
    "score_facts",
    with_tables("reviews_test", "", "SELECT rule, count(*) AS n_rows, 0::BIGINT AS n_wrong, true AS varied FROM reviews_test GROUP BY rule"),
)
def _(spark, sf):
    model = train_text_classifier(reviews(spark, sf), QUICK)
    return score(model, reviews_test(spark, sf)).groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"), *_unlikely())


def _two_models(spark, sf):
    train = reviews(spark, sf)
    augmented = TrainParams(buckets=1 << 14, max_iter=10, augments=(("sentence_shuffle", 0.5),), augment_frac=0.5)
    return score_many(train_many(train, {"base": QUICK, "augmented": augmented}), reviews_test(spark, sf))


@query("score_many")
def _(spark, sf):
    return _two_models(spark, sf).select("row_id", "model", _shown())


@query(
    "score_many_facts",
    with_tables("reviews_test", "", "SELECT model, count(*) AS n_rows, 0::BIGINT AS n_wrong, true AS varied FROM reviews_test, (VALUES ('base'), ('augmented')) m(model) GROUP BY model"),
)
def _(spark, sf):
    return _two_models(spark, sf).groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"), *_unlikely())


def _out_of_fold(spark, sf):
    return out_of_fold(stratified_kfold(reviews(spark, sf), "rule_violation", 5, SEED), 5, QUICK)


@query("out_of_fold")
def _(spark, sf):
    return _out_of_fold(spark, sf).select("row_id", "fold", "rule_violation", _shown())


@query(
    "out_of_fold_facts",
    with_tables(
        "reviews",
        f"f AS ({folds_sql('rule_violation', 5)})",
        """SELECT fold, count(*) AS n_rows, count(*) FILTER (WHERE rule_violation = 1) AS n_positive, 0::BIGINT AS n_wrong, true AS varied FROM f GROUP BY fold""",
    ),
)
def _(spark, sf):
    found = _out_of_fold(spark, sf)
    return found.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("rule_violation") == 1).alias("n_positive"), *_unlikely())


def _tracked(spark, sf):
    model = train_text_classifier(reviews(spark, sf), QUICK)
    documents = arriving(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("body"), F.col("lang").alias("rule"))
    path = fresh(spark, "stream-track")
    stream_score_and_track(documents, model, path, fresh(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path)


@query("stream_score_and_track")
def _(spark, sf):
    return _tracked(spark, sf).select("id", "body", F.round("violation", 6).alias("violation"))


@query("stream_track_facts", "SELECT doc_id AS id, text AS body, 0::BIGINT AS n_wrong FROM documents")
def _(spark, sf):
    """What the stream has stored: every document once, each with a probability."""
    wrong = F.count_if(~F.coalesce(F.col("violation").between(0, 1), F.lit(False))).alias("n_wrong")
    return _tracked(spark, sf).groupBy("id", "body").agg(wrong)


RATES = """w AS (SELECT *, time_bucket(INTERVAL '1 hour', "timestamp") AS window_start FROM track_stream)
    SELECT strftime(w.window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(w.window_start + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n_rows, round(avg(violation), 6) AS mean_violation,
           round(avg(CASE WHEN violation > 0.5::DOUBLE THEN 1 ELSE 0 END), 6) AS violation_rate FROM w"""


def _plain_times(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@query("violation_rate", with_tables("track_stream", "", "").rstrip() + ", " + RATES + " GROUP BY w.window_start")
def _(spark, sf):
    return _plain_times(violation_rate(track_stream(table(spark, sf, "events"))))


@query("violation_rate_stream", with_tables("track_stream", "", "").rstrip() + ", " + RATES + " GROUP BY w.window_start")
def _(spark, sf):
    """All windows, the last one too: every batch stores what it changed."""
    path = fresh(spark, "stream-rate")
    update_stream(violation_rate(track_stream(arriving(spark, sf, "events"))), path, fresh(spark, "stream-rate-state")).awaitTermination()
    return _plain_times(latest(spark, path, ["window_start", "window_end"]))


@query("whole_run_predictions")
def _(spark, sf):
    config = RunConfig(root=fresh(spark, "run"), models={"base": QUICK}, splits=SplitConfig(seed=SEED))
    return run(spark, _tables(spark, sf), config).predictions.withColumn("prediction", F.round("prediction", 4))
