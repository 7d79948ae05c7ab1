"""Queries: ranking metrics, accuracy, softmax, ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import logits, model_scores, scores, table, with_tables
from modsieve.catalog.registry import query
from modsieve.operators.metrics import (
    accuracy,
    column_averaged_auc,
    ensemble_mean,
    positive_probability,
    roc_auc,
    sharpen,
)


def auc_sql(source: str, score: str, label: str, by: str = "") -> str:
    """Steps ``auc``: mean ranks of the positives, which is an independent way to the area."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""ranks AS (
        SELECT {keys}{label} AS y, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER (PARTITION BY {keys}{score}) - 1) / 2.0::DOUBLE AS r
        FROM {source}),
    auc AS (
        SELECT {keys}count(*) FILTER (WHERE y = 1) AS n_positive, count(*) FILTER (WHERE y = 0) AS n_negative,
               (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0::DOUBLE)
               / nullif(count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0), 0)::DOUBLE AS auc
        FROM ranks {group})"""


@query("roc_auc", with_tables("scores", auc_sql("scores", "score", "rule_violation"), "SELECT round(auc, 6) AS auc, n_positive, n_negative FROM auc"))
def _(spark, sf):
    return roc_auc(scores(spark, sf), "score", "rule_violation").withColumn("auc", F.round("auc", 6))


@query(
    "roc_auc_by_rule",
    with_tables("scores", auc_sql("scores", "score", "rule_violation", "rule"), "SELECT rule, round(auc, 6) AS auc, n_positive, n_negative FROM auc"),
)
def _(spark, sf):
    return roc_auc(scores(spark, sf), "score", "rule_violation", ["rule"]).withColumn("auc", F.round("auc", 6))


@query(
    "roc_auc_continuous",
    f"""WITH s AS (SELECT event_type, value, user_id % 2 AS y FROM events), {auc_sql('s', 'value', 'y', 'event_type')}
        SELECT event_type, round(auc, 6) AS auc, n_positive, n_negative FROM auc""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_type", "value", (F.col("user_id") % 2).alias("y"))
    return roc_auc(events, "value", "y", ["event_type"]).withColumn("auc", F.round("auc", 6))


@query("accuracy", with_tables("scores", "", "SELECT round(avg(CASE WHEN (score > 0.5::DOUBLE) = (rule_violation = 1) THEN 1 ELSE 0 END), 6) AS accuracy FROM scores"))
def _(spark, sf):
    return accuracy(scores(spark, sf), "score", "rule_violation").withColumn("accuracy", F.round("accuracy", 6))


@query(
    "column_averaged_auc",
    with_tables(
        "scores",
        auc_sql("scores", "score", "rule_violation", "subreddit"),
        "SELECT round(avg(auc), 6) AS auc, count(auc) AS n_groups, count(*) - count(auc) AS n_one_class FROM auc",
    ),
)
def _(spark, sf):
    averaged = column_averaged_auc(scores(spark, sf), "score", "rule_violation", ["subreddit"])
    return averaged.withColumn("auc", F.round("auc", 6))


@query(
    "positive_probability",
    with_tables("logits", "", "SELECT row_id, round(exp(logits[2]) / (exp(logits[1]) + exp(logits[2])), 6) AS prediction FROM logits"),
)
def _(spark, sf):
    return logits(spark, sf).select("row_id", F.round(positive_probability(F.col("logits")), 6).alias("prediction"))


@query("ensemble_mean", with_tables("model_scores", "", "SELECT row_id, round(avg(prediction), 6) AS prediction FROM model_scores GROUP BY row_id"))
def _(spark, sf):
    return ensemble_mean(model_scores(spark, sf)).withColumn("prediction", F.round("prediction", 6))


@query(
    "ensemble_weighted",
    with_tables("model_scores", "", "SELECT row_id, round(sum(weight * prediction) / sum(weight), 6) AS prediction FROM model_scores GROUP BY row_id"),
)
def _(spark, sf):
    return ensemble_mean(model_scores(spark, sf), weight="weight").withColumn("prediction", F.round("prediction", 6))


@query("sharpen", with_tables("scores", "", "SELECT row_id, round(sqrt(score), 6) AS score FROM scores WHERE score >= 0.5::DOUBLE"))
def _(spark, sf):
    return sharpen(scores(spark, sf).select("row_id", "score"), "score").withColumn("score", F.round("score", 6))
