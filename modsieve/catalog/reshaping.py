"""Queries: zero-shot reshaping, label gate, label codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import reviews, reviews_examples, reviews_test, with_tables
from modsieve.catalog.registry import query
from modsieve.operators.reshape import encode_labels, label_gate, zero_shot
from modsieve.spec import REVIEWS

# The example rows in long form: slot 0 is the row itself.
LONG = """long AS (
    SELECT row_id, 0 AS slot, rule, subreddit, body, rule_violation FROM reviews_examples
    UNION ALL SELECT row_id, 1, rule, subreddit, positive_example_1, 1 FROM reviews_examples
    UNION ALL SELECT row_id, 2, rule, subreddit, positive_example_2, 1 FROM reviews_examples
    UNION ALL SELECT row_id, 3, rule, subreddit, negative_example_1, 0 FROM reviews_examples
    UNION ALL SELECT row_id, 4, rule, subreddit, negative_example_2, 0 FROM reviews_examples),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rule, body ORDER BY slot, row_id) AS rn FROM long)"""


@query("reviews_with_examples", with_tables("reviews_examples", "", "SELECT * FROM reviews_examples"))
def _(spark, sf):
    return reviews_examples(spark, sf)


@query(
    "zero_shot",
    with_tables("reviews_examples", LONG, "SELECT row_id, slot, rule, body, rule_violation FROM ranked WHERE rn = 1"),
)
def _(spark, sf):
    return zero_shot(reviews_examples(spark, sf), REVIEWS)


@query(
    "zero_shot_keep_features",
    with_tables("reviews_examples", LONG, "SELECT row_id, slot, rule, subreddit, body, rule_violation FROM long"),
)
def _(spark, sf):
    return zero_shot(reviews_examples(spark, sf), REVIEWS, keep=["subreddit"], distinct=False)


@query("zero_shot_without_examples", with_tables("reviews", "", "SELECT * FROM reviews"))
def _(spark, sf):
    return zero_shot(reviews(spark, sf), REVIEWS)


GATED = """both_sides AS (SELECT * FROM reviews UNION ALL SELECT * FROM reviews_test)"""


@query(
    "label_gate",
    with_tables(
        "reviews reviews_test",
        GATED,
        """SELECT row_id, body, rule_violation,
                  CASE WHEN coalesce(rule_violation IN (0, 1), false) THEN 'train' ELSE 'test' END AS part FROM both_sides""",
    ),
)
def _(spark, sf):
    mixed = reviews(spark, sf).unionByName(reviews_test(spark, sf))
    train, test = label_gate(mixed)
    keep = ["row_id", "body", "rule_violation"]
    return train.select(*keep, F.lit("train").alias("part")).unionByName(test.select(*keep, F.lit("test").alias("part")))


@query(
    "encode_labels",
    with_tables(
        "reviews",
        "",
        """SELECT row_id, rule, subreddit, rule_violation, CAST(dense_rank() OVER (ORDER BY rule) - 1 AS INTEGER) AS rule_le,
                  CAST(dense_rank() OVER (ORDER BY subreddit) - 1 AS INTEGER) AS subreddit_le FROM reviews""",
    ),
)
def _(spark, sf):
    labelled = reviews(spark, sf).select("row_id", "rule", "subreddit", "rule_violation")
    return encode_labels(labelled, ["rule", "subreddit", "rule_violation"])
