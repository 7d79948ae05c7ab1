"""Queries: validation, quarantine, cleaning, deduplication."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import (
    linked,
    reviews,
    reviews_dirty,
    reviews_test,
    scores,
    table,
    with_tables,
)
from modsieve.catalog.registry import query
from modsieve.functions.repair import damage_decoding, repair_decoding
from modsieve.operators.clean import (
    WASH_EMAIL,
    WASH_EMOJI,
    WASH_PHONE,
    WASH_URL,
    dedupe,
    redundancy_gate,
    wash_text,
)
from modsieve.operators.validate import (
    dtype_mismatch,
    duplicate_report,
    missing_columns,
    missing_rows_report,
    quarantine_duplicates,
    quarantine_missing,
    submission_aligned,
    validate,
)
from modsieve.spec import REVIEWS, TableSpec

REVIEW_TABLE = replace(
    REVIEWS, columns={c: REVIEWS.columns[c] for c in ("row_id", "body", "rule", "subreddit", "rule_violation")}
)
EVENT_TABLE = TableSpec(
    columns={"event_id": "int64", "ts": "timestamp", "user_id": "int", "event_type": "str", "value": "int64", "props": "int64"},
    features=("event_id",),
)

ROW = "row_id, body, rule, subreddit, rule_violation"
COLS = ["row_id", "body", "rule", "subreddit", "rule_violation"]


@query(
    "missing_columns",
    with_tables(
        "reviews",
        "",
        """SELECT c AS "column", (SELECT count(*) FROM reviews) AS n_rows
           FROM (SELECT unnest(['positive_example_1', 'positive_example_2', 'negative_example_1', 'negative_example_2']) AS c)""",
    ),
)
def _(spark, sf):
    return missing_columns(reviews(spark, sf), REVIEWS)


@query(
    "missing_columns_test_file",
    with_tables(
        "reviews_test",
        "",
        """SELECT c AS "column", (SELECT count(*) FROM reviews_test) AS n_rows
           FROM (SELECT unnest(['positive_example_1', 'positive_example_2', 'negative_example_1', 'negative_example_2']) AS c)""",
    ),
)
def _(spark, sf):
    return missing_columns(reviews_test(spark, sf).drop("rule_violation"), REVIEWS, train=False)


@query(
    "dtype_mismatch",
    """SELECT 'value' AS "column", 'int64' AS dtype, 'double' AS found, CAST(NULL AS BIGINT) AS n_uncastable
       UNION ALL
       SELECT 'props', 'int64', 'string', count(*) FILTER (WHERE props IS NOT NULL AND try_cast(props AS BIGINT) IS NULL)
       FROM events""",
)
def _(spark, sf):
    return dtype_mismatch(table(spark, sf, "events"), EVENT_TABLE)


@query(
    "duplicate_report",
    with_tables(
        "reviews_dirty",
        "g AS (SELECT rule, body, count(*) AS n FROM reviews_dirty GROUP BY rule, body)",
        """SELECT CAST(sum(n) AS BIGINT) AS raw_count, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
                  CASE WHEN sum(n - 1) = 0 THEN 100.0::DOUBLE
                       ELSE round(100 * CAST(count(*) AS DOUBLE) / sum(n)::DOUBLE, 4) END AS purity FROM g""",
    ),
)
def _(spark, sf):
    return duplicate_report(reviews_dirty(spark, sf), REVIEW_TABLE)


DIRTY_RANKED = """ranked AS (
    SELECT *, row_number() OVER (PARTITION BY rule, body ORDER BY row_id) AS rn FROM reviews_dirty)"""


@query("quarantine_duplicates_valid", with_tables("reviews_dirty", DIRTY_RANKED, f"SELECT {ROW} FROM ranked WHERE rn = 1"))
def _(spark, sf):
    return quarantine_duplicates(reviews_dirty(spark, sf).select(COLS), REVIEW_TABLE, ["row_id"])[0]


@query("quarantine_duplicates_rejected", with_tables("reviews_dirty", DIRTY_RANKED, f"SELECT {ROW} FROM ranked WHERE rn > 1"))
def _(spark, sf):
    return quarantine_duplicates(reviews_dirty(spark, sf).select(COLS), REVIEW_TABLE, ["row_id"])[1]


@query(
    "missing_rows_report",
    with_tables(
        "reviews_dirty",
        """c AS (SELECT count(*) AS n, count(*) FILTER (WHERE rule IS NULL OR body IS NULL) AS m FROM reviews_dirty)""",
        """SELECT n AS raw_count, m AS n_missing,
                  CASE WHEN m = 0 THEN 100.0::DOUBLE ELSE 100 * round((n - m)::DOUBLE / n::DOUBLE, 4) END AS purity FROM c""",
    ),
)
def _(spark, sf):
    return missing_rows_report(reviews_dirty(spark, sf), REVIEW_TABLE)


@query("quarantine_missing_valid", with_tables("reviews_dirty", "", f"SELECT {ROW} FROM reviews_dirty WHERE rule IS NOT NULL AND body IS NOT NULL"))
def _(spark, sf):
    return quarantine_missing(reviews_dirty(spark, sf).select(COLS), REVIEW_TABLE)[0]


@query("quarantine_missing_rejected", with_tables("reviews_dirty", "", f"SELECT {ROW} FROM reviews_dirty WHERE rule IS NULL OR body IS NULL"))
def _(spark, sf):
    return quarantine_missing(reviews_dirty(spark, sf).select(COLS), REVIEW_TABLE)[1]


DIRTY_TAGGED = (
    DIRTY_RANKED
    + """, tagged AS (
    SELECT *, CASE WHEN rn > 1 THEN 'duplicate' WHEN rule IS NULL OR body IS NULL THEN 'missing' END AS reject_reason FROM ranked)"""
)


def _validated(spark, sf):
    return validate(reviews_dirty(spark, sf).select(COLS), REVIEW_TABLE, ["row_id"])


@query("validate_valid", with_tables("reviews_dirty", DIRTY_TAGGED, f"SELECT {ROW} FROM tagged WHERE reject_reason IS NULL"))
def _(spark, sf):
    return _validated(spark, sf).valid


@query("validate_rejected", with_tables("reviews_dirty", DIRTY_TAGGED, f"SELECT {ROW}, reject_reason FROM tagged WHERE reject_reason IS NOT NULL"))
def _(spark, sf):
    return _validated(spark, sf).rejected


@query(
    "validate_report",
    with_tables(
        "reviews_dirty",
        DIRTY_TAGGED
        + """, c AS (SELECT count(*)::DOUBLE AS n, (count(*) FILTER (WHERE reject_reason = 'duplicate'))::DOUBLE AS d,
                     (count(*) FILTER (WHERE reject_reason = 'missing'))::DOUBLE AS m FROM tagged)""",
        """SELECT 'data_redundancy' AS "check", CAST(NULL AS VARCHAR) AS "column", 'raw_count' AS metric, n AS "value", CAST(NULL AS VARCHAR) AS detail FROM c
           UNION ALL SELECT 'data_redundancy', NULL, 'n_duplicates', d, NULL FROM c
           UNION ALL SELECT 'data_redundancy', NULL, 'purity', CASE WHEN d = 0 THEN 100 ELSE round(100 * (n - d) / n, 4) END, NULL FROM c
           UNION ALL SELECT 'missing_rows', NULL, 'raw_count', n - d, NULL FROM c
           UNION ALL SELECT 'missing_rows', NULL, 'n_missing', m, NULL FROM c
           UNION ALL SELECT 'missing_rows', NULL, 'purity', CASE WHEN m = 0 THEN 100 ELSE 100 * round((n - d - m) / (n - d), 4) END, NULL FROM c""",
    ),
)
def _(spark, sf):
    return _validated(spark, sf).report


@query(
    "submission_aligned",
    with_tables(
        "reviews_test scores",
        """t AS (SELECT row_id FROM reviews_test), s AS (SELECT row_id FROM scores)""",
        """SELECT (SELECT count(*) FROM t) AS n_test, (SELECT count(*) FROM s) AS n_submission,
                  (SELECT count(*) FROM t WHERE row_id NOT IN (SELECT row_id FROM s)) AS not_submitted,
                  (SELECT count(*) FROM s WHERE row_id NOT IN (SELECT row_id FROM t)) AS not_in_test,
                  (SELECT count(*) FROM t) = (SELECT count(*) FROM s) AS accepted""",
    ),
)
def _(spark, sf):
    return submission_aligned(reviews_test(spark, sf), scores(spark, sf))


@query(
    "dedupe",
    "SELECT doc_id, text, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
)
def _(spark, sf):
    return dedupe(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), ["lang", "text"], ["doc_id"])


@query("dedupe_whole_rows", "SELECT DISTINCT text, lang, n_chars FROM documents")
def _(spark, sf):
    return dedupe(table(spark, sf, "documents").select("text", "lang", "n_chars"), None, [])


def _washed_sql(col: str) -> str:
    quoted = {n: p.replace("'", "''") for n, p in (("u", WASH_URL), ("e", WASH_EMAIL), ("p", WASH_PHONE), ("j", WASH_EMOJI))}
    text = f"regexp_replace({col}, '{quoted['u']}', '<URL>', 'g')"
    text = f"regexp_replace({text}, '{quoted['e']}', '<EMAIL>', 'g')"
    text = f"regexp_replace({text}, '{quoted['p']}', '<PHONE>', 'g')"
    return f"regexp_replace({text}, '{quoted['j']}', '', 'g')"


@query(
    "wash_patterns_documents",
    f"SELECT doc_id, {_washed_sql('text')} AS text FROM documents",
)
def _(spark, sf):
    return wash_text(table(spark, sf, "documents").select("doc_id", "text"), ["text"], to_ascii=False)


@query(
    "wash_patterns_pages",
    with_tables("linked", "", f"SELECT row_id, {_washed_sql('body')} AS body FROM linked"),
)
def _(spark, sf):
    return wash_text(linked(spark, sf).select("row_id", "body"), ["body"], to_ascii=False)


@query("repair_decoding", "SELECT doc_id, text, true AS damaged FROM documents WHERE octet_length(encode(text)) > length(text)")
def _(spark, sf):
    """Documents read twice in the wrong code page, and restored."""
    rows = table(spark, sf, "documents").where(F.octet_length("text") > F.char_length("text"))
    twice = rows.select("doc_id", "text", damage_decoding(damage_decoding(F.col("text"))).alias("wrong"))
    return twice.select("doc_id", repair_decoding(F.col("wrong")).alias("text"), (F.col("wrong") != F.col("text")).alias("damaged"))


@query("repair_clean", "SELECT doc_id, text FROM documents")
def _(spark, sf):
    """Sound documents stay as they are."""
    return table(spark, sf, "documents").select("doc_id", repair_decoding(F.col("text")).alias("text"))


def _ascii_sql(col: str) -> str:
    for letter, plain in (("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"), ("ß", "ss"), ("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("ø", "o")):
        quoted = plain.replace("'", "''")
        col = f"replace({col}, '{letter}', '{quoted}')"
    return f"strip_accents({col})"


@query(
    "wash_text_ascii",
    with_tables(
        "",
        f"""washed AS (SELECT doc_id, {_washed_sql(_ascii_sql('text'))} AS text, {_washed_sql(_ascii_sql('lang'))} AS lang,
                           {_washed_sql(_ascii_sql('source'))} AS source, n_chars FROM documents)""",
        "SELECT * FROM washed QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1",
    ),
)
def _(spark, sf):
    return wash_text(table(spark, sf, "documents"), dedupe_on=["lang", "text"], order_by=["doc_id"])


@query(
    "redundancy_gate",
    """WITH r AS (SELECT source AS dataset, count(*) - count(DISTINCT text) AS n_duplicates FROM documents GROUP BY source)
       SELECT doc_id, source AS dataset, text FROM documents JOIN r ON source = dataset
       QUALIFY n_duplicates = 0 OR row_number() OVER (PARTITION BY source, text ORDER BY doc_id) = 1""",
)
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", F.col("source").alias("dataset"), "text")
    copies = documents.groupBy("dataset", "text").agg(F.count(F.lit(1)).alias("n"))
    report = copies.groupBy("dataset").agg(F.sum(F.col("n") - 1).alias("n_duplicates"))
    return redundancy_gate(documents, report, ["text"], ["doc_id"])
