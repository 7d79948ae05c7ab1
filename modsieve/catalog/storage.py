"""Queries: sources, sinks, file roles, stacking of conforming tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import model_scores, reviews, scores, table, with_tables
from modsieve.catalog.folding import SEED, folds_sql
from modsieve.catalog.registry import query
from modsieve.catalog.validation import COLS, EVENT_TABLE, ROW
from modsieve.operators.folds import sample_fraction, stratified_kfold
from modsieve.operators.validate import dtype_mismatch, duplicate_report
from modsieve.session import cut_lineage, work_path
from modsieve.sources.tables import (
    conform_union,
    file_role,
    read_sources,
    track_predictions,
    write_report,
    write_stage,
)
from modsieve.spec import REVIEWS, SYNTHETIC, TableSpec

DOCUMENTS = TableSpec(
    columns={"doc_id": "int64", "text": "str", "lang": "str", "source": "str", "n_chars": "int64"},
    features=("lang", "text"),
    key=("doc_id",),
)


def fresh(spark, name: str) -> str:
    """A folder of its own for every run, in the cluster's shared folder."""
    return work_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("read_sources", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, sf):
    return read_sources(spark, {"documents": f"{sf}/documents.parquet"}, {"documents": DOCUMENTS})["documents"]


@query("read_csv_source", "SELECT doc_id, text, lang, source, n_chars, 'documents' AS dataset FROM documents")
def _(spark, sf):
    path = write_stage(table(spark, sf, "documents").select(*DOCUMENTS.columns), fresh(spark, "csv"), "raw", "documents", "csv")
    tables = read_sources(spark, {"documents": path}, {"documents": DOCUMENTS})
    return tables["documents"].withColumn("dataset", F.lit("documents"))


@query(
    "read_csv_ranges",
    """SELECT doc_id, 'said ""' || source || '"", then' || chr(13) || chr(10) || coalesce(text, '') || chr(10) || lang AS text, n_chars FROM documents""".replace('""', '"'),
)
def _(spark, sf):
    """One large file full of quoted line breaks, read by many tasks."""
    said = F.concat(F.lit('said "'), "source", F.lit('", then\r\n'), F.coalesce("text", F.lit("")), F.lit("\n"), "lang")
    rows = table(spark, sf, "documents").select("doc_id", said.alias("text"), "n_chars")
    path = write_stage(rows, fresh(spark, "csv-ranges"), "raw", "documents", "csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")  # the tables of the tests are small
    try:
        return cut_lineage(read_sources(spark, {"documents": path}, {"documents": DOCUMENTS})["documents"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query(
    "track_predictions_again",
    with_tables("scores", "", "SELECT row_id AS id, body, score AS violation, 'a' AS run FROM scores UNION ALL SELECT row_id, body, score / 2, 'b' FROM scores"),
)
def _(spark, sf):
    """Two runs, the first of them tried twice: one copy of each."""
    path, day = fresh(spark, "track-again"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = scores(spark, sf)
    for run, factor in (("a", 1), ("b", 2), ("a", 1)):
        track_predictions(rows.withColumn("score", F.col("score") / factor), path, day, "score", run=run)
    return spark.read.parquet(path).select("id", "body", "violation", "run")


@query("read_csv_shuffled_columns", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, sf):
    """The file's columns stand in another order than declared, with one more among them."""
    columns = ["text", "n_chars", F.lit("x").alias("extra"), "source", "doc_id", "lang"]
    path = write_stage(table(spark, sf, "documents").select(*columns), fresh(spark, "csv-order"), "raw", "documents", "csv")
    return read_sources(spark, {"documents": path}, {"documents": DOCUMENTS})["documents"]


@query(
    "csv_uncastable",
    """SELECT 'value' AS "column", 'int64' AS dtype, 'string' AS found, count(value) AS n_uncastable FROM events
       UNION ALL
       SELECT 'props', 'int64', 'string', count(*) FILTER (WHERE props IS NOT NULL AND try_cast(props AS BIGINT) IS NULL) FROM events""",
)
def _(spark, sf):
    """Values that do not fit the declared whole numbers; the other columns get their types."""
    columns = ["props", "value", "event_id", "user_id", "event_type"]
    path = write_stage(table(spark, sf, "events").select(*columns), fresh(spark, "csv-types"), "raw", "events", "csv")
    read = read_sources(spark, {"events": path}, {"events": EVENT_TABLE})["events"]
    return dtype_mismatch(read, EVENT_TABLE)


NAME = "lang || CASE WHEN n_chars % 2 = 0 THEN '_test' ELSE '' END || CASE WHEN n_chars % 3 = 0 THEN '_sub' ELSE '' END || '.csv'"


@query(
    "file_role",
    f"""WITH f AS (SELECT {NAME} AS name FROM documents),
        r AS (SELECT name, 'test' AS role FROM f WHERE contains(name, 'test')
              UNION ALL SELECT name, 'submission' FROM f WHERE contains(name, 'sub')
              UNION ALL SELECT name, 'train' FROM f WHERE NOT contains(name, 'test') AND NOT contains(name, 'sub'))
        SELECT name, role, count(*) AS n_rows FROM r GROUP BY name, role""",
)
def _(spark, sf):
    named = table(spark, sf, "documents").select(F.expr(NAME).alias("name"))
    roles = named.select("name", F.explode(file_role(F.col("name"))).alias("role"))
    return roles.groupBy("name", "role").agg(F.count(F.lit(1)).alias("n_rows"))


@query("write_stage", with_tables("reviews", "", f"SELECT {ROW} FROM reviews"))
def _(spark, sf):
    path = write_stage(reviews(spark, sf).select(COLS), fresh(spark, "stage"), ["cleaned", "zero_shot"], "reviews")
    return spark.read.parquet(path)


@query(
    "write_report",
    """WITH g AS (SELECT lang, text, count(*) AS n FROM documents GROUP BY lang, text)
       SELECT CAST(sum(n) AS BIGINT) AS raw_count, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
              CASE WHEN sum(n - 1) = 0 THEN 100.0::DOUBLE ELSE round(100 * count(*)::DOUBLE / sum(n)::DOUBLE, 4) END AS purity FROM g""",
)
def _(spark, sf):
    path = write_report(duplicate_report(table(spark, sf, "documents"), DOCUMENTS), fresh(spark, "report"))
    return spark.read.schema("raw_count bigint, n_duplicates bigint, purity double").json(path)


@query(
    "track_predictions",
    with_tables("scores", "", """SELECT row_id AS id, body, score AS violation, strftime(DATE '2024-01-01' + CAST(row_id % 3 AS INTEGER), '%Y-%m-%d') AS day FROM scores"""),
)
def _(spark, sf):
    path = fresh(spark, "track")
    base = scores(spark, sf)
    # Two appends, as two runs would do; each goes to the days of its rows.
    ts = (F.lit("2024-01-01 12:00:00").cast("timestamp") + F.make_dt_interval((F.col("row_id") % 3).cast("int"))).alias("ts")
    for part in (0, 1):
        track_predictions(base.filter(F.col("row_id") % 2 == part), path, ts, "score")
    return spark.read.parquet(path).select("id", "body", "violation", F.col("day").cast("string").alias("day"))


@query(
    "track_sample",
    with_tables(
        "scores",
        """s AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '1234', 'sample', row_id)), row_id) AS rn, count(*) OVER () AS n FROM scores)""",
        "SELECT row_id AS id, body, rule_violation::DOUBLE AS violation FROM s WHERE rn <= round(n * 0.1::DOUBLE)",
    ),
)
def _(spark, sf):
    path = fresh(spark, "track-sample")
    sampled = sample_fraction(scores(spark, sf), 0.1, SEED)
    track_predictions(sampled, path, F.lit("2024-01-01 12:00:00").cast("timestamp"), "rule_violation")
    return spark.read.parquet(path).select("id", "body", "violation")


@query(
    "conform_union",
    with_tables(
        "reviews",
        f"f AS ({folds_sql('rule_violation', 5)})",
        """SELECT rule, body, rule_violation, fold FROM f UNION ALL SELECT rule, body, rule_violation, fold FROM f""",
    ),
)
def _(spark, sf):
    folded = stratified_kfold(reviews(spark, sf), "rule_violation", 5, SEED)
    synthetic = folded.drop("row_id", "n_chars")
    without_body = model_scores(spark, sf)
    return conform_union([folded, synthetic, without_body], [REVIEWS, SYNTHETIC, SYNTHETIC], with_fold=True)
