"""Queries: tokens, TF-IDF, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import table
from modsieve.catalog.registry import query
from modsieve.catalog.storage import fresh
from modsieve.operators.drift import (
    compare_to_profile,
    dealt_features,
    detect_drift,
    domain_classifier,
    mean_vector_drift,
    project_2d,
    projection_histogram,
    read_profile,
    reference_profile,
    term_counts,
    tfidf,
    write_profile,
)

TERMS = r"""tok AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM docs),
occ AS (SELECT doc_id, lang, unnest(t) AS term FROM tok
        UNION ALL SELECT doc_id, lang, unnest(list_transform(list_zip(t[1:-2], t[2:]), lambda z: z[1] || ' ' || z[2])) FROM tok WHERE len(t) > 1),
tf AS (SELECT doc_id, lang, term, count(*) AS tf FROM occ GROUP BY ALL)"""

WEIGHTS = (
    TERMS
    + """,
voc AS (SELECT term, count(*) AS df FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 500),
raw AS (SELECT doc_id, lang, term, tf * (ln((1 + (SELECT count(*) FROM docs))::DOUBLE / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN voc USING (term)),
weights AS (SELECT doc_id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""
)

ALL_DOCS = "WITH docs AS (SELECT * FROM documents), "


@query("tokenize", ALL_DOCS + TERMS + " SELECT doc_id, term, tf FROM tf")
def _(spark, sf):
    return term_counts(table(spark, sf, "documents"), "text", ["doc_id"])


@query("tfidf", ALL_DOCS + WEIGHTS + " SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
def _(spark, sf):
    weights = tfidf(table(spark, sf, "documents"), "text", ["doc_id"])
    return weights.withColumn("weight", F.round("weight", 6))


# English against all other languages.
MEANS = """, m AS (SELECT term, coalesce(sum(weight) FILTER (WHERE lang = 'en'), 0) AS a, coalesce(sum(weight) FILTER (WHERE lang <> 'en'), 0) AS b
                 FROM weights GROUP BY term),
    n AS (SELECT *, sqrt(sum(a * a) OVER ()) AS la, sqrt(sum(b * b) OVER ()) AS lb FROM m),
    drift AS (SELECT round(sqrt(sum(pow(a / la - b / lb, 2))), 4) AS distance, round(sum(a / la * b / lb), 4) AS cosine FROM n) """


@query(
    "mean_vector_drift",
    ALL_DOCS + WEIGHTS + MEANS + "SELECT distance AS euclidean_mean_distance, cosine AS cosine_mean_similarity FROM drift",
)
def _(spark, sf):
    weights = tfidf(table(spark, sf, "documents"), "text", ["doc_id", "lang"])
    return mean_vector_drift(weights, F.col("lang") != "en")


def _languages(spark, sf):
    """Documents in two sides: English against the other languages."""
    documents = table(spark, sf, "documents")
    english = F.col("lang") == "en"
    return documents.filter(english), documents.filter(~english)


def _features(spark, sf):
    ref, cur = _languages(spark, sf)
    return dealt_features(ref, "text", ["doc_id"], cur, 2, 1234)[1]


@query("project_2d")
def _(spark, sf):
    """Every document's place along the two principal axes of the English ones."""
    placed = project_2d(_features(spark, sf), ~F.col("side"))
    return placed.select("doc", "side", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("projection_histogram")
def _(spark, sf):
    """Densities of both sides along both axes."""
    return projection_histogram(project_2d(_features(spark, sf), ~F.col("side")), F.col("side"))


@query(
    "projection_facts",
    """SELECT dimension, lang <> 'en' AS side, count(*) AS n_docs, 1.0::DOUBLE AS mass, max(CASE WHEN lang = 'en' THEN 0.0::DOUBLE END) AS centre
       FROM documents, (VALUES ('x'), ('y')) d(dimension) GROUP BY ALL""",
)
def _(spark, sf):
    """Documents placed on each side, their whole density, and the centre of the English ones (zero)."""
    placed = project_2d(_features(spark, sf), ~F.col("side"))
    bars = projection_histogram(placed, F.col("side")).groupBy("dimension", "side").agg(F.round(F.sum(F.col("density") * F.col("width")), 6).alias("mass"))
    points = placed.select("side", F.inline(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("v")) for c in "xy"])))
    centre = F.when(~F.col("side"), F.round(F.avg("v"), 9) + 0.0)
    facts = points.groupBy("dimension", "side").agg(F.count("v").alias("n_docs"), centre.alias("centre"))
    return facts.join(bars, ["dimension", "side"]).withColumn("centre", F.abs("centre"))


@query("domain_classifier")
def _(spark, sf):
    """Held-out accuracy and AUC of a forest that tells English from other documents."""
    return domain_classifier(_features(spark, sf), "fold", "held_out", trees=20, binary=True)


@query("detect_drift_one_table")
def _(spark, sf):
    return detect_drift(table(spark, sf, "documents"), "text", ["doc_id"], n_splits=5, trees=20).summary


def _two_tables(spark, sf):
    ref, cur = _languages(spark, sf)
    return detect_drift(ref, "text", ["doc_id"], cur, trees=20)


@query("detect_drift_two_tables")
def _(spark, sf):
    return _two_tables(spark, sf).summary


@query("detect_drift_histogram")
def _(spark, sf):
    return _two_tables(spark, sf).histogram


@query(
    "detect_drift_means",
    ALL_DOCS + WEIGHTS + MEANS + "SELECT distance AS euclidean_mean_distance, cosine AS cosine_mean_similarity, 'told apart' AS verdict FROM drift",
)
def _(spark, sf):
    """The mean vectors of the two tables, and what the forest makes of them: languages differ in their words."""
    apart = (F.col("accuracy") > 0.6) & (F.col("auc_score") > 0.8)
    verdict = F.when(apart, "told apart").otherwise("alike").alias("verdict")
    return _two_tables(spark, sf).summary.select("euclidean_mean_distance", "cosine_mean_similarity", verdict)


@query(
    "drift_profile",
    "WITH docs AS (SELECT * FROM documents WHERE lang = 'en'), "
    + TERMS
    + r""",
voc AS (SELECT term, count(*) AS df FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 500),
every AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM documents),
each AS (SELECT doc_id, lang, unnest(t) AS term FROM every
         UNION ALL SELECT doc_id, lang, unnest(list_transform(list_zip(t[1:-2], t[2:]), lambda z: z[1] || ' ' || z[2])) FROM every WHERE len(t) > 1),
raw AS (SELECT doc_id, lang, term, count(*) * (ln((1 + (SELECT count(*) FROM docs))::DOUBLE / (1 + any_value(df))::DOUBLE) + 1) AS w
        FROM each JOIN voc USING (term) GROUP BY doc_id, lang, term),
weights AS (SELECT doc_id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""
    + MEANS
    + """SELECT (SELECT count(*) FROM docs) AS reference_rows, (SELECT count(*) FROM documents WHERE lang <> 'en') AS rows,
               distance AS euclidean_mean_distance, cosine AS cosine_mean_similarity FROM drift""",
)
def _(spark, sf):
    """Other languages against the stored profile of the English documents, which are not read again."""
    ref, cur = _languages(spark, sf)
    path = write_profile(spark, reference_profile(ref, "text"), fresh(spark, "profile"))
    summary, _ = compare_to_profile(read_profile(spark, path), cur, "text")
    return summary.select("reference_rows", "rows", "euclidean_mean_distance", "cosine_mean_similarity")
