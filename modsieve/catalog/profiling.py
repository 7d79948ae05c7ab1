"""Queries: class counts, length statistics, vocabulary, density, frequent words."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import reviews, table, with_tables
from modsieve.catalog.registry import query
from modsieve.catalog.storage import fresh
from modsieve.catalog.validation import REVIEW_TABLE
from modsieve.functions.text import words
from modsieve.operators.profile import (
    class_distribution,
    length_density,
    length_stats,
    mode,
    quantiles,
    statistics_report,
    target_distribution,
    top_terms,
    vocabulary_estimate,
    vocabulary_sketch,
    vocabulary_stats,
)

# English, German, French and Spanish function words, left out of the
# frequent-word table.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "der die das und ist nicht mit von zu ein eine auf für "
    "le la les et de des du un une est en pour dans que qui sur "
    "el los las y un una es por para con no se su"
).split()

WORDS_RE = r"[^\t-\r\x1c-\x20\x{85}\p{Z}]+"

UNPIVOTED = """u AS (
    SELECT 'rule' AS "column", rule AS "class", rule_violation FROM reviews
    UNION ALL SELECT 'subreddit', subreddit, rule_violation FROM reviews
    UNION ALL SELECT 'rule_violation', CAST(rule_violation AS VARCHAR), rule_violation FROM reviews),
sizes AS (SELECT "column", count(DISTINCT "class") AS n_classes FROM u GROUP BY "column")"""


@query(
    "class_distribution",
    with_tables(
        "reviews",
        UNPIVOTED,
        """SELECT "column", "class", nullif(count("class"), 0) AS n_rows, n_classes FROM u JOIN sizes USING ("column") GROUP BY ALL""",
    ),
)
def _(spark, sf):
    return class_distribution(reviews(spark, sf), ["rule", "subreddit", "rule_violation"])


@query(
    "target_distribution",
    with_tables(
        "reviews",
        UNPIVOTED,
        """SELECT "column", "class", rule_violation, count(*) AS n_rows FROM u JOIN sizes USING ("column")
           WHERE "column" <> 'rule_violation' GROUP BY ALL""",
    ),
)
def _(spark, sf):
    return target_distribution(reviews(spark, sf), ["rule", "subreddit", "rule_violation"])


def lengths_sql(unit: str) -> str:
    length = f"len(regexp_extract_all(text, '{WORDS_RE}'))" if unit == "word" else "length(text)"
    return f"""lengths AS (SELECT CAST({length} AS BIGINT) AS length FROM documents),
ordered AS (SELECT length, row_number() OVER (ORDER BY length) AS rn, count(*) OVER () AS m FROM lengths)"""


def quantile_sql(i: int, n: int) -> str:
    j = f"greatest(1, least(({i} * (m + 1)) // {n}, m - 1))"
    return (
        f"round((max(CASE WHEN rn = {j} THEN length END) * ({n} - max({i} * (m + 1) - {j} * {n}))"
        f" + max(CASE WHEN rn = {j} + 1 THEN length END) * max({i} * (m + 1) - {j} * {n}))::DOUBLE / {n}, 4)"
    )


def length_stats_sql(unit: str) -> str:
    return f"""WITH {lengths_sql(unit)},
    best AS (SELECT length AS mode FROM lengths GROUP BY length ORDER BY count(*) DESC, length LIMIT 1)
    SELECT CAST(sum(length) AS BIGINT) AS sum, min(length) AS min, max(length) AS max,
           round(sum(length)::DOUBLE / count(*)::DOUBLE, 4) AS mean, round(median(length), 4) AS median,
           (SELECT mode FROM best) AS mode,
           round((count(*)::HUGEINT * sum(length * length)::HUGEINT - sum(length)::HUGEINT * sum(length)::HUGEINT)::DOUBLE
                 / (count(*)::DOUBLE * (count(*) - 1)::DOUBLE), 4) AS variance,
           round(sqrt((count(*)::HUGEINT * sum(length * length)::HUGEINT - sum(length)::HUGEINT * sum(length)::HUGEINT)::DOUBLE
                 / (count(*)::DOUBLE * (count(*) - 1)::DOUBLE)), 4) AS stdev,
           {quantile_sql(1, 100)} AS p01, {quantile_sql(1, 4)} AS p25, {quantile_sql(2, 4)} AS p50,
           {quantile_sql(3, 4)} AS p75, {quantile_sql(99, 100)} AS p99
    FROM ordered"""


@query("length_stats_words", length_stats_sql("word"))
def _(spark, sf):
    return length_stats(table(spark, sf, "documents"), "text", "word")


@query("length_stats_chars", length_stats_sql("char"))
def _(spark, sf):
    return length_stats(table(spark, sf, "documents"), "text", "char")


CUTS = [(i, 10) for i in range(1, 10)] + [(1, 100), (99, 100)]


@query(
    "exclusive_quantiles",
    f"WITH {lengths_sql('word')} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS i, CAST({n} AS INTEGER) AS n, {quantile_sql(i, n)} AS quantile FROM ordered" for i, n in CUTS
    ),
)
def _(spark, sf):
    return quantiles(table(spark, sf, "documents"), "text", CUTS)


@query(
    "length_mode",
    f"WITH {lengths_sql('char')} SELECT length AS mode FROM lengths GROUP BY length ORDER BY count(*) DESC, length LIMIT 1",
)
def _(spark, sf):
    return mode(table(spark, sf, "documents"), "text", "char")


@query(
    "vocabulary_stats",
    f"""WITH w AS (SELECT unnest(regexp_extract_all(text, '{WORDS_RE}')) AS word FROM documents)
        SELECT count(*) AS total_vocabs, count(DISTINCT word) AS total_unique_vocabs,
               round(100 * count(DISTINCT word)::DOUBLE / count(*)::DOUBLE, 4) AS uniqueness FROM w""",
)
def _(spark, sf):
    return vocabulary_stats(table(spark, sf, "documents"), "text")


@query(
    "vocabulary_sketches",
    f"""WITH w AS (SELECT lang, unnest(regexp_extract_all(text, '{WORDS_RE}')) AS word FROM documents),
        parts AS (SELECT lang AS part, count(*) AS total_vocabs, count(DISTINCT word) AS n_words FROM w GROUP BY lang
                  UNION ALL SELECT 'all', count(*), count(DISTINCT word) FROM w)
        SELECT part, total_vocabs, n_words, true AS close FROM parts""",
)
def _(spark, sf):
    """Stored sketches by language, alone and merged, against the exact numbers of different words."""
    documents, path = table(spark, sf, "documents"), fresh(spark, "sketches")
    vocabulary_sketch(documents, "text", ["lang"], precision=14).write.parquet(path)
    stored = spark.read.parquet(path)
    estimates = vocabulary_estimate(stored, ["lang"]).withColumnRenamed("lang", "part")
    estimates = estimates.unionByName(vocabulary_estimate(stored).withColumn("part", F.lit("all")))
    each = documents.select("lang", F.explode(words(F.col("text"))).alias("word"))
    exact = each.groupBy(F.col("lang").alias("part")).agg(F.countDistinct("word").alias("n_words"))
    exact = exact.unionByName(each.agg(F.countDistinct("word").alias("n_words")).withColumn("part", F.lit("all")))
    error = F.abs(F.col("total_unique_vocabs") - F.col("n_words")) / F.col("n_words")
    return estimates.join(exact, "part").select("part", "total_vocabs", "n_words", (error < 0.03).alias("close"))


def density_sql(unit: str) -> str:
    return f"""WITH {lengths_sql(unit)},
    s AS (SELECT count(*)::DOUBLE AS m, stddev_samp(length) * pow(count(*)::DOUBLE, -0.2::DOUBLE) AS bw,
                 min(length) AS mn, max(length) AS mx FROM lengths),
    g AS (SELECT CAST(p AS INTEGER) AS point, m, bw,
                 mn - 3 * bw + p * ((mx + 3 * bw) - (mn - 3 * bw)) / 199.0::DOUBLE AS x FROM s, range(200) r(p)),
    h AS (SELECT length, count(*) AS n FROM lengths GROUP BY length)
    SELECT point, round(max(x), 4) AS x,
           round(sum(n * exp(-0.5::DOUBLE * pow((x - length) / bw, 2)) / (m * bw * sqrt(2 * pi()))), 9) AS density
    FROM g, h GROUP BY point"""


@query("length_density_words", density_sql("word"))
def _(spark, sf):
    return length_density(table(spark, sf, "documents"), "text", "word")


@query("length_density_chars", density_sql("char"))
def _(spark, sf):
    return length_density(table(spark, sf, "documents"), "text", "char")


TOP_TERMS = rf"""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS word FROM documents)
        SELECT word, count(*) AS n FROM w WHERE word NOT IN ({', '.join(f"'{w}'" for w in sorted(set(STOP_WORDS)))})
        GROUP BY word ORDER BY n DESC, word LIMIT 100"""


@query("top_terms", TOP_TERMS)
def _(spark, sf):
    return top_terms(table(spark, sf, "documents"), "text", STOP_WORDS, 100)


@query("top_terms_sketch", TOP_TERMS)
def _(spark, sf):
    """The same from the candidates of a frequent-items sketch."""
    return top_terms(table(spark, sf, "documents"), "text", STOP_WORDS, 100, sketch=True)


def _long(source: str, prefix: str) -> str:
    return f"""SELECT 'body' AS "column", '{prefix}' || metric AS metric, CAST(NULL AS VARCHAR) AS "class", CAST(NULL AS VARCHAR) AS target,
                      "value"::DOUBLE AS "value" FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM {source}) ON COLUMNS(*) INTO NAME metric VALUE "value")"""


def _of_reviews(sql: str) -> str:
    return sql.replace("FROM documents", "FROM (SELECT body AS text FROM reviews)")


@query(
    "statistics_report",
    with_tables(
        "reviews",
        UNPIVOTED
        + f""", by_word AS ({_of_reviews(length_stats_sql('word'))}), by_char AS ({_of_reviews(length_stats_sql('char'))}),
        w AS (SELECT unnest(regexp_extract_all(body, '{WORDS_RE}')) AS word FROM reviews),
        vocab AS (SELECT count(*) AS total_vocabs, count(DISTINCT word) AS total_unique_vocabs,
                         round(100 * count(DISTINCT word)::DOUBLE / count(*)::DOUBLE, 4) AS uniqueness FROM w)""",
        f"""SELECT "column", 'n_classes' AS metric, CAST(NULL AS VARCHAR) AS "class", CAST(NULL AS VARCHAR) AS target, n_classes::DOUBLE AS "value" FROM sizes
            UNION ALL SELECT "column", 'class_rows', "class", NULL, count(*)::DOUBLE FROM u JOIN sizes USING ("column") GROUP BY "column", "class"
            UNION ALL SELECT "column", 'target_rows', "class", rule_violation::VARCHAR, count(*)::DOUBLE FROM u JOIN sizes USING ("column")
                      WHERE "column" <> 'rule_violation' GROUP BY "column", "class", rule_violation
            UNION ALL {_long('by_word', 'word_length_')} UNION ALL {_long('by_char', 'char_length_')} UNION ALL {_long('vocab', '')}""",
    ),
)
def _(spark, sf):
    return statistics_report(reviews(spark, sf), REVIEW_TABLE)
