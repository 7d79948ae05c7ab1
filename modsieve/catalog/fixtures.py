"""Base tables of the catalogue, derived from the given tables: once for Spark, once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modsieve.keys import number_rows, seeded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, whether it is stored as one file or as a folder of files."""
    # A pattern, because a stream takes no path that is a single file.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _as_reviews(documents: DataFrame, label) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("body"),
        F.col("lang").alias("rule"),
        F.col("source").alias("subreddit"),
        label.alias("rule_violation"),
        "n_chars",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id"
    )
    return _as_reviews(labelled, F.col("toxic"))


def reviews_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti"
    )
    return _as_reviews(rest, F.lit(None).cast("int"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the layout of the reviews, for what needs no label."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("body"), F.col("lang").alias("rule"), F.col("source").alias("subreddit")
    )


def reviews_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = reviews(spark, sf_dir).withColumn(
        "body", F.when(F.col("row_id") % 17 != 0, F.col("body"))
    )
    copies = F.when(
        F.col("row_id") % 13 == 0, F.array(F.col("row_id"), F.col("row_id") + F.lit(1000000))
    ).otherwise(F.array("row_id"))
    others = [c for c in base.columns if c != "row_id"]
    return base.select(F.explode(copies).alias("row_id"), *others)


def reviews_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with two positive and two negative example bodies of the same rule."""
    base = reviews(spark, sf_dir)
    narrow = base.select("row_id", "rule", "rule_violation")
    labelled = F.when(F.col("rule_violation") == 1, F.col("__n")).otherwise(F.lit(0))
    pools = number_rows(
        narrow, ["rule", "rule_violation"], seeded(7, "example", "row_id"), ["row_id"], out="idx", size="pool"
    )
    totals = {
        "positives": (["rule"], labelled),
        "negatives": (["rule"], F.col("__n") - labelled),
    }
    turn = number_rows(
        narrow, ["rule", "rule_violation"], seeded(7, "turn", "row_id"), ["row_id"], out="n", totals=totals
    )
    wanted = turn.select(
        "row_id",
        "rule",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f"{kind}_example_{k + 1}").alias("name"),
                        F.lit(label).alias("rule_violation"),
                        F.when(F.col(size) > 0, (2 * F.col("n") + k) % F.col(size)).alias("idx"),
                    )
                    for kind, label, size in (("positive", 1, "positives"), ("negative", 0, "negatives"))
                    for k in (0, 1)
                ]
            )
        ).alias("want"),
    ).select("row_id", "rule", "want.*")
    cards = pools.select(F.col("row_id").alias("card"), "rule", "rule_violation", "idx")
    bodies = base.select(F.col("row_id").alias("card"), F.col("body").alias("example"))
    given = wanted.join(cards, ["rule", "rule_violation", "idx"]).join(bodies, "card")
    names = [f"{kind}_example_{k}" for kind in ("positive", "negative") for k in (1, 2)]
    wide = given.groupBy("row_id").agg(
        *[F.max(F.when(F.col("name") == n, F.col("example"))).alias(n) for n in names]
    )
    return base.join(wide, "row_id", "left")


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with URLs at the start, inside and near the end, from the page addresses."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("row_id"),
        F.concat(
            F.lit("see "), "url", F.lit(" or http://a.b-c.co.uk/x/y_z.html?q=1 now. "), "url", F.lit("\n"), "html"
        ).alias("body"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("rule"),
        (F.col("page_id") % 2).cast("int").alias("rule_violation"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).withColumn("score", (F.col("n_chars") % 97) / F.lit(96.0))


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of three stand-in models, stacked."""
    return reviews(spark, sf_dir).select(
        "row_id",
        "rule",
        "rule_violation",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f"m{n}").alias("model"),
                        F.lit(float(w)).alias("weight"),
                        ((F.col("n_chars") % n) / F.lit(float(n - 1))).alias("prediction"),
                    )
                    for n, w in ((97, 4), (89, 2), (83, 2))
                ]
            )
        ).alias("p"),
    ).select("row_id", "rule", "rule_violation", "p.*")


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    centred = (F.col("score") - 0.5) * 4
    return scores(spark, sf_dir).withColumn("logits", F.array(-centred, centred))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in pronunciations for the short words of the documents."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), 0)).alias("word")
    return (
        table(spark, sf_dir, "documents")
        .select(word)
        .filter(F.char_length("word") <= 10)
        .distinct()
        .withColumn("phones", F.upper(F.concat(F.substring(F.md5("word"), 1, 2), F.lit(" "), F.substring(F.md5("word"), 3, 2))))
    )


def track_stream(events: DataFrame) -> DataFrame:
    """Tracking rows from the event table, batch or stream."""
    return events.select(
        F.col("event_type").alias("body"),
        (F.col("value") / 100).alias("violation"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


SQL = {
    "reviews": """
        SELECT d.doc_id AS row_id, d.text AS body, d.lang AS rule, d.source AS subreddit,
               l.toxic AS rule_violation, d.n_chars
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "reviews_test": """
        SELECT d.doc_id AS row_id, d.text AS body, d.lang AS rule, d.source AS subreddit,
               CAST(NULL AS INTEGER) AS rule_violation, d.n_chars
        FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "texts": "SELECT doc_id AS row_id, text AS body, lang AS rule, source AS subreddit FROM documents",
    "reviews_dirty": """
        SELECT row_id, CASE WHEN row_id % 17 <> 0 THEN body END AS body, rule, subreddit, rule_violation, n_chars
        FROM reviews
        UNION ALL
        SELECT row_id + 1000000, CASE WHEN row_id % 17 <> 0 THEN body END, rule, subreddit, rule_violation, n_chars
        FROM reviews WHERE row_id % 13 = 0""",
    "example_pool": """
        SELECT rule, rule_violation, body,
               row_number() OVER (PARTITION BY rule, rule_violation
                                  ORDER BY md5(concat_ws(':', '7', 'example', row_id)), row_id) - 1 AS idx
        FROM reviews""",
    "example_turn": """
        SELECT row_id, rule,
               row_number() OVER (PARTITION BY rule, rule_violation
                                  ORDER BY md5(concat_ws(':', '7', 'turn', row_id)), row_id) - 1 AS n,
               sum(CASE WHEN rule_violation = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY rule) AS p,
               sum(CASE WHEN rule_violation = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY rule) AS q
        FROM reviews""",
    "reviews_examples": """
        SELECT r.*, p1.body AS positive_example_1, p2.body AS positive_example_2,
               n1.body AS negative_example_1, n2.body AS negative_example_2
        FROM reviews r JOIN example_turn t ON r.row_id = t.row_id
        LEFT JOIN example_pool p1 ON p1.rule = t.rule AND p1.rule_violation = 1 AND p1.idx = (2 * t.n) % nullif(t.p, 0)
        LEFT JOIN example_pool p2 ON p2.rule = t.rule AND p2.rule_violation = 1 AND p2.idx = (2 * t.n + 1) % nullif(t.p, 0)
        LEFT JOIN example_pool n1 ON n1.rule = t.rule AND n1.rule_violation = 0 AND n1.idx = (2 * t.n) % nullif(t.q, 0)
        LEFT JOIN example_pool n2 ON n2.rule = t.rule AND n2.rule_violation = 0 AND n2.idx = (2 * t.n + 1) % nullif(t.q, 0)""",
    "linked": r"""
        SELECT page_id AS row_id,
               'see ' || url || ' or http://a.b-c.co.uk/x/y_z.html?q=1 now. ' || url || chr(10) || html AS body,
               split_part(url, '/', 3) AS rule, CAST(page_id % 2 AS INTEGER) AS rule_violation
        FROM pages""",
    "scores": "SELECT *, (n_chars % 97) / 96.0::DOUBLE AS score FROM reviews",
    "model_scores": """
        SELECT row_id, rule, rule_violation, 'm97' AS model, 4.0::DOUBLE AS weight, (n_chars % 97) / 96.0::DOUBLE AS prediction FROM reviews
        UNION ALL
        SELECT row_id, rule, rule_violation, 'm89', 2.0::DOUBLE, (n_chars % 89) / 88.0::DOUBLE FROM reviews
        UNION ALL
        SELECT row_id, rule, rule_violation, 'm83', 2.0::DOUBLE, (n_chars % 83) / 82.0::DOUBLE FROM reviews""",
    "logits": "SELECT *, [-((score - 0.5::DOUBLE) * 4), (score - 0.5::DOUBLE) * 4] AS logits FROM scores",
    "lexicon": r"""
        SELECT word, upper(substr(md5(word), 1, 2) || ' ' || substr(md5(word), 3, 2)) AS phones
        FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents)
        WHERE length(word) <= 10""",
    "track_stream": """
        SELECT event_type AS body, value / 100 AS violation, ts AS "timestamp" FROM events""",
}

# What each base table is itself built from, in order.
NEEDS = {
    "reviews_dirty": ["reviews"],
    "example_pool": ["reviews"],
    "example_turn": ["reviews"],
    "reviews_examples": ["reviews", "example_pool", "example_turn"],
    "scores": ["reviews"],
    "model_scores": ["reviews"],
    "logits": ["reviews", "scores"],
}


def with_tables(names: list[str] | str, ctes: str, final: str) -> str:
    """SQL text: the named base tables, the query's own steps, the final select."""
    wanted: list[str] = []
    for name in names.split() if isinstance(names, str) else names:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in wanted:
                wanted.append(needed)
    steps = [f"{n} AS ({SQL[n]})" for n in wanted]
    if ctes.strip():
        steps.append(ctes.strip())
    head = "WITH " + ",\n".join(steps) + "\n" if steps else ""
    return head + final
