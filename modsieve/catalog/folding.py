"""Queries: numbering, folds, splits, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import reviews, reviews_dirty, reviews_test, table, with_tables
from modsieve.catalog.registry import query
from modsieve.catalog.validation import COLS, DIRTY_TAGGED, REVIEW_TABLE
from modsieve.functions.text import word_count
from modsieve.keys import number_rows, seeded
from modsieve.operators.clean import dedupe
from modsieve.operators.folds import (
    dealt_kfold,
    extend_train,
    fold_filter,
    fraction_split,
    kfold,
    label_balance,
    length_dealt_folds,
    make_folds,
    multilabel_stratified_kfold,
    sample_fraction,
    split_granularity,
    stratified_holdout,
    stratified_kfold,
)
from modsieve.operators.validate import validate

SEED = 1234


def md5_of(op: str, key: str = "row_id", seed: int = SEED) -> str:
    return f"md5(concat_ws(':', '{seed}', '{op}', {key}))"


@query(
    "number_rows",
    f"""SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {md5_of('number', 'doc_id')}, doc_id) - 1 AS pos,
               count(*) OVER (PARTITION BY lang) AS size FROM documents""",
)
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    return number_rows(documents, ["lang"], seeded(SEED, "number", "doc_id"), ["doc_id"], size="size")


@query(
    "kfold",
    f"""SELECT doc_id, text, CAST((row_number() OVER (ORDER BY {md5_of('fold', 'doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold
        FROM documents""",
)
def _(spark, sf):
    return kfold(table(spark, sf, "documents").select("doc_id", "text"), 5, SEED, ["doc_id"])


def folds_sql(labels: str, n: int, source: str = "reviews", key: str = "row_id") -> str:
    return f"""SELECT *, CAST((row_number() OVER (ORDER BY {labels}, {md5_of('fold', key)}, {key}) - 1) % {n} AS INTEGER) AS fold
               FROM {source}"""


@query("stratified_kfold", with_tables("reviews", f"f AS ({folds_sql('rule_violation', 10)})", "SELECT row_id, rule_violation, body, fold FROM f"))
def _(spark, sf):
    return stratified_kfold(reviews(spark, sf), "rule_violation", 10, SEED).select("row_id", "rule_violation", "body", "fold")


@query(
    "multilabel_stratified_kfold",
    with_tables("reviews", f"f AS ({folds_sql('rule, rule_violation', 10)})", "SELECT row_id, rule, rule_violation, fold FROM f"),
)
def _(spark, sf):
    folded = dealt_kfold(reviews(spark, sf), ["rule", "rule_violation"], 10, SEED)
    return folded.select("row_id", "rule", "rule_violation", "fold")


TRAITS = 10


def ten_labels(documents):
    """Ten yes/no labels of every document, bits of a hash of its id."""
    number = F.conv(F.substring(F.md5(F.concat(F.lit("trait:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long")
    return documents.select(
        "doc_id", *[F.shiftright(number, i).bitwiseAND(1).cast("int").alias(f"y{i}") for i in range(TRAITS)]
    )


@query(
    "multilabel_balance",
    f"""WITH t AS (SELECT doc_id, ('0x' || substr(md5('trait:' || doc_id), 1, 8))::BIGINT AS number FROM documents),
    v AS (SELECT 'y' || i AS label, CAST((number >> i) & 1 AS VARCHAR) AS value FROM t, range({TRAITS}) r(i)
          UNION ALL SELECT '*', '' FROM t),
    s AS (SELECT label, value, count(*) AS n_rows FROM v GROUP BY label, value)
    SELECT label, value, n_rows, unnest(range(10)) AS place, n_rows // 10 + CASE WHEN unnest(range(10)) >= 10 - n_rows % 10 THEN 1 ELSE 0 END AS n FROM s""",
)
def _(spark, sf):
    """Each label value's counts in ten folds, smallest first: whole shares, rounded down or up."""
    labels = [f"y{i}" for i in range(TRAITS)]
    folded = multilabel_stratified_kfold(ten_labels(table(spark, sf, "documents")), labels, 10, SEED, ["doc_id"])
    counts = label_balance(folded, labels, 10)
    placed = counts.select("label", "value", "n_rows", F.posexplode(F.array_sort("counts")).alias("place", "n"))
    return placed.withColumn("place", F.col("place").cast("long"))


@query(
    "multilabel_cells",
    with_tables(
        "reviews",
        "c AS (SELECT rule, subreddit, rule_violation, count(*) AS n_rows FROM reviews GROUP BY ALL)",
        """SELECT rule, subreddit, rule_violation, n_rows, n_rows // 5 AS least, (n_rows + 4) // 5 AS most FROM c""",
    ),
)
def _(spark, sf):
    """Every combination of three labels lies in each of five folds with its share, rounded down or up."""
    labels = ["rule", "subreddit", "rule_violation"]
    folded = multilabel_stratified_kfold(reviews(spark, sf), labels, 5, SEED)
    counts = folded.groupBy(*labels).pivot("fold", list(range(5))).count().fillna(0, [str(f) for f in range(5)])
    folds = [F.col(str(f)) for f in range(5)]
    return counts.select(*labels, sum(folds[1:], folds[0]).alias("n_rows"), F.least(*folds).alias("least"), F.greatest(*folds).alias("most"))


@query(
    "choose_fold_type",
    with_tables(
        "reviews",
        f"""a AS ({folds_sql('subreddit', 5)}), b AS ({folds_sql('rule, subreddit', 5)}),
            c AS (SELECT *, CAST((row_number() OVER (ORDER BY {md5_of('fold')}, row_id) - 1) % 5 AS INTEGER) AS fold FROM reviews)""",
        """SELECT 'one' AS labels, row_id, fold FROM a UNION ALL SELECT 'two', row_id, fold FROM b
           UNION ALL SELECT 'none', row_id, fold FROM c""",
    ),
)
def _(spark, sf):
    base = reviews(spark, sf)
    made = None
    for name, labels in (("one", ["subreddit"]), ("two", ["rule", "subreddit"]), ("none", None)):
        part = make_folds(base, 5, SEED, labels, search=False).select(F.lit(name).alias("labels"), "row_id", "fold")
        made = part if made is None else made.unionByName(part)
    return made


def _split(spark, sf, train, valid):
    n = split_granularity([train, valid])
    folded = dealt_kfold(reviews(spark, sf), ["rule", "rule_violation"], n, SEED)
    return fraction_split(folded, train, valid, n)


SPLIT_COLS = ["row_id", "rule", "rule_violation", "body"]


@query(
    "fraction_split_wrapped",
    with_tables(
        "reviews",
        f"f AS ({folds_sql('rule, rule_violation', 10)})",
        """SELECT 'train' AS part, row_id, rule, rule_violation, body FROM f WHERE fold < 10
           UNION ALL SELECT 'valid', row_id, rule, rule_violation, body FROM f WHERE fold IN (0, 1, 2)""",
    ),
)
def _(spark, sf):
    train, valid, _ = _split(spark, sf, 1, 0.3)
    return train.select(F.lit("train").alias("part"), *SPLIT_COLS).unionByName(
        valid.select(F.lit("valid").alias("part"), *SPLIT_COLS)
    )


@query(
    "fraction_split_fine",
    with_tables(
        "reviews",
        f"f AS ({folds_sql('rule, rule_violation', 100)})",
        """SELECT 'train' AS part, row_id, rule, rule_violation, body FROM f WHERE fold < 1
           UNION ALL SELECT 'valid', row_id, rule, rule_violation, body FROM f WHERE fold BETWEEN 1 AND 30""",
    ),
)
def _(spark, sf):
    train, valid, _ = _split(spark, sf, 0.01, 0.3)
    return train.select(F.lit("train").alias("part"), *SPLIT_COLS).unionByName(
        valid.select(F.lit("valid").alias("part"), *SPLIT_COLS)
    )


@query(
    "fraction_split_overlap",
    with_tables("reviews", f"f AS ({folds_sql('rule, rule_violation', 10)})", "SELECT count(*) FILTER (WHERE fold IN (0, 1, 2)) AS overlap FROM f"),
)
def _(spark, sf):
    return _split(spark, sf, 1, 0.3)[2]


@query(
    "fold_filter",
    with_tables(
        "reviews",
        f"f AS ({folds_sql('rule_violation', 5)})",
        "SELECT row_id, body, rule, rule_violation, fold, CASE WHEN fold = 2 THEN 'valid' ELSE 'train' END AS part FROM f",
    ),
)
def _(spark, sf):
    folded = stratified_kfold(reviews(spark, sf), "rule_violation", 5, SEED)
    train, valid = fold_filter(folded, 2, 5)
    keep = ["row_id", "body", "rule", "rule_violation", "fold"]
    return train.select(*keep, F.lit("train").alias("part")).unionByName(valid.select(*keep, F.lit("valid").alias("part")))


@query(
    "stratified_holdout",
    f"""SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {md5_of('holdout', 'doc_id')}, doc_id)
               <= round(count(*) OVER (PARTITION BY lang) * 0.2::DOUBLE) AS held_out FROM documents""",
)
def _(spark, sf):
    return stratified_holdout(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], 0.2, SEED, ["doc_id"])


@query(
    "length_dealt_folds",
    r"""SELECT doc_id, token_length, CAST((row_number() OVER (ORDER BY token_length, md5(concat_ws(':', '1234', 'length', doc_id)), doc_id) - 1) % 20 AS INTEGER) AS fold
        FROM (SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\t-\r\x1c-\x20\x{85}\p{Z}]+')) AS INTEGER) AS token_length FROM documents)""",
)
def _(spark, sf):
    documents = table(spark, sf, "documents")
    folded = length_dealt_folds(documents, word_count(F.col("text")), 20, SEED, ["doc_id"])
    return folded.select("doc_id", "token_length", "fold")


@query(
    "sample_fraction",
    f"""SELECT doc_id, text, lang FROM (
            SELECT *, row_number() OVER (ORDER BY {md5_of('sample', 'doc_id')}, doc_id) AS rn, count(*) OVER () AS n FROM documents)
        WHERE rn <= round(n * 0.3::DOUBLE)""",
)
def _(spark, sf):
    return sample_fraction(table(spark, sf, "documents").select("doc_id", "text", "lang"), 0.3, SEED, ["doc_id"])


@query(
    "sample_fraction_scan",
    f"""SELECT doc_id, text, lang FROM documents
        WHERE ('0x' || substr({md5_of('sample', 'doc_id')}, 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.3::DOUBLE""",
)
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return sample_fraction(documents, 0.3, SEED, ["doc_id"], exact=False)


@query(
    "extend_train",
    with_tables(
        "reviews reviews_test",
        f"""t AS (SELECT *, row_number() OVER (ORDER BY {md5_of('sample')}, row_id) AS rn, count(*) OVER () AS n FROM reviews_test)""",
        """SELECT row_id, body, rule, rule_violation FROM reviews
           UNION ALL SELECT row_id, body, rule, rule_violation FROM t WHERE rn <= round(n * 0.25::DOUBLE)""",
    ),
)
def _(spark, sf):
    keep = ["row_id", "body", "rule", "rule_violation"]
    return extend_train(reviews(spark, sf).select(keep), reviews_test(spark, sf).select(keep), 0.25, SEED)


@query(
    "violation_rate_by_fold",
    with_tables(
        "reviews_dirty",
        DIRTY_TAGGED
        + f""", clean AS (SELECT * FROM tagged WHERE reject_reason IS NULL),
        f AS ({folds_sql('rule, rule_violation', 10, 'clean')})""",
        """SELECT rule, fold, count(*) AS n_rows, round(avg(rule_violation), 6) AS violation_rate FROM f GROUP BY rule, fold""",
    ),
)
def violation_rate_by_fold(spark, sf):
    """After cleaning, how is each rule's violation rate spread over ten stratified folds?"""
    valid = validate(reviews_dirty(spark, sf).select(COLS), REVIEW_TABLE, ["row_id"]).valid
    clean = dedupe(valid, ["rule", "body"], ["row_id"])
    folded = dealt_kfold(clean, ["rule", "rule_violation"], 10, SEED)
    return folded.groupBy("rule", "fold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("rule_violation"), 6).alias("violation_rate")
    )

