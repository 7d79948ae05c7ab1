"""Queries: prompts, messages, completions, pseudo-labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from modsieve.catalog.fixtures import reviews, reviews_dirty, reviews_examples, reviews_test, table, texts, with_tables
from modsieve.catalog.registry import query
from modsieve.functions import prompts
from modsieve.operators.labels import (
    add_pseudo_labelled,
    pseudo_label,
    truncate_prompt,
    truncation_report,
    with_completion,
    with_prompt,
)

SPACE_SQL = r"\t-\r\x1c-\x20\x{85}\p{Z}"


def strip_sql(col: str) -> str:
    return f"regexp_replace({col}, '^[{SPACE_SQL}]+|[{SPACE_SQL}]+$', '', 'g')"


@query("pair_prompt", with_tables("reviews_dirty", "", "SELECT row_id, rule || '[SEP]' || body AS prompt FROM reviews_dirty"))
def _(spark, sf):
    return with_prompt(reviews_dirty(spark, sf), prompts.pair_prompt()).select("row_id", "prompt")


FEW_SHOT = (
    "'\n" + prompts.TASK + "\n\nr/' || subreddit || '\nRule: ' || rule || '\n\n1) ' || positive_example_1 || '\nViolation: YES\n\n2) '"
    " || negative_example_1 || '\nViolation: NO\n\n3) ' || positive_example_2 || '\nViolation: YES\n\n4) ' || negative_example_2"
    " || '\nViolation: NO\n\n5) ' || body || '\nViolation: '"
)


@query("few_shot_prompt", with_tables("reviews_examples", "", f"SELECT row_id, {FEW_SHOT} AS prompt FROM reviews_examples"))
def _(spark, sf):
    return with_prompt(reviews_examples(spark, sf), prompts.few_shot_prompt()).select("row_id", "prompt")


CHAT = [
    ("system", strip_sql("'" + prompts.CHAT_TASK + "\nRule : ' || " + strip_sql("rule"))),
    ("user", strip_sql("positive_example_1")),
    ("assistant", "'YES'"),
    ("user", strip_sql("negative_example_1")),
    ("assistant", "'NO'"),
    ("user", strip_sql("positive_example_2")),
    ("assistant", "'YES'"),
    ("user", strip_sql("negative_example_2")),
    ("assistant", "'NO'"),
    ("user", strip_sql("body")),
]


@query(
    "few_shot_messages",
    with_tables(
        "reviews_examples",
        "",
        " UNION ALL ".join(
            f"SELECT row_id, CAST({i} AS INTEGER) AS turn, '{role}' AS role, {content} AS content FROM reviews_examples"
            for i, (role, content) in enumerate(CHAT)
        ),
    ),
)
def _(spark, sf):
    told = reviews_examples(spark, sf).select("row_id", prompts.few_shot_messages().alias("m"))
    return told.select("row_id", F.posexplode("m").alias("turn", "m")).select("row_id", "turn", "m.role", "m.content")


@query(
    "few_shot_chat",
    with_tables(
        "reviews_examples",
        "",
        "SELECT row_id, "
        + " || ".join(f"'<{role}>\n' || {content} || '\n'" for role, content in CHAT)
        + " || '<assistant>\n' AS prompt FROM reviews_examples",
    ),
)
def _(spark, sf):
    rendered = prompts.render_messages(prompts.few_shot_messages())
    return with_prompt(reviews_examples(spark, sf), rendered).select("row_id", "prompt")


ZERO_SHOT = (
    f"'<system>\n{prompts.TASK}Rule : ' || {strip_sql('rule')} || '\n<user>\n' || {strip_sql('body')} || '\n<assistant>\nViolation:'"
)


@query(
    "zero_shot_messages",
    with_tables(
        "texts",
        "",
        f"""SELECT row_id, CAST(0 AS INTEGER) AS turn, 'system' AS role, '{prompts.TASK}Rule : ' || {strip_sql('rule')} AS content FROM texts
            UNION ALL SELECT row_id, 1, 'user', {strip_sql('body')} FROM texts""",
    ),
)
def _(spark, sf):
    told = texts(spark, sf).select("row_id", F.posexplode(prompts.zero_shot_messages()).alias("turn", "m"))
    return told.select("row_id", "turn", "m.role", "m.content")


@query("zero_shot_prompt", with_tables("texts", "", f"SELECT row_id, {ZERO_SHOT} AS prompt FROM texts"))
def _(spark, sf):
    return with_prompt(texts(spark, sf), prompts.zero_shot_prompt()).select("row_id", "prompt")


@query(
    "completion_text",
    with_tables(
        "reviews",
        "",
        f"SELECT row_id, {ZERO_SHOT} || CASE rule_violation WHEN 1 THEN ' Yes' WHEN 0 THEN ' No' END AS prompt FROM reviews",
    ),
)
def _(spark, sf):
    return with_completion(reviews(spark, sf)).select("row_id", "prompt")


WORDS_SQL = f"regexp_extract_all(text, '[^{SPACE_SQL}]+')"


@query(
    "truncate_prompt",
    f"""SELECT doc_id, CASE WHEN len({WORDS_SQL}) > 256 THEN array_to_string(({WORDS_SQL})[1:256], ' ') ELSE text END AS text,
               len({WORDS_SQL}) > 256 AS truncated FROM documents""",
)
def _(spark, sf):
    return truncate_prompt(table(spark, sf, "documents").select("doc_id", "text"), "text", 256)


@query("truncation_report", f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE len({WORDS_SQL}) > 256) AS n_truncated FROM documents")
def _(spark, sf):
    return truncation_report(table(spark, sf, "documents"), "text", 256)


def stand_in_score():
    return (F.col("n_chars") % 97) / F.lit(96.0)


LABEL_SQL = "CASE WHEN score > 1 - 0.2::DOUBLE THEN 1 WHEN score < 0.2::DOUBLE THEN 0 ELSE -1 END"


@query("pseudo_labels", f"SELECT doc_id, {LABEL_SQL} AS rule_violation FROM (SELECT doc_id, (n_chars % 97) / 96.0::DOUBLE AS score FROM documents)")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", pseudo_label(stand_in_score()).alias("rule_violation"))


@query(
    "add_pseudo_labelled",
    with_tables(
        "reviews reviews_test",
        f"scored AS (SELECT *, {LABEL_SQL} AS pseudo FROM (SELECT *, (n_chars % 97) / 96.0::DOUBLE AS score FROM reviews_test))",
        """SELECT row_id, body, rule, rule_violation FROM reviews
           UNION ALL SELECT row_id, body, rule, pseudo FROM scored WHERE pseudo <> -1""",
    ),
)
def _(spark, sf):
    keep = ["row_id", "body", "rule", "rule_violation"]
    test = reviews_test(spark, sf)
    predictions = test.select("row_id", stand_in_score().alias("rule_violation"))
    return add_pseudo_labelled(reviews(spark, sf).select(keep), test.select(keep), predictions)
