"""Augmentation and prompts, with expected values written by hand."""

import pytest
from pyspark.sql import functions as F

from modsieve.functions import prompts
from modsieve.functions import text as T
from modsieve.operators import augment as A
from modsieve.operators.labels import add_pseudo_labelled, pseudo_label, truncate_prompt

CLEANED = [
    ("https://www.Example.com/a/b/c?x=1#y end", "<url>: (example.com/a/b) end"),
    ("at end http://x.org", "at end <url>: (x.org)"),
    ("http://x.org/ and http://y.org//q", "<url>: (x.org) and <url>: (y.org/q)"),
    ("(https://u:p@host:8080/p;v=1/q;z=2)", "(<url>: (u:p@host:8080/p;v=1/q)"),
    ("http://a／b.org/x", "<url>: (unknown)"),
    ("http://x.org?q=a/b", "<url>: (x.org)"),
    ("ftp://x.org no url", "ftp://x.org no url"),
    ("漢字 https://é.org/ü", "漢字 <url>: (é.org/ü)"),
    ("", ""),
    (None, None),
]
SEMANTIC = [
    ("see http://a.b-c.co.uk/x/y_z.html?q=1 now", "see domain:a domain:b-c domain:co path:xpath:ypath:z now"),
    ("https://www.example.com", "domain:www domain:example"),
    ("https://Example.com/News/2024", "domain:example path:newspath:2024"),
    ("http://localhost/x.html", "domain:x path:localhostpath:xpath:html"),
    ("no url", "no url"),
    (None, None),
]


def column(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, body string")
    return [r.out for r in df.select("row_id", make(F.col("body")).alias("out")).orderBy("row_id").collect()]


def test_url_clean(spark):
    assert column(spark, [t for t, _ in CLEANED], T.url_clean) == [w for _, w in CLEANED]


def test_url_semantics(spark):
    assert column(spark, [t for t, _ in SEMANTIC], T.url_semantics) == [w for _, w in SEMANTIC]


def frame(spark, texts):
    return spark.createDataFrame([(i, "No spam", t, 1) for i, t in enumerate(texts)], "row_id long, rule string, body string, rule_violation int")


def bodies(df):
    return [r.body for r in df.orderBy("row_id").collect()]


def test_sentence_shuffle_keeps_the_sentences(spark):
    text = "One is. Two is.\nThree is\n\nFour"
    (got,) = bodies(A.sentence_shuffle(frame(spark, [text]), "body", 1, ["row_id"]))
    assert sorted(got.split(". ")) == ["Four", "One is", "Three is", "Two is"]


def test_append_random_words(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 3, 40)]
    for text, got in zip(texts, bodies(A.append_random_words(frame(spark, texts), "body", 1, ["row_id"]))):
        assert got.startswith(text)
        added = got[len(text):].split(" ")
        assert len(added) == len(set(added)) and set(added) <= set(text.split(" "))
        assert min(5, len(text.split())) <= len(added) <= 14


def test_random_urls_are_distinct_bank_places(spark):
    texts = [f"see http://h{i}.org/x" for i in range(30)] + [None, "none"]
    df = frame(spark, texts)
    bank = A.url_bank(df, "body", ["row_id"])
    for text, got in zip(texts, bodies(A.append_random_urls(df, "body", bank, 1, ["row_id"]))):
        if text is None:
            assert got is None
            continue
        added = got[len(text) + 1:].split(" ")
        assert got.startswith(text + " ") and 1 <= len(added) <= 5 and len(set(added)) == len(added)
        assert all(u.startswith("http://h") for u in added)


def test_bank_smaller_than_the_draw_changes_nothing(spark):
    df = frame(spark, ["plain"])
    empty = A.url_bank(df, "body", ["row_id"])
    assert bodies(A.append_random_urls(df, "body", empty, 1, ["row_id"])) == ["plain"]


def test_phonetic_swap(spark):
    lexicon = spark.createDataFrame([("cat", "K AE1 T"), ("unbelievable", "X")], "word string, phones string")
    texts = ["Cat cat CAT", "unbelievable", "dog", ""]
    got = bodies(A.phonetic_swap(frame(spark, texts), "body", lexicon, 1, ["row_id"]))
    assert got == ["kaet kaet kaet", "unbelievable", "dog", ""]


def test_rule_flip(spark):
    df = spark.createDataFrame([(1, "No ads, not here, piano x", 1, 0)], "row_id long, rule string, rule_violation int, flip int")
    assert tuple(A.rule_flip(df).first()) == (1, "ads, here, piax", 0, 1)


def test_probability_zero_and_one(spark):
    df = frame(spark, [f"http://h{i}.org/x" for i in range(50)])
    context = A.Context(1)
    assert bodies(A.apply_with_probability(df, "url_cleaner", 0, context)) == bodies(df)
    assert all(b.startswith("<url>") for b in bodies(A.apply_with_probability(df, "url_cleaner", 100, context)))
    some = sum(b.startswith("<url>") for b in bodies(A.apply_with_probability(df, "url_cleaner", 0.5, context)))
    assert 10 < some < 40


@pytest.mark.parametrize("name", sorted(A.OPERATIONS))
def test_every_operation_takes_a_share(spark, name):
    df = frame(spark, [f"Some words. More of http://h{i}.org/x them" for i in range(20)])
    lexicon = spark.createDataFrame([("some", "S AH1 M")], "word string, phones string")
    out = A.apply_with_probability(df, name, 0.5, A.Context(1, lexicon=lexicon))
    assert out.columns == df.columns and out.count() == 20


def test_augment_keeps_originals_first(spark):
    df = frame(spark, ["a b", "http://x.org/p"])
    out = A.augment(df, [("url_cleaner", 1.0)], A.Context(1), resample=2)
    assert {(r.row_id, r.copy, r.body) for r in out.collect()} == {(0, 0, "a b"), (1, 0, "http://x.org/p"), (1, 1, "<url>: (x.org/p)")}
    only = A.augment(df, [("url_cleaner", 1.0)], A.Context(1), include_original=False)
    assert {r.copy for r in only.collect()} == {1}


def test_prompts(spark):
    df = spark.createDataFrame(
        [(" R ", "sub", " B\n", "p1", "n1", "p2", "n2 ", 1)],
        "rule string, subreddit string, body string, positive_example_1 string, negative_example_1 string, positive_example_2 string, negative_example_2 string, rule_violation int",
    )
    row = df.select(
        prompts.pair_prompt().alias("pair"),
        prompts.few_shot_prompt().alias("few"),
        prompts.few_shot_messages().alias("chat"),
        prompts.zero_shot_prompt().alias("zero"),
        prompts.completion_text(F.lit("x"), F.col("rule_violation")).alias("done"),
    ).first()
    assert row.pair == " R [SEP] B\n" and row.done == "x Yes"
    assert row.few.startswith("\nYou are given a comment from reddit") and row.few.endswith("5)  B\n\nViolation: ")
    assert "\n\n2) n1\nViolation: NO\n\n3) p2\nViolation: YES\n\n" in row.few
    assert [(m.role, m.content) for m in row.chat][1:] == [
        ("user", "p1"), ("assistant", "YES"), ("user", "n1"), ("assistant", "NO"), ("user", "p2"), ("assistant", "YES"),
        ("user", "n2"), ("assistant", "NO"), ("user", "B"),
    ]
    assert row.chat[0].content.endswith("Only respond YES or NO.\nRule : R")
    assert "Only respond YES or NO.Rule : R" in row.zero and row.zero.endswith("Violation:")


def test_a_missing_example_makes_no_prompt(spark):
    df = spark.createDataFrame(
        [("r", "s", "b", "p1", "n1", None, "n2")],
        "rule string, subreddit string, body string, positive_example_1 string, negative_example_1 string, positive_example_2 string, negative_example_2 string",
    )
    row = df.select(prompts.few_shot_prompt().alias("few"), prompts.render_messages(prompts.few_shot_messages()).alias("chat")).first()
    assert row.few is None and row.chat is None


def test_truncation(spark):
    df = spark.createDataFrame([("a  b\tc",), ("a",), (None,)], "body string")
    assert [tuple(r) for r in truncate_prompt(df, "body", 2).collect()] == [("a b", True), ("a", False), (None, None)]


def test_pseudo_labels(spark):
    df = spark.createDataFrame([(0.81,), (0.8,), (0.5,), (0.2,), (0.19,)], "p double")
    assert [r[0] for r in df.select(pseudo_label(F.col("p"))).collect()] == [1, -1, -1, -1, 0]
    train = spark.createDataFrame([(1, "a", 0)], "row_id long, body string, rule_violation int")
    test = spark.createDataFrame([(2, "b"), (3, "c")], "row_id long, body string").withColumn("rule_violation", F.lit(None).cast("int"))
    preds = spark.createDataFrame([(2, 0.9), (3, 0.5), (4, 0.1)], "row_id long, rule_violation double")
    got = add_pseudo_labelled(train, test, preds).collect()
    assert {tuple(r) for r in got} == {(1, "a", 0), (2, "b", 1), (4, None, 0)}
