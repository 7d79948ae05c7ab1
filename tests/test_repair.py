"""Repair of wrongly decoded text, sketches of the vocabulary and of frequent words."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modsieve.functions.repair import damage_decoding, repair_decoding
from modsieve.operators import clean, profile

SOUND = [
    "", "plain", "Élan naïf à l'œuvre, où ça? «CAFÉ» « é » voilà\u00a0» café\u00a0» 20\u00a0°C",
    "Das „Ä“ und „Ö“, ß, PÅ” SÃO NÃO à «\u00a0fin\u00a0»", "naïve façade · ½ × ¾", "Ελλάδα, Россия, 日本語, 한국어, 🙂 é", "€ 5 – “quoted” ‘too’…",
]
WRONG = [
    ("cafÃ© crÃ¨me", "café crème"), ("itâ€™s â€œfineâ€\u009d â€“ reallyâ€¦", "it’s “fine” – really…"), ("5 â‚¬, Â£3, Â½, 20Â\xa0Â°C", "5 €, £3, ½, 20\xa0°C"),
    ("ï»¿start", "\ufeffstart"), ("ok ðŸ™‚ ok", "ok 🙂 ok"), ("Ð Ð¾ÑÑÐ¸Ñ".replace(" ", "\xa0").replace("ÑÑ", "Ñ\x81Ñ\x81") + "\x8f", "Россия"),
    ("æ—¥æœ¬èªž", "日本語"), ("cafÃƒÂ©", "café"), ("Ã‰tÃ© Ã\xa0 Ãœber StraÃŸe", "Été à Über Straße"),
]


def test_sound_text_stays(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*SOUND, None])], "i int, t string")
    got = {r.i: r.r for r in df.select("i", repair_decoding(F.col("t")).alias("r")).collect()}
    assert got == dict(enumerate([*SOUND, None]))


def test_wrong_text_is_restored(spark):
    df = spark.createDataFrame([(i, w) for i, (w, _) in enumerate(WRONG)], "i int, t string")
    got = {r.i: r.r for r in df.select("i", repair_decoding(F.col("t")).alias("r")).collect()}
    assert got == {i: right for i, (_, right) in enumerate(WRONG)}


def test_round_trip_of_words(spark):
    words = ["Größe", "ÇA", "señor", "naïve", "Привет", "κόσμε", "中文字", "🙂🙃", "“so”", "—", "Łódź", "Ærø"]
    rng = random.Random(2)
    texts = [" ".join(rng.choices(words, k=6)) for _ in range(50)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("w", damage_decoding(F.col("t")))
    rows = df.select("t", "w", repair_decoding(F.col("w")).alias("r")).collect()
    assert all(r.w != r.t and r.r == r.t for r in rows)


def test_washing_repairs_first(spark):
    df = spark.createDataFrame([(1, "cafÃ© http://x.org/a"), (2, "café http://y.org")], "row_id long, body string")
    washed = clean.wash_text(df, dedupe_on=["body"])
    assert [tuple(r) for r in washed.collect()] == [(1, "cafe <URL>")]
    kept = clean.wash_text(df, repair=False, to_ascii=False).orderBy("row_id").first()
    assert kept.body == "cafÃ© <URL>"


def test_vocabulary_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("side"), F.concat_ws(" ", F.lit("a"), (F.col("id") % 7000).cast("string")).alias("t"))
    parts = profile.vocabulary_sketch(df, "t", ["side"], precision=14)
    row = profile.vocabulary_estimate(parts).first()
    assert row.total_vocabs == 40_000 and row.total_unique_vocabs == pytest.approx(7001, rel=0.03)
    assert row.uniqueness == pytest.approx(100 * 7001 / 40_000, rel=0.03)
    by = {r.side: r.total_unique_vocabs for r in profile.vocabulary_estimate(parts, ["side"]).collect()}
    assert by[0] == pytest.approx(3501, rel=0.03)
    none = profile.vocabulary_estimate(profile.vocabulary_sketch(df.limit(0), "t")).first()
    assert (none.total_vocabs, none.total_unique_vocabs, none.uniqueness) == (0, 0, None)


def test_heavy_terms_are_exact_or_refused(spark):
    rng = random.Random(9)
    words = [f"w{int(rng.paretovariate(0.9))}" for _ in range(30_000)]
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(4)
    want = sorted(Counter(words).items(), key=lambda p: (-p[1], p[0]))[:20]
    for tracked in (100_000, 2_000):
        found = profile.heavy_terms(df, 20, tracked=tracked)
        assert sorted(map(tuple, found.collect()), key=lambda p: (-p[1], p[0])) == want
    flat = spark.range(50_000).select(F.col("id").cast("string").alias("word"))
    assert profile.heavy_terms(flat, 20, tracked=1_000) is None
    plain = profile.top_terms(flat.withColumnRenamed("word", "t"), "t", [], 5, sketch=True)
    assert [tuple(r) for r in plain.collect()] == [("0", 1), ("1", 1), ("10", 1), ("100", 1), ("1000", 1)]
    few = spark.createDataFrame([("a",), ("b",), ("a",)], "word string")
    assert sorted(map(tuple, profile.heavy_terms(few, 20).collect())) == [("a", 2), ("b", 1)]
    assert profile.heavy_terms(few.limit(0), 20) is None
