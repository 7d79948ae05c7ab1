"""Words of the mix, counted in batches."""

import re

from pyspark.sql import functions as F

from modsieve.llm import mixing


def test_words_of_a_mix(spark):
    texts = ["", None, " ", "a", "\ta  b\xa0c\r\nd ", "é\x0b東京 \x1cx", "last "] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(1)
    found = df.select("t", mixing.tokens(F.col("t")).alias("n")).collect()
    assert all(r.n == len(re.findall(r"[^\x09-\x0D\x20]+", r.t or "")) for r in found)
    plan = df.select(mixing.tokens(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
