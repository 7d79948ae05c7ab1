"""Registered queries of this package; each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modsieve.llm import fm_index, oracles, suffix_array
from modsieve.llm.bond import hard_negatives
from modsieve.llm.decontaminate import contamination
from modsieve.llm.embedding import embedding_links
from modsieve.llm.html_text import extract_text
from modsieve.llm.jaccard import jaccard_classes
from modsieve.llm.lexical import ranked_search
from modsieve.llm.licences import scan_licences
from modsieve.llm.maxscore import top_k
from modsieve.llm.mixing import mix
from modsieve.llm.quality import judge
from modsieve.llm.secrets import BASE_KINDS, find_secrets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.SQL)


def register(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(text) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


@register
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole document, with a digest of the plain patterns' spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans) -> F.Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
        )

    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        digest(listed(base)).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        (F.size("secrets") - F.size(base)).cast("long").alias("n_structural"),
    )


@register
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every whole document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest(F.array_join("items", ",")).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


@register
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior of every document, with its site's and path's rates of poor documents."""
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "source", "lang", "__v.*")


@register
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of every document in a mix of one corpus length."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "__m.*")


@register
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 4-word shingles agree to 85 percent."""
    return jaccard_classes(table(spark, sf_dir, "documents"))


@register
def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings."""
    return embedding_links(table(spark, sf_dir, "embeddings"))


@register
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document, laid out as files ``source/lang/shelf/doc_id``."""
    documents = table(spark, sf_dir, "documents")
    shelf = F.floor(F.col("doc_id") / 100).cast("string")
    path = F.concat_ws("/", "source", "lang", shelf, F.col("doc_id").cast("string"))
    found = scan_licences(documents.select(path.alias("path"), "text"))
    return found.select(
        F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"),
        "path", F.array_join("licences", ",").alias("licences"), "score", "origin", "licence_dir",
    )


@register
def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def covered() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])


@register
def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the byte strings of 400 that occur more than once."""
    found = suffix_array.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", covered().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register
def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the windows of 20 words that occur earlier."""
    found = fm_index.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", covered().alias("n_removed"), digest(F.col("kept")).alias("kept_sha256"))


@register
def op11_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    embeddings = table(spark, sf_dir, "embeddings")
    return top_k(embeddings, embeddings.where("vec_id % 20 = 0"), k=20, scale=64)


@register
def op12_bond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives just below the nearest positives of every vector whose id is divisible by 100."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(embeddings, embeddings.where("vec_id % 100 = 0"), scale=256).drop("positive_rank")


@register
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)
