"""Seeded text augmentation over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modsieve.functions import text as T
from modsieve.keys import digests, number_rows, seeded, uniform
from modsieve.operators.clean import dedupe
from modsieve.operators.folds import whole_share
from modsieve.spec import COLUMNS

Key = Sequence[str]

# Sizes of the random changes.
URLS_APPENDED = (1, 5)
WORDS_APPENDED = (5, 14)
WORDS_SWAPPED = (3, 10)
LONGEST_SWAPPED = 10
PARTITIONS_PER_COPY = 8
NEGATION = rf"(?:N|n)ot?[{T.SPACE}]+"


def between(hashed: Column, low: Column | int, high: Column | int) -> Column:
    """Whole number in ``low..high`` from a hash."""
    low, high = (F.lit(v) if isinstance(v, int) else v for v in (low, high))
    return (low + F.floor(uniform(hashed) * (high - low + 1))).cast("int")


def shuffled(parts: Column, seed: int, op: str, key: Key) -> Column:
    """The array in hash order; every element is keyed by its place."""
    ranked = F.transform(parts, lambda part, i: F.struct(seeded(seed, op, *key, i).alias("h"), i.alias("i"), part.alias("part")))
    return F.transform(F.array_sort(ranked), lambda r: r["part"])


def distinct_draws(total: Column | str, count: Column | str, most: int, hashed: Callable[[Column], Column]) -> Column:
    """``count`` (at most ``most``) different places below ``total``; none if there are fewer.

    Floyd's sampling: draw ``i`` is uniform below ``total - count + i``, and a repeat
    takes the top place. ``hashed`` gives the hash of draw ``i``. ``total`` and
    ``count`` should be columns of the table, as every draw reads them.
    """
    total, count = (F.col(c) if isinstance(c, str) else c for c in (total, count))
    free = total - count

    def draw(i: Column) -> Column:
        return F.floor(uniform(hashed(i)) * (free + i))

    drawn = F.transform(F.sequence(F.lit(1), F.lit(most)), lambda i: F.struct(i.alias("i"), draw(i).alias("place")))
    taken = F.aggregate(
        F.filter(drawn, lambda d: d["i"] <= count),
        F.array().cast("array<bigint>"),
        lambda places, d: F.array_append(
            places, F.when(F.array_contains(places, d["place"]), free + d["i"] - 1).otherwise(d["place"])
        ),
    )
    return F.when(free >= 0, taken).otherwise(F.array().cast("array<bigint>"))


def sentence_shuffle(df: DataFrame, col: str, seed: int, key: Key) -> DataFrame:
    """Cut at sentence ends and line breaks, shuffle, join with ``". "``."""
    parts = F.split(F.col(col), rf"(?:\.[{T.SPACE}]|\n)+", -1)
    return df.withColumn(col, F.array_join(shuffled(parts, seed, "sentence", key), ". "))


def append_random_words(df: DataFrame, col: str, seed: int, key: Key) -> DataFrame:
    """Append 5-14 of the text's own words in random order, right after its last character."""
    most = WORDS_APPENDED[1]
    cut = df.withColumn("__words", F.split(F.col(col), rf"[{T.SPACE}]+", -1)).withColumn("__n", F.size("__words"))
    wanted = between(seeded(seed, "words", *key), *WORDS_APPENDED)
    cut = cut.withColumn("__k", F.least(F.col("__n"), wanted))
    places = distinct_draws("__n", "__k", most, lambda i: seeded(seed, "word", *key, i))
    ordered = F.array_sort(
        F.transform(places, lambda p: F.struct(seeded(seed, "word order", *key, p).alias("h"), p.alias("p")))
    )
    words = F.transform(ordered, lambda r: F.get("__words", r["p"]))
    return cut.withColumn(col, F.concat(col, F.array_join(words, " "))).select(df.columns)


def url_clean(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, T.url_clean(F.col(col)))


def url_semantics(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, T.url_semantics(F.col(col)))


def url_bank(df: DataFrame, col: str, key: Key) -> DataFrame:
    """Every URL occurrence of the corpus with the row and the place it stands in."""
    return df.select(*key, F.posexplode(T.urls(F.col(col))).alias("slot", "url"))


def append_random_urls(df: DataFrame, col: str, bank: DataFrame, seed: int, key: Key) -> DataFrame:
    """Append 1-5 URLs from different places of the bank; unchanged if the bank has fewer.

    ``bank`` has ``url`` and identifying columns; its rows are numbered, and each
    text draws numbers. Only the drawn numbers travel to the bank.
    """
    ids = [c for c in bank.columns if c != "url"]
    cards = number_rows(bank, [], seeded(seed, "bank", *ids), ids, out="__place").select("__place", "url")
    total = bank.agg(F.count(F.lit(1))).scalar()
    drawn = df.select(*key, total.alias("__total")).withColumn(
        "__k", between(seeded(seed, "urls", *key), *URLS_APPENDED).cast("long")
    )
    places = distinct_draws("__total", "__k", URLS_APPENDED[1], lambda i: seeded(seed, "url", *key, i))
    draws = drawn.select(*key, F.posexplode(places).alias("__slot", "__place"))
    ordered = F.array_sort(F.collect_list(F.struct("__slot", "url")))  # at most five per row
    tails = draws.join(cards, "__place").groupBy(*key).agg(ordered.alias("__urls"))
    tail = F.array_join(F.transform("__urls", lambda u: u["url"]), " ")
    joined = df.join(tails, list(key), "left")
    return joined.withColumn(
        col, F.when(F.col("__urls").isNotNull(), F.concat(F.col(col), F.lit(" "), tail)).otherwise(F.col(col))
    ).select(df.columns)


def phonetic_swap(df: DataFrame, col: str, lexicon: DataFrame, seed: int, key: Key) -> DataFrame:
    """3-10 random words (fewer in shorter texts) become their pronunciation.

    Words of more than ten characters and unknown words stay. ``lexicon`` has rows of a
    lower-case ``word`` and its ``phones``; of several, the first by ``place`` counts if there
    is such a column, else the first in alphabetical order. Only the chosen words leave the
    row to meet it, spread over several copies of the lexicon, as few words make up most texts.
    """
    words = F.split(F.col(col), rf"[{T.SPACE}]+", -1)
    low, high = WORDS_SWAPPED
    size = F.size("__words")
    count = between(seeded(seed, "swaps", *key), F.least(F.lit(low), size), F.least(F.lit(high), size))
    places = distinct_draws("__n", "__k", high, lambda i: seeded(seed, "swap", *key, i))
    drawn = F.transform(places, lambda p: F.struct(p.cast("int").alias("__i"), F.get("__words", p).alias("__word")))
    picks = (
        df.filter(F.col(col).isNotNull())
        .select(*key, words.alias("__words"))
        .withColumn("__n", size)
        .withColumn("__k", count)
        .select(*key, drawn.alias("__picks"))  # at most ten words go on, never the text
        .select(*key, F.inline_outer("__picks"))
        .filter(F.char_length("__word") <= LONGEST_SWAPPED)
        .select(*key, "__i", F.lower("__word").alias("word"))
    )
    sound = F.lower(F.regexp_replace("phones", rf"[{T.SPACE}\p{{Nd}}]", ""))
    order = F.struct("place", "phones") if "place" in lexicon.columns else F.struct("phones")
    single = lexicon.groupBy("word").agg(F.min(order)["phones"].alias("phones"))
    # Some copies for each share of the partitions, so a word that makes up much of the texts is no single task's.
    copies = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_COPY)
    salts = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__salt")
    known = single.select("word", sound.alias("__sound"), salts)
    salt = F.pmod(F.xxhash64(*key, "__i"), F.lit(copies)).cast("int")
    swaps = (
        picks.withColumn("__salt", salt)
        .join(known, ["word", "__salt"])
        .groupBy(*key)
        .agg(F.map_from_entries(F.collect_list(F.struct("__i", "__sound"))).alias("__swaps"))  # at most ten
    )
    rebuilt = F.transform(words, lambda w, i: F.coalesce(F.try_element_at("__swaps", i), w))
    return df.join(swaps, list(key), "left").withColumn(col, F.array_join(rebuilt, " ")).select(df.columns)


def rule_flip(df: DataFrame, rule: str = COLUMNS.rule, label: str = COLUMNS.label) -> DataFrame:
    """Negate the rule by deleting its "no"/"not", and turn the label."""
    changed = {rule: F.regexp_replace(rule, NEGATION, "")}
    if label in df.columns:
        changed[label] = (1 - F.col(label)).cast(df.schema[label].dataType)
    if "flip" in df.columns:
        changed["flip"] = F.lit(1)
    return df.withColumns(changed)


@dataclass(frozen=True)
class Context:
    """What an operation may need beside the table."""

    seed: int
    key: Key = (COLUMNS.key,)
    body: str = COLUMNS.body
    bank: DataFrame | None = None
    lexicon: DataFrame | None = None


@dataclass(frozen=True)
class Operation:
    apply: Callable[[DataFrame, Context], DataFrame]


def _with_bank(df: DataFrame, c: Context) -> DataFrame:
    if c.bank is None:
        raise ValueError("appending URLs needs a bank")
    return append_random_urls(df, c.body, c.bank, c.seed, c.key)


# The names under which the operations are configured.
OPERATIONS: dict[str, Operation] = {
    "url_cleaner": Operation(lambda df, c: url_clean(df, c.body)),
    "url_to_semantics": Operation(lambda df, c: url_semantics(df, c.body)),
    "random_url": Operation(_with_bank),
    "transileration": Operation(lambda df, c: phonetic_swap(df, c.body, c.lexicon, c.seed, c.key)),
    "sentence_shuffle": Operation(lambda df, c: sentence_shuffle(df, c.body, c.seed, c.key)),
    "random_gen_sentence": Operation(lambda df, c: append_random_words(df, c.body, c.seed, c.key)),
    "rule_flip": Operation(lambda df, c: rule_flip(df)),
}


def share(value: float | int) -> float:
    """A fraction; a whole number means percent."""
    return value / 100 if isinstance(value, int) else value


def apply_with_probability(df: DataFrame, name: str, p: float | int, context: Context) -> DataFrame:
    """Apply a named operation to a random share ``p`` of the rows; the others are not worked on.

    Without a bank, URLs come from all rows of the table as given.
    """
    operation, p = OPERATIONS[name], share(p)
    if name == "random_url" and context.bank is None:
        context = replace(context, bank=url_bank(df, context.body, context.key))
    if p >= 1:
        return operation.apply(df, context)
    hit = uniform(seeded(context.seed, f"apply {name}", *context.key)) < F.lit(float(p))
    changed = operation.apply(df.filter(hit), context).select(df.columns)
    return changed.unionByName(df.filter(~hit))


def augment(
    df: DataFrame,
    operations: Sequence[tuple[str, float | int]],
    context: Context,
    *,
    frac: float | int = 1.0,
    resample: int = 1,
    include_original: bool = True,
    weight: float = 1.0,
    tta: bool = False,
) -> DataFrame:
    """Augmented copies of the table, each through all operations in order.

    With the originals kept, every copy is sampled to ``frac``. Output: the
    input's columns and ``copy`` (0 is the original), one row per (rule, body),
    the originals first. Without a bank, appended URLs come from the table as given.
    """
    keyed, copies = _copies(df, operations, context, resample)
    if tta and "weight" in df.columns:
        copies = copies.withColumn("weight", F.lit(float(weight) / resample))
    if include_original:
        copies = df.withColumn("copy", F.lit(0)).unionByName(_sampled(copies, keyed, frac))
    return dedupe(copies, [COLUMNS.rule, context.body], ["copy", *context.key])


def _copies(df: DataFrame, operations: Sequence[tuple[str, float | int]], context: Context, resample: int) -> tuple[Context, DataFrame]:
    """The copies after all operations, and the context that tells them apart."""
    if context.bank is None and any(name == "random_url" for name, _ in operations):
        context = replace(context, bank=url_bank(df, context.body, context.key))
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(resample))))
    keyed = replace(context, key=[*context.key, "copy"])
    for name, p in operations:
        copies = apply_with_probability(copies, name, p, keyed)
    return keyed, copies


def _sampled(copies: DataFrame, keyed: Context, frac: float | int) -> DataFrame:
    """The share ``frac`` of each copy."""
    if share(frac) >= 1:
        return copies
    hashed = seeded(keyed.seed, "resample", *keyed.key)
    numbered = number_rows(copies, ["copy"], hashed, [k for k in keyed.key if k != "copy"], out="__pos", size="__size")
    wanted = F.col("__pos") < whole_share(F.col("__size"), share(frac))
    return numbered.filter(wanted).select(copies.columns)


def new_copies(
    df: DataFrame, operations: Sequence[tuple[str, float | int]], context: Context, *, frac: float | int = 1.0, resample: int = 1
) -> DataFrame:
    """The rows of ``augment`` (originals kept) that are no originals.

    Originals are told from copies by digests and never move; a copy that no operation changed
    equals its original, so only its key is numbered.
    """
    texts = [COLUMNS.rule, context.body]
    marks = digests(df, texts)
    given = df.select("*", F.struct(*marks).alias("__given"))
    keyed, copies = _copies(given, operations, context, resample)
    changed = ~F.struct(*digests(df, texts)).eqNullSafe(F.col("__given"))
    copies = copies.withColumn("__changed", changed).withColumn(context.body, F.when(F.col("__changed"), F.col(context.body)))
    copies = _sampled(copies.drop("__given"), keyed, frac).filter("__changed").drop("__changed")
    first = ["copy", *context.key]
    rest = [c for c in copies.columns if c not in first]
    nothing = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    originals = df.select(*marks).select("*", *nothing, F.lit(0).alias("copy"))
    both = originals.unionByName(copies.select("*", *digests(copies, texts)))
    found = both.groupBy("__d0", "__d1").agg(F.min(F.struct(*first, *rest)).alias("first")).filter("first.copy > 0")
    return found.select(*[F.col("first")[c].alias(c) for c in copies.columns])
