"""Mixing sources to target weights by temperature.

Source shares of all tokens are raised to an exponent and normalised. The exponent (1 keeps
the shares, 0 levels them) is found by sectioning: the largest one whose weights reach the
target entropy, or, if that repeats some source too often, the smallest one that keeps the
repetition limit. Each round evaluates a whole grid of exponents in one aggregation over
the table of sources, so that table never comes to the driver.

The weights are realised as block permutations. A source's documents fall into blocks by
hash; every epoch visits all of its blocks in an order of its own. A source whose budget is
a few times its size gives whole epochs, then a last one that stops where the budget ends:
whole blocks first, and in the block where it ends the documents in hash order. Only that
block's ids are sorted; texts are not shuffled for the others.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modsieve.keys import seeded
from modsieve.session import cut_lineage

SECTIONS = 32
ROUNDS = 5
BLOCK_TOKENS = 1_000_000
# Texts whose words are counted at once.
ROWS = 256


def tokens(text) -> F.Column:
    """Words of a text between white space; none for a null or empty text."""

    @F.arrow_udf("long")
    def words(texts: pa.Array) -> pa.Array:
        space = np.zeros(256, bool)
        space[[*range(9, 14), 32]] = True  # bytes below 128 are whole characters in UTF-8
        found = np.zeros(len(texts), np.int64)
        for at in range(0, len(texts), ROWS):
            part = texts.slice(at, ROWS).fill_null("")
            offsets = np.frombuffer(part.buffers()[1], np.int64 if pa.types.is_large_string(part.type) else np.int32)[part.offset :][: len(part) + 1]
            if offsets[-1] == offsets[0]:
                continue
            blank = space[np.frombuffer(part.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
            offsets = offsets - offsets[0]
            begins = ~blank
            begins[1:] &= blank[:-1]
            heads = offsets[:-1][np.diff(offsets) > 0]
            begins[heads] = ~blank[heads]  # the text before is another one
            found[at : at + len(part)] = np.diff(np.append(0, np.cumsum(begins, dtype=np.int64))[offsets])
        return pa.array(found)

    return words(F.col(text) if isinstance(text, str) else text)


def exponent(sources: DataFrame, budget: float, entropy: float, max_repeat: float) -> float:
    """The exponent for ``sources(n_tokens)``, see above; sources without tokens do not count."""
    total = sources.agg(F.sum("n_tokens").alias("t")).first()["t"] or 0
    if not total:
        return 1.0
    share = sources.where("n_tokens > 0").select((F.col("n_tokens") / F.lit(total)).alias("p"))

    def facts(points: list[float]) -> dict[float, tuple[bool, bool]]:
        grid = share.select("p", F.explode(F.array(*[F.lit(x) for x in points])).alias("a"))
        w = F.pow("p", F.col("a"))
        rows = grid.groupBy("a").agg(
            F.sum(w).alias("z"), F.sum(w * F.log(w)).alias("wl"), F.max(w / F.col("p")).alias("rise"), F.count(F.lit(1)).alias("n")
        )
        out = {}
        for r in rows.collect():  # one row per grid point
            h = math.log(r["z"]) - r["wl"] / r["z"]
            even = h >= entropy * math.log(r["n"]) - 1e-9
            out[r["a"]] = (even, r["rise"] / r["z"] * budget / total <= max_repeat * (1 + 1e-9))
        return out

    def section(holds: int, largest: bool) -> float:
        """Border of the exponents that hold: they reach from 0 up (largest) or from 1 down."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            points = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
            known = facts(points)
            good = [x for x in points if known[x][holds]]
            if not good:
                return low if largest else high
            border = max(good) if largest else min(good)
            step = (high - low) / SECTIONS
            low, high = (border, min(border + step, 1.0)) if largest else (max(border - step, 0.0), border)
        return low if largest else high

    reached = section(0, True)
    if facts([reached])[reached][1]:
        return reached
    return section(1, False)


def mix(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    budget_ratio: float = 1.0,
    entropy: float = 0.95,
    max_repeat: float = 4.0,
    seed: int = 7,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per occurrence in the mix: the documents' columns and ``__m`` (epoch, block_rank,
    place, n_tokens, weight).

    The budget is ``budget_ratio`` times all tokens; ``entropy`` is a share of the largest
    possible one. Occurrences are in training order by ``epoch, block_rank, place``. A
    source's tokens never exceed its budget and miss it by less than its largest document.
    A null source is a source. Documents without tokens cost nothing and come with their
    block; a source with no tokens at all has no weight and does not come. Repeated rows are
    different documents of equal place. An empty table gives an empty mix.
    """
    kept = documents.columns
    base = documents.select(F.struct(*kept).alias("d"))
    source, key = F.col(f"d.`{source_col}`"), F.col(f"d.`{id_col}`")
    order = seeded(seed, "mix", key, F.md5(F.coalesce(F.col(f"d.`{text_col}`"), F.lit(""))))
    base = base.select("d", source.alias("s"), tokens(F.col(f"d.`{text_col}`")).alias("n"), order.alias("h"))
    per_source = cut_lineage(base.groupBy("s").agg(F.sum("n").alias("n_tokens")))
    total = per_source.agg(F.sum("n_tokens").alias("t")).first()["t"] or 0
    power = exponent(per_source, budget_ratio * total, entropy, max_repeat)
    share = F.pow(F.col("n_tokens") / F.lit(float(max(total, 1))), F.lit(power))
    live = per_source.where("n_tokens > 0").withColumn("w", share)
    norm = live.agg(F.sum("w").alias("z")).first()["z"] or 1.0
    budget = F.floor(F.round(F.col("w") / F.lit(norm) * F.lit(budget_ratio * total), 3)).cast("long")
    plan = live.select(
        F.col("s").alias("ps"),
        F.round(F.col("w") / F.lit(norm), 9).alias("weight"),
        F.floor(budget / F.col("n_tokens")).cast("long").alias("full"),
        (budget % F.col("n_tokens")).alias("rest"),
        F.ceil(F.col("n_tokens") / F.lit(block_tokens)).cast("long").alias("blocks"),
    )
    # One row per source with tokens; Spark broadcasts it if it is small.
    blocked = base.join(plan, F.col("s").eqNullSafe(F.col("ps"))).drop("ps")
    block = F.conv(F.substring("h", 1, 12), 16, 10).cast("long") % F.col("blocks")
    blocked = blocked.withColumn("b", block)

    sizes = blocked.groupBy("s", "b", "full", "rest").agg(F.sum("n").alias("bn"))
    turn = seeded(seed, "block", F.col("full"), F.coalesce(F.col("s").cast("string"), F.lit("")), F.col("b"))
    earlier = Window.partitionBy("s").orderBy("turn", "b").rowsBetween(Window.unboundedPreceding, -1)
    places = cut_lineage(
        sizes.withColumn("turn", turn)
        .withColumn("before", F.coalesce(F.sum("bn").over(earlier), F.lit(0)).cast("long"))
        .select(F.col("s").alias("bs"), F.col("b").alias("bb"), "before", (F.col("before") + F.col("bn")).alias("after"))
    )
    placed = blocked.join(places, F.col("s").eqNullSafe(F.col("bs")) & (F.col("b") == F.col("bb"))).drop("bs", "bb")
    border = (F.col("before") < F.col("rest")) & (F.col("after") > F.col("rest"))
    inside = Window.partitionBy("s", "b").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    whole = placed.where(~border).withColumn("last", (F.col("after") <= F.col("rest")).cast("int"))
    cut = placed.where(border)
    cut = cut.withColumn("last", (F.col("before") + F.sum("n").over(inside) <= F.col("rest")).cast("int"))
    copies = (F.col("full") + F.col("last")).cast("int")
    out = whole.unionByName(cut).where(copies > 0)
    epoch = F.explode(F.sequence(F.lit(0), copies - 1))
    out = out.select("d", "s", "n", "h", "b", "weight", epoch.alias("epoch"))
    rank = seeded(seed, "block", F.col("epoch"), F.coalesce(F.col("s").cast("string"), F.lit("")), F.col("b"))
    details = F.struct(
        F.col("epoch"),
        rank.alias("block_rank"),
        seeded(seed, "place", F.col("epoch"), F.col("h")).alias("place"),
        F.col("n").alias("n_tokens"),
        F.col("weight"),
    )
    return out.select(*[F.col(f"d.`{c}`").alias(c) for c in kept], details.alias("__m"))
