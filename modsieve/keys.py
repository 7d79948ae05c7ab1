"""Seeded hash keys and row numbering that does not depend on partitioning.

Every random choice is ordered by ``md5(seed:op:key)``. Numbering never sorts a
whole stratum in one task: rows fall into buckets by the leading hex digits of
their hash, the buckets are counted, and a row's number is the count of all
earlier buckets plus its place inside its own. The result equals a plain
``row_number() over (partition by strata order by hash, key)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modsieve.session import cut_lineage

UNIFORM_SCALE = 4294967296.0  # 16**8: eight hex digits of an md5


def seeded(seed: int | str, op: str, *parts: Column | str) -> Column:
    """md5 of ``seed:op:part:...``, 32 hex digits."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(op), *[c.cast("string") for c in cols]))


def uniform(hashed: Column, word: int = 0) -> Column:
    """Number in [0, 1) from the ``word``-th group of eight hex digits (0-3)."""
    return F.conv(F.substring(hashed, 8 * word + 1, 8), 16, 10).cast("long") / F.lit(UNIFORM_SCALE)


def digests(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Grouping keys for ``columns``: texts by their SHA-256, other types as they are.

    32 bytes are moved, sorted and compared instead of whole texts. Equal digests
    mean equal texts for every practical purpose; null stays null.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [
        (F.unhex(F.sha2(F.col(c), 256)) if isinstance(kinds[c], T.StringType) else F.col(c)).alias(f"__d{i}")
        for i, c in enumerate(columns)
    ]


def bucket_digits(spark: SparkSession) -> int:
    """Hex digits that give at least four buckets per shuffle partition."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    digits = 2
    while 16**digits < wanted and digits < 6:
        digits += 1
    return digits


def running_total(df: DataFrame, order: Sequence[str], amount: str, out: str) -> DataFrame:
    """Add the sum of ``amount`` over all earlier rows by the unique ``order``, without one task for all.

    Rows are dealt by ranges of the order and stored, since the ranges are drawn from a sample;
    sums continue from range to range.
    """
    placed = cut_lineage(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()))
    earlier = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    ranges = placed.groupBy("__p").agg(F.sum(amount).alias("__t0"))
    ranges = ranges.select("__p", F.coalesce(F.sum("__t0").over(earlier), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return placed.withColumn(out, local).join(F.broadcast(ranges), "__p").withColumn(out, F.col(out) + F.col("__o")).drop("__p", "__o")


def number_rows(
    df: DataFrame,
    strata: Sequence[str],
    order: Column,
    tie: Sequence[str] = (),
    *,
    out: str = "pos",
    size: str | None = None,
    before: str | None = None,
    weight: Column | None = None,
    totals: dict[str, tuple[Sequence[str], Column]] | None = None,
    lookup: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row within its stratum, ordered by a hash.

    ``order`` must be a hex hash of a unique key. ``size`` adds the stratum's row
    count and ``before`` the rows of all strata that sort earlier. With ``weight``
    the position is the weight of all earlier rows. ``totals`` adds
    further sums over the bucket counts, as ``name: (partition columns, value)``
    where ``value`` may use the strata and the count column ``__n``. ``lookup`` is a table
    with one row per stratum and the name of the column to add from it. They ride on
    the same balanced join, so no join on a (possibly hot) stratum is needed.

    One exchange moves the rows, on (stratum, bucket). The counts need a second,
    column-pruned read of ``df`` and partial aggregation before they move.
    """
    digits = bucket_digits(df.sparkSession)
    strata = list(strata)
    tagged = df.withColumn("__h", order).withColumn("__b", F.substring("__h", 1, digits))
    if strata:
        # A struct compares null members as equal, so null strata join too.
        tagged = tagged.withColumn("__s", F.struct(*strata))
    by = ["__s"] if strata else []

    amount = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    counts = tagged.groupBy(*by, "__b").agg(amount.alias("__n"))
    if strata:
        counts = counts.select("*", *[F.col("__s")[c].alias(c) for c in strata])
    earlier = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    extra = []
    if size:
        offsets = offsets.withColumn(size, F.sum("__n").over(Window.partitionBy(*by)))
        extra.append(size)
    for name, (over, value) in (totals or {}).items():
        offsets = offsets.withColumn(name, F.sum(value).over(Window.partitionBy(*over)))
        extra.append(name)
    if before:
        # One row per stratum: small next to the rows, and never the rows themselves.
        sums = counts.groupBy("__s").agg(F.sum("__n").alias("__t"))
        sums = running_total(sums, ["__s"], "__t", before).select("__s", before)
        offsets = offsets.join(sums, "__s")
        extra.append(before)
    if lookup:
        known, name = lookup
        offsets = offsets.join(known.select(F.struct(*strata).alias("__s"), name), "__s", "left")
        extra.append(name)
    offsets = offsets.select(*by, "__b", "__off", *extra)

    inside = Window.partitionBy(*by, "__b").orderBy("__h", *tie)
    if weight is None:
        local = F.row_number().over(inside) - F.lit(1)
    else:
        local = F.coalesce(
            F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
    return (
        tagged.withColumn("__local", local.cast("long"))
        .join(offsets, [*by, "__b"])
        .withColumn(out, F.col("__off") + F.col("__local"))
        .drop(*by, "__b", "__h", "__off", "__local")
    )
