"""Checks of a table against its declared layout, and quarantine of bad rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modsieve.keys import digests
from modsieve.session import cut_lineage
from modsieve.spec import INTEGER_NAMES, TEXT_NAMES, TableSpec

# Fixed value: keys that go to every task.
MOST_LATER = 1_000_000
REPORT_SCHEMA = "check string, column string, metric string, value double, detail string"


class LayoutError(ValueError):
    """The table lacks declared columns or holds other types than declared."""


@dataclass(frozen=True)
class Validation:
    valid: DataFrame
    rejected: DataFrame
    report: DataFrame
    ok: bool
    tagged: DataFrame | None = None  # valid and rejected rows with ``reject_reason``


def absent_columns(df: DataFrame, spec: TableSpec, train: bool = True) -> list[str]:
    declared = (spec if train else spec.for_test()).columns
    return [c for c in declared if c not in df.columns]


def missing_columns(df: DataFrame, spec: TableSpec, train: bool = True) -> DataFrame:
    """One row per declared column that the table lacks, with the rows affected."""
    absent = absent_columns(df, spec, train)
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select(F.explode(F.lit(absent).cast("array<string>")).alias("column"), "n_rows")


def type_conflicts(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, str]]:
    """(column, declared, found) where the actual type is of another family."""
    conflicts = []
    for column, declared in spec.columns.items():
        if column not in df.columns:
            continue
        actual = df.schema[column].dataType
        text = declared.lower() in TEXT_NAMES and not isinstance(actual, T.StringType)
        whole = declared.lower() in INTEGER_NAMES and not isinstance(actual, T.IntegralType)
        if text or whole:
            conflicts.append((column, declared, actual.simpleString()))
    return conflicts


def dtype_mismatch(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Type conflicts; for text that should be whole numbers also the values that cannot be cast."""
    conflicts = type_conflicts(df, spec)
    counted = []
    for column, declared, found in conflicts:
        bad = F.lit(None).cast("long")
        if found == "string" and declared.lower() in INTEGER_NAMES:
            bad = F.count_if(F.col(column).try_cast("long").isNull() & F.col(column).isNotNull())
        counted.append(bad)
    schema = "array<struct<column:string,dtype:string,found:string,n_uncastable:bigint>>"
    if not conflicts:
        return df.limit(0).select(F.inline(F.array().cast(schema)))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(d).alias("dtype"), F.lit(f).alias("found"), n.alias("n_uncastable")
            )
            for (c, d, f), n in zip(conflicts, counted)
        ]
    )
    return df.agg(rows.alias("r")).select(F.inline("r"))


def any_missing(spec: TableSpec) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.features])


def duplicate_purity(total: Column, duplicates: Column) -> Column:
    return F.when(duplicates == 0, F.lit(100.0)).otherwise(F.round(100 * (total - duplicates) / total, 4))


def missing_purity(total: Column, missing: Column) -> Column:
    """Rounded before the scaling, unlike the duplicate purity."""
    return F.when(missing == 0, F.lit(100.0)).otherwise(100 * F.round((total - missing) / total, 4))


def duplicate_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    groups = df.groupBy(*digests(df, spec.features)).agg(F.count(F.lit(1)).alias("n"))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )
    return counts.withColumn("purity", duplicate_purity(F.col("raw_count"), F.col("n_duplicates")))


def is_key(df: DataFrame, columns: Sequence[str]) -> bool:
    """Do the columns tell all rows apart, without nulls? Only their digests move."""
    names = digests(df, columns)
    nulls = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.max(nulls).alias("none"))
    return groups.filter("n > 1 or none").isEmpty()


def tag_first(df: DataFrame, features: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Add ``is_first``: is the row the first of its feature group by ``order_by``?

    The group minimum is combined before it is shuffled, so a group with a third of all rows
    never meets in one task. Only keys meet the minima; what is not first is stored by its key, and
    the rows stay where they are if that is at most ``MOST_LATER`` keys. An order that does not
    tell all rows apart (copies, or nulls in it) is completed by a row number, stored once.
    """
    order_by = list(order_by)
    if not is_key(df, order_by):
        landed = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))
        inside = [c for c in order_by if c not in features]  # features are equal inside a group
        firsts = landed.groupBy(*digests(df, features)).agg(F.min(F.struct(*inside, "__row")).alias("first"))
        return mark_firsts(landed, firsts.select(F.col("first.__row").alias("__row")), ["__row"]).drop("__row")
    groups = df.groupBy(*digests(df, features))
    if len(order_by) == 1:  # a plain minimum aggregates by hash, a struct by sorting
        firsts = groups.agg(F.min(order_by[0]).alias(order_by[0])).select(*order_by)
    else:
        firsts = groups.agg(F.min(F.struct(*order_by)).alias("first")).select("first.*")
    return mark_firsts(df, firsts, order_by)


def mark_firsts(df: DataFrame, firsts: DataFrame, key: list[str]) -> DataFrame:
    """Add ``is_first``: is the row's ``key``, which no other row has, among ``firsts``?"""
    later = cut_lineage(df.select(*key).join(firsts, key, "left_anti")).withColumn("__later", F.lit(True))
    if later.limit(MOST_LATER + 1).count() <= MOST_LATER:
        later = F.broadcast(later)
    return df.join(later, key, "left").withColumn("is_first", F.col("__later").isNull()).drop("__later")


def quarantine_duplicates(df: DataFrame, spec: TableSpec, order_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    tagged = tag_first(df, spec.features, order_by)
    return tagged.filter("is_first").drop("is_first"), tagged.filter("not is_first").drop("is_first")


def missing_rows_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("raw_count"), F.count_if(any_missing(spec)).alias("n_missing"))
    return counts.withColumn("purity", missing_purity(F.col("raw_count"), F.col("n_missing")))


def quarantine_missing(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    return df.filter(~any_missing(spec)), df.filter(any_missing(spec))


def tag_rejects(df: DataFrame, spec: TableSpec, order_by: Sequence[str]) -> DataFrame:
    """Add ``reject_reason``: duplicate, then missing, else null."""
    tagged = tag_first(df, spec.features, order_by)
    reason = F.when(~F.col("is_first"), "duplicate").when(any_missing(spec), "missing")
    return tagged.withColumn("reject_reason", reason).drop("is_first")


def reject_report(tagged: DataFrame) -> DataFrame:
    """Counts and purities of both row checks, the second on what the first left."""
    total, duplicates, missing = F.col("n"), F.col("d"), F.col("m")
    counts = tagged.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("reject_reason") == "duplicate").alias("d"),
        F.count_if(F.col("reject_reason") == "missing").alias("m"),
    )

    def line(check: str, metric: str, value: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(None).cast("string").alias("column"),
            F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
            F.lit(None).cast("string").alias("detail"),
        )

    return counts.select(
        F.inline(
            F.array(
                line("data_redundancy", "raw_count", total),
                line("data_redundancy", "n_duplicates", duplicates),
                line("data_redundancy", "purity", duplicate_purity(total, duplicates)),
                line("missing_rows", "raw_count", total - duplicates),
                line("missing_rows", "n_missing", missing),
                line("missing_rows", "purity", missing_purity(total - duplicates, missing)),
            )
        )
    )


def validate(
    df: DataFrame,
    spec: TableSpec,
    order_by: Sequence[str] | None = None,
    *,
    train: bool = True,
    strict: bool = True,
) -> Validation:
    """All checks in order; rejected rows are kept together with the reason.

    A missing column or a wrong type is fatal: ``strict`` raises, otherwise no row is valid,
    all are rejected for their ``layout``, ``ok`` is False and the report names the columns.
    """
    absent = absent_columns(df, spec, train)
    conflicts = type_conflicts(df, spec)
    if absent or conflicts:
        if strict:
            raise LayoutError(f"missing columns {absent}, wrong types {conflicts}")
        found = [("missing_columns", c, "absent", None, None) for c in absent]
        found += [("dtype_mismatch", c, d, None, f) for c, d, f in conflicts]
        report = df.sparkSession.createDataFrame(found, REPORT_SCHEMA)
        tagged = df.withColumn("reject_reason", F.lit("layout"))
        return Validation(df.limit(0), tagged, report, False, tagged)

    return verdicts(tag_rejects(df, spec, order_by or spec.key))


def verdicts(tagged: DataFrame) -> Validation:
    """Split rows with a ``reject_reason``; they may come from a stored table."""
    valid = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.filter(F.col("reject_reason").isNotNull())
    return Validation(valid, rejected, reject_report(tagged), True, tagged)


def submission_aligned(test: DataFrame, submission: DataFrame, key: str = "row_id") -> DataFrame:
    """Row counts of both sides, ids missing on either, and whether the counts agree."""
    sides = (
        test.select(key, F.lit(1).alias("t"), F.lit(0).alias("s"))
        .unionByName(submission.select(key, F.lit(0).alias("t"), F.lit(1).alias("s")))
        .groupBy(key)
        .agg(F.sum("t").alias("t"), F.sum("s").alias("s"))
    )
    counted = sides.agg(
        F.coalesce(F.sum("t"), F.lit(0)).alias("n_test"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("n_submission"),
        F.count_if(F.col("s") == 0).alias("not_submitted"),
        F.count_if(F.col("t") == 0).alias("not_in_test"),
    )
    return counted.withColumn("accepted", F.col("n_test") == F.col("n_submission"))
