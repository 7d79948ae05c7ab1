"""Folds, splits and samples: every row's place follows from its hash."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modsieve.keys import number_rows, seeded, uniform
from modsieve.operators.balance import remainder_folds

KEY = ("row_id",)


def kfold(df: DataFrame, n: int, seed: int, key: Sequence[str] = KEY) -> DataFrame:
    """Shuffled folds of equal size."""
    numbered = number_rows(df, [], seeded(seed, "fold", *key), key, out="__pos")
    return numbered.withColumn("fold", (F.col("__pos") % n).cast("int")).drop("__pos")


def dealt_kfold(
    df: DataFrame, labels: Sequence[str], n: int, seed: int, key: Sequence[str] = KEY
) -> DataFrame:
    """Folds balanced on every combination of labels, by dealing the sorted rows in turn.

    Dealing continues from one combination to the next, so fold sizes differ by at most one
    overall, and so do the counts of the first label's values. Counts of a later label's value may differ by as
    much as there are combinations of the labels before it.
    """
    numbered = number_rows(
        df, labels, seeded(seed, "fold", *key), key, out="__pos", before="__before"
    )
    fold = (F.col("__before") + F.col("__pos")) % n
    return numbered.withColumn("fold", fold.cast("int")).drop("__pos", "__before")


def multilabel_stratified_kfold(
    df: DataFrame, labels: Sequence[str], n: int, seed: int, key: Sequence[str] = KEY
) -> DataFrame:
    """Folds balanced on every combination of labels and on each label for itself.

    Every combination's counts differ by at most one between folds: that holds by construction.
    The folds of the rows left over are chosen on the table of combinations so that the same
    holds for each value of each label and for all rows (see ``balance``). It is a search: where
    it finds no such choice the differences are the smallest found, and ``label_balance``
    shows them. Null is a value like any other. One label needs no search.
    """
    if len(labels) < 2:
        return dealt_kfold(df, labels, n, seed, key)
    cells = df.groupBy(*labels).agg(F.count(F.lit(1)).alias("size"))
    chosen = remainder_folds(cells, labels, n, seed)
    numbered = number_rows(
        df, labels, seeded(seed, "fold", *key), key, out="__pos", size="__size", lookup=(chosen, "chosen")
    )
    even = F.col("__size") - F.col("__size") % n
    late = F.get("chosen", (F.col("__pos") - even).cast("int"))
    fold = F.when(F.col("__pos") < even, F.col("__pos") % n).otherwise(late)
    return numbered.withColumn("fold", fold.cast("int")).drop("__pos", "__size", "chosen")


def label_balance(folded: DataFrame, labels: Sequence[str], n: int) -> DataFrame:
    """(label, value, n_rows, counts): how often each value of each label is in each fold.

    All rows are one value of the label ``*``. Equal rows are combined before they move.
    """
    each = [F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("value")) for c in labels]
    each.append(F.struct(F.lit("*").alias("label"), F.lit("").alias("value")))
    cells = folded.groupBy(*labels, "fold").agg(F.count(F.lit(1)).alias("__n"))
    pairs = cells.select("fold", "__n", F.inline(F.array(*each)))
    counts = [F.sum(F.when(F.col("fold") == f, F.col("__n")).otherwise(0)).alias(f"__{f}") for f in range(n)]
    summed = pairs.groupBy("label", "value").agg(F.sum("__n").alias("n_rows"), *counts)
    return summed.select("label", "value", "n_rows", F.array(*[f"__{f}" for f in range(n)]).alias("counts"))


def stratified_kfold(df: DataFrame, label: str, n: int, seed: int, key: Sequence[str] = KEY) -> DataFrame:
    return dealt_kfold(df, [label], n, seed, key)


# Fold types, from plain to multi-label.
FOLD_TYPES = ("kfold", "skfold", "mlskfold")


def choose_fold_type(labels: Sequence[str] | str | None, kind: str = "kfold") -> str:
    if kind not in FOLD_TYPES:
        raise ValueError(f"fold type {kind!r} is none of {FOLD_TYPES}")
    if not labels:
        return kind
    if isinstance(labels, str):
        return max(kind, "skfold", key=FOLD_TYPES.index)
    return "mlskfold" if len(labels) > 1 else "skfold"


def make_folds(
    df: DataFrame,
    n: int,
    seed: int,
    labels: Sequence[str] | str | None = None,
    kind: str = "kfold",
    key: Sequence[str] = KEY,
    search: bool = True,
) -> DataFrame:
    """Folds of the type that suits the labels; no labels to use means plain folds.

    Without ``search`` several labels are dealt in turn, see ``dealt_kfold``.
    """
    chosen = choose_fold_type(labels, kind)
    names = [labels] if isinstance(labels, str) else list(labels or [])
    if chosen == "kfold" or not names or any(c not in df.columns for c in names):
        return kfold(df, n, seed, key)
    return (multilabel_stratified_kfold if search else dealt_kfold)(df, names, n, seed, key)


def split_granularity(fractions: Sequence[float]) -> int:
    """Smallest of 10, 100, ... for which every fraction is a whole number of folds."""
    n = 10
    while any((Decimal(str(f)) * n) % 1 for f in fractions):
        n *= 10
    return n


def split_folds(train_frac: float, valid_frac: float, n: int) -> tuple[list[int], list[int]]:
    """Fold numbers of train and of valid; the valid folds follow and wrap around."""
    first = int(Decimal(str(train_frac)) * n)
    count = int(Decimal(str(valid_frac)) * n)
    return list(range(first)), [f % n for f in range(first, first + count)]


def fraction_split(
    folded: DataFrame, train_frac: float, valid_frac: float, n: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, valid, overlap): the overlap table counts the rows that are in both."""
    n = n or split_granularity([train_frac, valid_frac])
    train_folds, valid_folds = split_folds(train_frac, valid_frac, n)
    in_train = F.col("fold") < len(train_folds)
    in_valid = F.col("fold").isin(valid_folds) if valid_folds else F.lit(False)
    overlap = folded.agg(F.count_if(in_train & in_valid).alias("overlap"))
    return folded.filter(in_train).drop("fold"), folded.filter(in_valid).drop("fold"), overlap


def fold_filter(df: DataFrame, k: int, n: int) -> tuple[DataFrame, DataFrame | None]:
    """(train, valid) of fold ``k`` of ``n``; outside the range everything is train."""
    if k < 0 or k >= n:
        return df, None
    return df.filter(F.col("fold") != k), df.filter(F.col("fold") == k)


def whole_share(size: Column, frac: float) -> Column:
    """``round(frac * size)`` as a whole number."""
    return F.round(size * F.lit(float(frac))).cast("long")


def stratified_holdout(
    df: DataFrame, strata: Sequence[str], frac: float, seed: int, key: Sequence[str] = KEY
) -> DataFrame:
    """Add ``held_out``: the given share of every stratum."""
    numbered = number_rows(
        df, strata, seeded(seed, "holdout", *key), key, out="__pos", size="__size"
    )
    held = F.col("__pos") < whole_share(F.col("__size"), frac)
    return numbered.withColumn("held_out", held).drop("__pos", "__size")


def sample_fraction(
    df: DataFrame, frac: float, seed: int, key: Sequence[str] = KEY, exact: bool = True
) -> DataFrame:
    """A share of the rows without replacement: exactly ``round(frac*n)``, or about that in one scan."""
    hashed = seeded(seed, "sample", *key)
    if not exact:
        return df.filter(uniform(hashed) < frac)
    numbered = number_rows(df, [], hashed, key, out="__pos", size="__size")
    return numbered.filter(F.col("__pos") < whole_share(F.col("__size"), frac)).drop("__pos", "__size")


def extend_train(
    train: DataFrame, test: DataFrame, frac: float, seed: int, key: Sequence[str] = KEY
) -> DataFrame:
    """Train plus a sampled share of the (labelled) test rows."""
    return train.unionByName(sample_fraction(test, frac, seed, key), allowMissingColumns=True)


def length_dealt_folds(
    df: DataFrame, length: Column, n: int, seed: int, key: Sequence[str] = KEY
) -> DataFrame:
    """Sort by length and deal the rows to the folds in turn; equal lengths in hash order."""
    measured = df.withColumn("token_length", length)
    numbered = number_rows(
        measured, ["token_length"], seeded(seed, "length", *key), key, out="__pos", before="__before"
    )
    fold = (F.col("__before") + F.col("__pos")) % n
    return numbered.withColumn("fold", fold.cast("int")).drop("__pos", "__before")
