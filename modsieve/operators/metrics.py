"""Exact ranking metrics, accuracy, ensembling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _search_steps(spark: SparkSession) -> int:
    """Halvings that give at least four score ranges per shuffle partition, 65,536 at most.

    The cuts travel with the plan, and more ranges than that serve no cluster.
    """
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max((ranges - 1).bit_length(), 5), 16)


def running_before(histogram: DataFrame, value: str, amounts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add, for each of ``amounts``, ``<name>_before`` (its sum over all smaller values of
    the group) and ``<name>_all`` (its sum over the group).

    Even with as many values as rows no task sees a whole group: approximate
    percentiles cut the values into ranges of similar size, the ranges are summed,
    and the exact running sum continues from range to range. Where the cuts fall
    does not change the result. All steps read the same columns of the histogram,
    so its exchange is made once and reused.
    """
    steps = _search_steps(histogram.sparkSession)
    fractions = [i / 2**steps for i in range(1, 2**steps)]
    counted = F.when(sum((F.col(a) for a in amounts), F.lit(0)) >= 0, F.col(value))  # always; reads the counts
    cuts = histogram.agg(F.percentile_approx(counted, fractions, 10 * 2**steps)).scalar()
    # Binary search: how many cuts are below the value. Never null, or Spark would
    # test it on every input row.
    spot = F.aggregate(
        F.lit([2**i for i in reversed(range(steps))]),
        F.lit(0),
        lambda at, jump: F.when(F.get("__cuts", at + jump - 1) < F.col(value), at + jump).otherwise(at),
    )
    by = list(by)
    placed = histogram.withColumn("__cuts", cuts).withColumn("__range", F.coalesce(spot, F.lit(0))).drop("__cuts")
    group = []
    if by:
        placed, group = placed.withColumn("__g", F.struct(*by)), ["__g"]
    sums = placed.groupBy(*group, "__range").agg(*[F.sum(a).alias(a) for a in amounts])
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = sums.select(
        *group,
        "__range",
        *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(f"{a}_before") for a in amounts],
        *[F.sum(a).over(whole).alias(f"{a}_all") for a in amounts],
    )
    inside = Window.partitionBy(*group, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"__{a}": F.coalesce(F.sum(a).over(inside), F.lit(0)) for a in amounts})
    joined = local.join(offsets, [*group, "__range"])
    added = {f"{a}_before": F.col(f"{a}_before") + F.col(f"__{a}") for a in amounts}
    return joined.withColumns(added).drop(*group, "__range", *[f"__{a}" for a in amounts])


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half; null where a class is absent."""
    by = list(by)
    known = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    histogram = known.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_before(histogram, score, ["pos", "neg"], by)
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    positives, negatives = F.coalesce(F.max("pos_all"), F.lit(0)), F.coalesce(F.max("neg_all"), F.lit(0))
    pairs = positives.cast("double") * negatives.cast("double")
    return ranked.groupBy(*by).agg(
        F.when(pairs > 0, wins / pairs).alias("auc"), positives.alias("n_positive"), negatives.alias("n_negative")
    )


def column_averaged_auc(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Mean of the groups' AUCs; groups with one class are left out and counted."""
    return roc_auc(df, score, label, by).agg(
        F.avg("auc").alias("auc"),
        F.count("auc").alias("n_groups"),
        F.count_if(F.col("auc").isNull()).alias("n_one_class"),
    )


def accuracy(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    right = (F.col(score) > threshold).cast("int") == F.col(label)
    return df.agg(F.avg(right.cast("int")).alias("accuracy"))


def positive_probability(logits: Column) -> Column:
    """Softmax of two logits, the positive entry."""
    return 1 / (1 + F.exp(logits[0] - logits[1]))


def ensemble_mean(predictions: DataFrame, key: str = "row_id", score: str = "prediction", weight: str | None = None) -> DataFrame:
    """Weighted mean score per row over stacked predictions; null where the weights sum to zero."""
    if weight is None:
        return predictions.groupBy(key).agg(F.avg(score).alias(score))
    total = F.sum(F.when(F.col(score).isNotNull(), F.col(weight)))
    return predictions.groupBy(key).agg(F.try_divide(F.sum(F.col(weight) * F.col(score)), total).alias(score))


def sharpen(df: DataFrame, score: str, power: float = 0.5, threshold: float = 0.5) -> DataFrame:
    """Rows at or above the threshold, their score raised to ``power``."""
    return df.filter(F.col(score) >= threshold).withColumn(score, F.pow(score, F.lit(float(power))))
