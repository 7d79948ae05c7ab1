"""Corpus profile: class counts, length statistics, vocabulary, density, frequent words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modsieve.functions.text import WORD, word_count, words
from modsieve.session import cut_lineage
from modsieve.spec import COLUMNS, TableSpec

GRID_POINTS = 200
GRID_MARGIN = 3.0  # bandwidths beyond the shortest and the longest text


def _unpivot(df: DataFrame, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("class")) for c in columns])
    return df.select(*carry, F.inline(pairs))


def class_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every class of every categorical column with its rows, and the column's number of classes.

    A null class is listed, with no count, and does not count as a class.
    """
    counts = _unpivot(df, columns).groupBy("column", "class").agg(F.count("class").alias("n_rows"))
    sizes = counts.groupBy("column").agg(F.count("class").alias("n_classes"))
    # One row for each named column: small whatever the table holds.
    listed = counts.join(F.broadcast(sizes), "column")
    shown = F.when(F.col("class").isNotNull(), F.col("n_rows"))
    return listed.select("column", "class", shown.alias("n_rows"), "n_classes")


def target_distribution(df: DataFrame, columns: Sequence[str], target: str = COLUMNS.label) -> DataFrame:
    """Rows per (class, target) for every column other than the target."""
    columns = [c for c in columns if c != target]
    return (
        _unpivot(df, columns, [target])
        .filter(F.col("class").isNotNull() & F.col(target).isNotNull())
        .groupBy("column", "class", target)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def text_length(col: Column, unit: str) -> Column:
    return word_count(col) if unit == "word" else F.char_length(col)


def length_histogram(df: DataFrame, column: str, unit: str = "word") -> DataFrame:
    """(length, n): as many rows as there are different lengths."""
    return (
        df.filter(F.col(column).isNotNull())
        .select(text_length(F.col(column), unit).cast("long").alias("length"))
        .groupBy("length")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _ranked(histogram: DataFrame) -> DataFrame:
    # The window sees one row per different length, bounded by the longest text.
    return histogram.withColumn(
        "upto", F.sum("n").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("m", F.sum("n").over(Window.partitionBy()))


def _value_at(rank: Column) -> Column:
    """The ``rank``-th smallest value (1-based) of a ranked histogram."""
    return F.min(F.when(F.col("upto") >= rank, F.col("length")))


def exclusive_quantile(i: int, n: int) -> Column:
    """Aggregate over a ranked histogram: cut point ``i`` of ``n`` by exclusive interpolation."""
    scaled = i * (F.col("m") + 1)
    j = F.greatest(F.lit(1), F.least(F.floor(scaled / n), F.col("m") - 1))
    j = F.when(F.col("m") > 1, j)
    fraction = F.max(scaled - j * n)
    return (_value_at(j) * (n - fraction) + _value_at(j + 1) * fraction) / F.lit(float(n))


def quantiles(df: DataFrame, column: str, cuts: Sequence[tuple[int, int]], unit: str = "word") -> DataFrame:
    """One row per cut point ``(i, n)``."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(n).alias("n"), F.round(exclusive_quantile(i, n), 4).alias("quantile"))
            for i, n in cuts
        ]
    )
    return _ranked(length_histogram(df, column, unit)).agg(rows.alias("r")).select(F.inline("r"))


def mode(df: DataFrame, column: str, unit: str = "word") -> DataFrame:
    """Most frequent length, the smallest on ties."""
    best = F.max_by("length", F.struct(F.col("n"), -F.col("length")))
    return length_histogram(df, column, unit).agg(best.alias("mode"))


def length_stats(df: DataFrame, column: str, unit: str = "word") -> DataFrame:
    """Sum, range, moments and quantiles of the text lengths, all from the histogram."""
    length, n = F.col("length"), F.col("n")
    wide = "decimal(38,0)"
    total = F.sum(length * n)
    rows = F.sum("n")
    squares = F.sum((length * length).cast("decimal(20,0)") * n.cast("decimal(18,0)")).cast(wide)
    # m*sum(x^2) - sum(x)^2 in whole numbers: no cancellation.
    spread = rows.cast(wide) * squares - total.cast("decimal(19,0)") * total.cast("decimal(19,0)")
    variance = F.when(
        rows > 1, spread.cast("double") / (rows.cast("double") * (rows - 1).cast("double"))
    )
    middle = (_value_at(F.floor((F.col("m") + 1) / 2)) + _value_at(F.floor(F.col("m") / 2) + 1)) / 2
    return _ranked(length_histogram(df, column, unit)).agg(
        total.alias("sum"),
        F.min("length").alias("min"),
        F.max("length").alias("max"),
        F.round(total / rows, 4).alias("mean"),
        F.round(middle, 4).alias("median"),
        F.max_by("length", F.struct(n, -length)).alias("mode"),
        F.round(variance, 4).alias("variance"),
        F.round(F.sqrt(variance), 4).alias("stdev"),
        F.round(exclusive_quantile(1, 100), 4).alias("p01"),
        F.round(exclusive_quantile(1, 4), 4).alias("p25"),
        F.round(exclusive_quantile(2, 4), 4).alias("p50"),
        F.round(exclusive_quantile(3, 4), 4).alias("p75"),
        F.round(exclusive_quantile(99, 100), 4).alias("p99"),
    )


def word_counts(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(words(F.col(column))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary_stats(df: DataFrame, column: str) -> DataFrame:
    """All words, different words (case matters), and their ratio in percent."""
    counted = word_counts(df, column).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_vocabs"), F.count(F.lit(1)).alias("total_unique_vocabs")
    )
    share = F.round(100 * F.col("total_unique_vocabs") / F.col("total_vocabs"), 4)
    return counted.withColumn("uniqueness", F.when(F.col("total_vocabs") > 0, share))


def vocabulary_sketch(df: DataFrame, column: str, by: Sequence[str] = (), precision: int = 12) -> DataFrame:
    """(by, total_vocabs, sketch): all words, and a HyperLogLog sketch of the different ones.

    A sketch has a fixed size (about ``2**precision`` bytes) and merges with others, so tables are read once
    and words never move. Its relative error is about ``1.04 / sqrt(2**precision)``.
    """
    rows = df.select(*by, F.explode_outer(words(F.col(column))).alias("__w"))
    return rows.groupBy(*by).agg(F.count("__w").alias("total_vocabs"), F.hll_sketch_agg("__w", F.lit(precision)).alias("sketch"))


def vocabulary_estimate(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``vocabulary_stats`` of the merged sketches: totals are exact, different words and their share estimates."""
    merged = sketches.groupBy(*by).agg(F.coalesce(F.sum("total_vocabs"), F.lit(0)).alias("total_vocabs"), F.hll_union_agg("sketch").alias("s"))
    found = merged.select(*by, "total_vocabs", F.hll_sketch_estimate("s").alias("total_unique_vocabs"))
    share = F.round(100 * F.col("total_unique_vocabs") / F.col("total_vocabs"), 4)
    return found.withColumn("uniqueness", F.when(F.col("total_vocabs") > 0, share))


def heavy_terms(
    occurrences: DataFrame, k: int, term: str = "word", tracked: int = 100_000, counted: DataFrame | None = None
) -> DataFrame | None:
    """The ``k`` most frequent terms with their exact counts ``n``, or none if the sketch cannot tell them for sure.

    A frequent-items sketch of ``tracked`` terms names four candidates for each place; the candidates, which
    are broadcast, are counted exactly in a second pass, so only their counts move. A term that is no candidate
    occurs at most as often as the last candidate's upper estimate, or twice the sketch's error if it names
    fewer. If the k-th exact count is above that, no other term can be among the first ``k``. With ``counted``,
    the same terms with their counts ``tf`` by document, the second pass reads that, and ``df`` is added.
    """
    wanted = min(4 * k, tracked)
    sketch = F.expr(f"approx_top_k({term}, {wanted}, {tracked})")
    found = occurrences.agg(F.count(term).alias("n"), sketch.alias("top")).first()
    names = [(r["item"],) for r in found["top"]]
    if not names:
        return None
    slots = 1 << (int(tracked / 0.75) - 1).bit_length()  # the sketch's table is a power of two
    bound = 2 * 3.5 / slots * found["n"]
    if len(names) == wanted:
        bound = max(bound, found["top"][-1]["count"])
    candidates = F.broadcast(occurrences.sparkSession.createDataFrame(names, f"{term} string"))
    if counted is None:
        exact = occurrences.join(candidates, term).groupBy(term).agg(F.count(F.lit(1)).alias("n"))
    else:
        exact = counted.join(candidates, term).groupBy(term).agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
    best = cut_lineage(exact.orderBy(F.desc("n"), term).limit(k))  # k rows
    least = best.agg(F.min("n"), F.count(F.lit(1))).first()
    whole = len(names) < wanted and bound < 1  # every term is a candidate
    return best if whole or (least[1] == k and least[0] > bound) else None


def length_density(df: DataFrame, column: str, unit: str = "word", points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density of the lengths on a regular grid, Scott's bandwidth.

    Lengths that are all equal (one text, too) have no spread: the density is null at that
    length, on every point. The sums over the histogram are one row, which is broadcast; the
    histogram itself is spread over the tasks before it meets the grid.
    """
    histogram = length_histogram(df, column, unit)
    n, length = F.col("n").cast("double"), F.col("length").cast("double")
    wide = "decimal(38,0)"
    rows, total = F.sum("n"), F.sum(F.col("length") * F.col("n")).cast("decimal(19,0)")
    squares = F.sum((F.col("length") * F.col("length")).cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)")).cast(wide)
    spread = (rows.cast(wide) * squares - total * total).cast("double")
    facts = histogram.agg(
        rows.cast("double").alias("m"),
        F.sqrt(F.try_divide(spread, rows.cast("double") * (rows - 1).cast("double"))).alias("sd"),
        F.min(length).alias("least"),
        F.max(length).alias("most"),
    ).withColumn("bw", F.coalesce("sd", F.lit(0.0)) * F.pow(F.col("m"), F.lit(-0.2)))
    spread_out = histogram.repartition("length").withColumn("one", F.lit(1))
    measured = spread_out.join(F.broadcast(facts.withColumn("one", F.lit(1))), "one")
    low, high = F.col("least") - GRID_MARGIN * F.col("bw"), F.col("most") + GRID_MARGIN * F.col("bw")
    step = (high - low) / (points - 1)
    on_grid = measured.select(
        "n", "length", "m", F.nullif("bw", F.lit(0.0)).alias("bw"), low.alias("lo"), step.alias("step"),
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
    ).withColumn("x", F.col("lo") + F.col("point") * F.col("step"))
    z = (F.col("x") - length) / F.col("bw")
    kernel = F.col("n") * F.exp(-0.5 * z * z) / (F.col("m") * F.col("bw") * F.sqrt(F.lit(2 * 3.141592653589793)))
    return on_grid.groupBy("point").agg(F.round(F.max("x"), 4).alias("x"), F.round(F.sum(kernel), 9).alias("density"))


def top_terms(df: DataFrame, column: str, stop_words: Sequence[str], k: int, sketch: bool = False) -> DataFrame:
    """The ``k`` most frequent words (lower case, letters and digits) that are no stop words.

    With ``sketch`` only candidates are counted, see ``heavy_terms``; where it cannot be sure of the result, all
    words are counted as without it.
    """
    stop = sorted({w.lower() for w in stop_words})
    word = F.explode(F.regexp_extract_all(F.lower(F.col(column)), F.lit(f"[{WORD}]+"), 0)).alias("word")
    occurrences = df.select(word)
    if sketch:
        some = occurrences.filter(~F.col("word").isin(stop)) if stop else occurrences
        found = heavy_terms(some, k)
        if found is not None:
            return found
    counted = occurrences.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # Stop words go after the counting, once per word instead of once per occurrence.
    kept = counted.filter(~F.col("word").isin(stop)) if stop else counted
    return kept.orderBy(F.desc("n"), "word").limit(k)


def statistics_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(column, metric, class, target, value) for every declared column the table has.

    Categorical columns: number of classes, rows per class and per (class, target).
    Other text columns: length statistics by word and by character, vocabulary.
    """
    categorical = [c for c in spec.categorical if c in df.columns]
    texts = [
        c for c, t in df.dtypes if t == "string" and c in spec.columns and c not in spec.categorical and c not in spec.filepath
    ]
    nothing = F.lit(None).cast("string")
    layout = "column string, metric string, class string, target string, value double"
    parts = []

    def add(part: DataFrame, column: Column, metric: Column, value: Column, of: Column = nothing, target: Column = nothing):
        parts.append(
            part.select(
                column.alias("column"), metric.alias("metric"), of.alias("class"), target.alias("target"), value.cast("double").alias("value")
            )
        )

    if categorical:
        counted = class_distribution(df, categorical)
        sizes = counted.groupBy("column").agg(F.max("n_classes").alias("n"))
        add(sizes, F.col("column"), F.lit("n_classes"), F.col("n"))
        add(counted, F.col("column"), F.lit("class_rows"), F.col("n_rows"), F.col("class"))
        if spec.target in df.columns and spec.target in categorical:
            by_target = target_distribution(df, categorical, spec.target)
            add(by_target, F.col("column"), F.lit("target_rows"), F.col("n_rows"), F.col("class"), F.col(spec.target).cast("string"))
    for column in texts:
        wide = [(length_stats(df, column, unit), f"{unit}_length_") for unit in ("word", "char")]
        wide.append((vocabulary_stats(df, column), ""))
        for stats, prefix in wide:
            pairs = F.array(*[F.struct(F.lit(prefix + c).alias("m"), F.col(c).cast("double").alias("v")) for c in stats.columns])
            add(stats.select(F.inline(pairs)), F.lit(column), F.col("m"), F.col("v"))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], layout)
