"""TF-IDF drift between two sides of a corpus, and whether a classifier can tell them apart."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modsieve.functions.text import tokens, word_count
from modsieve.operators.folds import length_dealt_folds, stratified_holdout
from modsieve.operators.metrics import roc_auc
from modsieve.operators.partials import SUMS, emit, lists, pieces, sparse_parts, summed
from modsieve.operators.profile import heavy_terms
from modsieve.session import cut_lineage

DIMENSION = 500
BINS = 50
# The second words of counted pairs are at most this many times ``dimension``, or all words.
SECONDS = 4
# Counted terms that a task holds before it passes them on.
HELD = 1 << 19
# Rows whose terms are counted at once.
ROWS = 1024


def term_arrays(df: DataFrame, column: str, carry: Sequence[str], bigrams: bool = True, out: str = "__terms") -> DataFrame:
    """Every row's tokens, and pairs of neighbouring tokens, as one array; a null text has none."""
    none = F.array().cast("array<string>")
    cut = df.select(*carry, F.coalesce(tokens(F.col(column)), none).alias(out))
    if not bigrams:
        return cut
    size = F.size(out)
    pairs = F.zip_with(
        F.slice(out, F.lit(1), F.greatest(size - 1, F.lit(0))), F.slice(out, F.lit(2), F.greatest(size - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return cut.select(*carry, F.concat(out, F.when(size > 1, pairs).otherwise(none)).alias(out))


def terms(df: DataFrame, column: str, key: Sequence[str], bigrams: bool = True) -> DataFrame:
    """One row per occurrence of a token, and of a pair of neighbouring tokens."""
    # The outer form keeps the optimizer from copying the array into a filter.
    rows = term_arrays(df, column, key, bigrams).select(*key, F.explode_outer("__terms").alias("term"))
    return rows.filter(F.col("term").isNotNull())


def counted_rows(df: DataFrame, key: Sequence[str], array: str, term: str = "term", count: str = "tf") -> DataFrame:
    """(key, term, tf): each row's array of terms, counted inside the row: equal ones are neighbours when sorted."""
    cut = df.select(*key, F.sort_array(array).alias("__t"))
    places = F.when(F.size("__t") > 0, F.sequence(F.lit(1), F.size("__t")))
    starts = F.filter(places, lambda i: (i == 1) | (F.element_at("__t", i) != F.element_at("__t", F.greatest(i - 1, F.lit(1)))))
    cut = cut.select(*key, "__t", starts.alias("__f"))
    ends = F.concat(F.slice("__f", F.lit(2), F.size("__f")), F.array(F.size("__t") + 1))
    runs = F.zip_with("__f", ends, lambda a, b: F.struct(F.element_at("__t", a).alias(term), (b - a).cast("long").alias(count)))
    return cut.select(*key, runs.alias("__c")).select(*key, F.inline_outer("__c")).filter(F.col(term).isNotNull())


def term_counts(df: DataFrame, column: str, key: Sequence[str], bigrams: bool = True) -> DataFrame:
    """(key, term, tf). Nothing is shuffled; rows that share a key are counted each for itself."""
    return counted_rows(term_arrays(df, column, key, bigrams), key, "__terms")


@dataclass(frozen=True)
class TermModel:
    """The most frequent terms of a corpus with their inverse document frequencies."""

    terms: list[str]
    idf: list[float]

    def features(self, df: DataFrame, column: str, carry: Sequence[str], bigrams: bool = True) -> DataFrame:
        """(carry, features): sparse TF-IDF vectors of length one, or of zeros without terms; nothing moves."""
        known = self.terms or [""]
        stages = [
            CountVectorizerModel.from_vocabulary(known, inputCol="__terms", outputCol="__tf"),
            ElementwiseProduct(scalingVec=Vectors.dense(self.idf or [0.0]), inputCol="__tf", outputCol="__raw"),
            Normalizer(p=2.0, inputCol="__raw", outputCol="features"),
        ]
        return PipelineModel(stages).transform(term_arrays(df, column, carry, bigrams)).select(*carry, "features")

    def weights(self, features: DataFrame, key: Sequence[str]) -> DataFrame:
        """(key, term, weight) of the vectors' entries."""
        known = F.array(*[F.lit(t) for t in self.terms or [""]])
        parts = features.select(*key, sparse_parts("features").alias("__s"))
        rows = parts.select(*key, F.inline_outer(F.arrays_zip(F.col("__s.places").alias("place"), F.col("__s.counts").alias("weight"))))
        return rows.filter(F.col("place").isNotNull()).select(*key, F.element_at(known, F.col("place") + 1).alias("term"), "weight")


def _counting(first: list[str], second: list[str] | None, bigrams: bool):
    """Occurrences and rows of the words ``first``, and of their pairs with the words ``second`` (all, if none are given)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(first, pa.string())
        late = None if second is None else pa.array(second, pa.string())
        held: list[pa.Table] = []

        def summed_up(parts: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(parts).group_by("term").aggregate([("n", "sum"), ("df", "sum")]).rename_columns(["term", "n", "df"])

        def counts(owner: np.ndarray, code: np.ndarray, names: Callable[[np.ndarray], pa.Array], width: int) -> None:
            cells, n = np.unique(owner * width + code, return_counts=True)
            found, place = np.unique(cells % max(width, 1), return_inverse=True)
            n = np.bincount(place, n, len(found)).astype(np.int64)
            held.append(pa.table({"term": names(found), "n": n, "df": np.bincount(place, minlength=len(found)).astype(np.int64)}))

        for column in (b.column("__terms").slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            owner = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
            words = column.flatten().dictionary_encode()
            code, names = words.indices.to_numpy(), words.dictionary
            opens = pc.is_in(names, value_set=known).to_numpy(zero_copy_only=False)[code] if len(names) else np.zeros(0, bool)
            counts(owner[opens], code[opens], lambda at: names.take(pa.array(at)), len(names))
            if bigrams and len(code) > 1:
                closes = np.ones(len(code), bool) if late is None else pc.is_in(names, value_set=late).to_numpy(zero_copy_only=False)[code]
                at = np.flatnonzero(opens[:-1] & closes[1:] & (owner[:-1] == owner[1:]))
                pairs, place = np.unique(code[at].astype(np.int64) * len(names) + code[at + 1], return_inverse=True)
                spelt = pc.binary_join_element_wise(names.take(pa.array(pairs // len(names))), names.take(pa.array(pairs % len(names))), " ")
                counts(owner[at], place, lambda at: spelt.take(pa.array(at)), len(pairs))
            if sum(map(len, held)) > HELD:
                held[:] = [summed_up(held)]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed_up(held).to_batches()

    return run


def term_model(df: DataFrame, column: str, dimension: int = DIMENSION, bigrams: bool = True, sketch: bool = False) -> TermModel:
    """The ``dimension`` most frequent terms: one aggregation by term, of terms counted in their rows.

    The driver gets ``dimension`` short rows and the number of documents. With ``sketch`` only the candidates of a
    frequent-items sketch are aggregated, if that is sure to give the same terms.

    Words are counted first. A pair occurs no more often than either of its words, and sorts after its first one:
    only pairs of a first word among the ``dimension`` most frequent ones with a word at least as frequent as the
    last of these can be among the terms, so the other pairs are not counted.
    """
    top = heavy_terms(terms(df, column, [], bigrams), dimension, "term", counted=term_counts(df, column, [], bigrams)) if sketch else None
    if top is None:
        cut = term_arrays(df, column, [], bigrams=False)
        # The outer form, as in ``terms``.
        words = cut.select(F.explode_outer("__terms").alias("term")).groupBy("term").agg(F.count("term").alias("n"))
        words = words.filter(F.col("term").isNotNull()).orderBy(F.desc("n"), "term").limit(SECONDS * dimension).collect()
        first, last = [r["term"] for r in words[:dimension]], words[dimension - 1]["n"] if len(words) >= dimension else 0
        second = [r["term"] for r in words if r["n"] >= last]
        if len(words) == SECONDS * dimension == len(second):
            second = None  # ties beyond the rows at hand: every word may come second
        counted = cut.mapInArrow(_counting(first, second, bigrams), "term string, n long, df long")
        totals = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
        top = totals.orderBy(F.desc("n"), "term").limit(dimension)
    n = df.agg(F.count(F.lit(1)).alias("n"))
    raw = F.log((1 + n.scalar()).cast("double") / (1 + F.col("df")).cast("double")) + 1
    found = top.select("term", raw.alias("idf")).orderBy("term").collect()
    return TermModel([r["term"] for r in found], [r["idf"] for r in found])


def tfidf(df: DataFrame, column: str, key: Sequence[str], dimension: int = DIMENSION, bigrams: bool = True) -> DataFrame:
    """(key, term, weight), every document's weights of length one.

    Texts are read twice, for the vocabulary and for the weights; only terms' totals move.
    """
    model = term_model(df, column, dimension, bigrams)
    return model.weights(model.features(df, column, list(key), bigrams), list(key))


def mean_vector_drift(weights: DataFrame, side: Column) -> DataFrame:
    """Distance and cosine of the two sides' mean vectors, scaled to length one.

    Both are null if a side has no terms.
    """
    per_term = weights.groupBy("term").agg(
        F.sum(F.when(~side, F.col("weight"))).alias("a"), F.sum(F.when(side, F.col("weight"))).alias("b")
    )
    a, b = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    cosine = F.try_divide(F.sum(a * b), F.sqrt(F.sum(a * a) * F.sum(b * b)))
    distance = F.when(F.col("cosine").isNotNull(), F.sqrt(F.greatest(2 - 2 * F.col("cosine"), F.lit(0.0))))
    return per_term.agg(cosine.alias("cosine")).select(
        F.round(distance, 4).alias("euclidean_mean_distance"), F.round("cosine", 4).alias("cosine_mean_similarity")
    )


def feature_table(df: DataFrame, column: str, carry: Sequence[str], dimension: int = DIMENSION, model: TermModel | None = None) -> DataFrame:
    """(carry, features): one sparse vector per document, of zeros where it has no term; stored."""
    model = model or term_model(df, column, dimension)
    return cut_lineage(model.features(df, column, carry))


@dataclass(frozen=True)
class Projection:
    """A centre and two axes in the space of the features."""

    centre: list[float]
    axes: list[list[float]]

    def place(self, features: DataFrame) -> DataFrame:
        """Adds ``x`` and ``y``; the features go."""
        axes, centre = np.array(self.axes), np.array(self.centre)
        shift = centre @ axes

        @F.arrow_udf("struct<x:double,y:double>")
        def placed(vectors: pa.Array) -> pa.Array:
            places, offsets = lists(vectors.field("indices"))
            values, _ = lists(vectors.field("values"))
            owner = np.repeat(np.arange(len(vectors)), np.diff(offsets))
            at = [np.bincount(owner, values * axes[places, i], len(vectors)) - shift[i] for i in range(2)]
            return pa.StructArray.from_arrays([pa.array(c) for c in at], names=["x", "y"])

        rest = [c for c in features.columns if c != "features"]
        return features.select(*rest, placed("features").alias("__p")).select(*rest, "__p.x", "__p.y")


def principal_axes(features: DataFrame, tolerance: float = 1e-10, passes: int = 50, block: int = 10, seed: int = 0) -> Projection:
    """The two directions of largest variance, by randomised block Krylov iteration on sparse vectors.

    Each pass multiplies a block of directions by the covariance: tasks add up ``x (x . v)`` over
    their rows. The driver holds directions only: it adds what is new in the products as
    the next block and takes the best two directions in the span of all blocks. It ends when they
    are eigenvectors up to ``tolerance``, or after ``passes``. The largest entry of each axis is positive;
    directions without variance are zero. Without rows there are no axes.
    """
    stored = features.select(sparse_parts("features").alias("__s")).select(F.col("__s.places").alias("places"), F.col("__s.counts").alias("counts"))
    head = features.select("features").first()
    if head is None:
        return Projection([], [])
    width = head["features"].size
    context = features.sparkSession.sparkContext

    def covariance(directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The covariance times the directions, and the mean vector: one pass."""
        shared, rank = context.broadcast(directions), directions.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            table = np.zeros((rank + 2, width))  # the last row holds the number of vectors
            for batch in pieces(batches):
                places, offsets = lists(batch.column("places"))
                values, _ = lists(batch.column("counts"))
                owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
                for i in range(rank):
                    along = np.bincount(owner, values * known[places, i], batch.num_rows)
                    table[i] += np.bincount(places, values * along[owner], width)
                table[rank] += np.bincount(places, values, width)
                table[rank + 1, 0] += batch.num_rows
            yield from emit(table)

        out = summed(stored.mapInArrow(run, SUMS), rank + 2, width)
        shared.destroy()
        mean = out[rank] / out[rank + 1, 0]
        return out[:rank].T / out[rank + 1, 0] - np.outer(mean, mean @ directions), mean

    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, min(width, block))))[0]
    fresh, images = basis, np.zeros((width, 0))
    for _ in range(passes):
        image, mean = covariance(fresh)
        images = np.hstack([images, image])
        inner = basis.T @ images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        best, spread = turn[:, ::-1][:, :2], values[::-1][:2]
        lead, scale = basis @ best, max(spread[0], 1e-300)
        if np.abs(images @ best - lead * spread).max(initial=0) <= tolerance * scale:
            break
        for _ in range(2):  # once more against rounding
            image = image - basis @ (basis.T @ image)
        fresh, size, _ = np.linalg.svd(image, full_matrices=False)
        fresh = fresh[:, size > 1e-13 * scale][:, : width - basis.shape[1]]
        if not fresh.shape[1]:
            break
        basis = np.hstack([basis, fresh])
    axes = np.zeros((width, 2))
    rounding = 1e-14 * (mean @ mean)  # of second moments less the mean's: equal vectors leave no more than that
    axes[:, : lead.shape[1]] = lead * (spread > max(1e-12 * scale, rounding))
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), [0, 1]])
    return Projection(mean.tolist(), (axes * np.where(signs == 0, 1, signs)).tolist())


def project_2d(features: DataFrame, train: Column) -> DataFrame:
    """Two principal components fitted on the train rows; adds ``x`` and ``y``, centred on train."""
    found = principal_axes(features.filter(train))
    if not found.axes:
        none = F.lit(None).cast("double")
        return features.drop("features").withColumns({"x": none, "y": none})
    return found.place(features)


def projection_histogram(projected: DataFrame, side: Column, bins: int = BINS) -> DataFrame:
    """(dimension, side, bin, low, width, density) of the projected rows, equal bins over both sides.

    If all values of a dimension are equal they lie in bin 0, with a null density.
    """
    points = projected.select(
        side.alias("side"),
        F.inline(
            F.array(
                F.struct(F.lit("x").alias("dimension"), F.col("x").alias("value")),
                F.struct(F.lit("y").alias("dimension"), F.col("y").alias("value")),
            )
        ),
    )
    ranges = points.groupBy("dimension").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    # Two rows, one per dimension.
    placed = points.join(F.broadcast(ranges), "dimension").withColumn(
        "bin", F.when(width > 0, F.least(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(bins - 1))).otherwise(0).cast("int")
    )
    counted = placed.groupBy("dimension", "side", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("dimension", "side"))  # at most ``bins`` rows each
    return counted.select(
        "dimension",
        "side",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        width.alias("width"),
        F.try_divide(F.col("n"), total * width).alias("density"),
    )


def domain_classifier(
    features: DataFrame, label: str, held_out: str, trees: int = 100, seed: int = 1234, binary: bool = False
) -> DataFrame:
    """Held-out accuracy and AUC (one class against the rest, averaged) of a forest that guesses ``label``."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, seed=seed, probabilityCol="__p", rawPredictionCol="__r", predictionCol="__y"
    )
    model = forest.fit(features.filter(~F.col(held_out)))
    guessed = model.transform(features.filter(held_out)).select(
        label, (F.col("__y") == F.col(label)).cast("int").alias("right"), vector_to_array("__p").alias("p")
    )
    classes = guessed.select("right", label, F.posexplode("p").alias("class", "score"))
    if binary:
        classes = classes.filter("class = 1")
    is_class = (F.col(label) == F.col("class")).cast("int")
    per_class = roc_auc(classes.withColumn("hit", is_class), "score", "hit", ["class"])
    auc = per_class.agg(F.avg("auc")).scalar()
    return guessed.agg(F.round(F.avg("right"), 4).alias("accuracy")).withColumn("auc_score", F.round(auc, 4))


def drift_sides(
    ref: DataFrame, column: str, key: Sequence[str], cur: DataFrame | None, n_splits: int, seed: int, model: TermModel | None = None
) -> tuple[DataFrame, str]:
    """(rows with ``fold``, ``side`` and ``held_out``, key column).

    One table: folds dealt by length, one ``n_splits``-th of every fold is the other
    side. Two tables: the second is the other side, half of each is held out. With a ``model`` the
    texts become ``features``, stored before anything is dealt: the dealing reads its rows several times.
    """
    def named(df):
        return df.select(F.concat_ws(":", *key).alias("doc"), F.col(column).alias("text"))

    def ready(df):
        return df if model is None else feature_table(df, "text", [c for c in df.columns if c != "text"], model=model)

    if cur is None:
        measured = ready(named(ref).withColumn("token_length", word_count(F.col("text"))))
        dealt = length_dealt_folds(measured, F.col("token_length"), n_splits, seed, ["doc"])
        held = stratified_holdout(dealt.drop("token_length"), ["fold"], 1 / n_splits, seed, ["doc"])
        return held.withColumn("side", F.col("held_out")), "doc"
    both = named(ref).withColumn("fold", F.lit(0)).unionByName(named(cur).withColumn("fold", F.lit(1)))
    both = ready(both.withColumn("doc", F.concat_ws("|", "fold", "doc")))
    return stratified_holdout(both, ["fold"], 0.5, seed, ["doc"]).withColumn("side", F.col("fold") == 1), "doc"


def dealt_features(
    ref: DataFrame, column: str, key: Sequence[str], cur: DataFrame | None, n_splits: int, seed: int, dimension: int = DIMENSION
) -> tuple[TermModel, DataFrame]:
    """The model of the texts of both sides, and (doc, fold, side, held_out, features), stored."""
    model = term_model(ref if cur is None else ref.select(column).unionAll(cur.select(column)), column, dimension)
    rows, doc = drift_sides(ref, column, key, cur, n_splits, seed, model)
    return model, cut_lineage(rows.select(doc, "fold", "side", "held_out", "features"))


@dataclass(frozen=True)
class DriftResult:
    """One row of figures, every document's place, and the histograms of the places by side."""

    summary: DataFrame
    projected: DataFrame
    histogram: DataFrame


def detect_drift(
    ref: DataFrame,
    column: str,
    key: Sequence[str],
    cur: DataFrame | None = None,
    *,
    n_splits: int = 5,
    dimension: int = DIMENSION,
    trees: int = 100,
    seed: int = 1234,
) -> DriftResult:
    """Mean-vector distance and cosine, how well a forest tells the folds apart, and the projections."""
    # Read by the means, the projection and the forest.
    model, features = dealt_features(ref, column, key, cur, n_splits, seed, dimension)
    means = mean_vector_drift(model.weights(features, ["doc", "side"]), F.col("side"))
    forest = domain_classifier(features, "fold", "held_out", trees, seed, binary=cur is not None)
    summary = means.withColumn("accuracy", forest.select("accuracy").scalar()).withColumn(
        "auc_score", forest.select("auc_score").scalar()
    )
    projected = project_2d(features, ~F.col("side"))
    return DriftResult(summary, projected, projection_histogram(projected, F.col("side")))


@dataclass(frozen=True)
class DriftProfile:
    """What a reference table leaves behind for comparing later tables: its size is fixed by ``dimension`` and ``bins``."""

    rows: int
    model: TermModel
    projection: Projection
    low: list[float]
    width: list[float]
    shares: list[list[float]]  # of the reference's rows, by dimension and bin


def _bins(placed: DataFrame, low: Sequence[float], width: Sequence[float], bins: int) -> list[list[float]]:
    """Shares of the rows by dimension and bin; the first and the last bin are open."""
    def bin_of(c: str, i: int) -> Column:
        place = F.floor((F.col(c) - low[i]) / width[i]) if width[i] > 0 else F.lit(0)
        return F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).cast("int")

    each = [F.struct(F.lit(i).alias("dimension"), bin_of(c, i).alias("bin")) for i, c in enumerate("xy")]
    counted = placed.select(F.inline(F.array(*each))).groupBy("dimension", "bin").count().collect()
    out = np.zeros((2, bins))
    for row in counted:
        out[row["dimension"], row["bin"]] = row["count"]
    return (out / np.maximum(out.sum(axis=1, keepdims=True), 1)).tolist()


def reference_profile(ref: DataFrame, column: str, dimension: int = DIMENSION, bins: int = BINS) -> DriftProfile:
    """Vocabulary and document frequencies, mean vector, projection and histogram of a reference table."""
    model = term_model(ref, column, dimension)
    features = feature_table(ref, column, [], model=model)
    found = principal_axes(features)
    if not found.axes:
        raise ValueError("a reference needs rows")
    placed = found.place(features)
    ends = placed.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in "xy" for f in (F.min, F.max)]).first()
    low = [ends["min_x"], ends["min_y"]]
    width = [(ends["max_x"] - low[0]) / bins, (ends["max_y"] - low[1]) / bins]
    return DriftProfile(ends["n"], model, found, low, width, _bins(placed, low, width, bins))


def write_profile(spark: SparkSession, profile: DriftProfile, path: str) -> str:
    """Store a profile as one line of JSON."""
    spark.createDataFrame([(json.dumps(asdict(profile)),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_profile(spark: SparkSession, path: str) -> DriftProfile:
    found = json.loads(spark.read.text(path).first()["value"])
    return DriftProfile(**{**found, "model": TermModel(**found["model"]), "projection": Projection(**found["projection"])})


def compare_to_profile(profile: DriftProfile, cur: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(summary, histogram) of a table against a profile; the reference is not read.

    The summary has the distance and cosine of the mean vectors, null if one of them is zero, and
    for each projected dimension the share of mass that both histograms have in common. One pass makes the
    vectors, which are stored without the texts.
    """
    spark, bins = cur.sparkSession, len(profile.shares[0])
    features = feature_table(cur, column, [], model=profile.model)
    found = features.groupBy(F.lit(True).alias("all")).agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("features")).alias("mean")).first()
    a = np.array(profile.projection.centre)
    n, b = (found["n"], found["mean"].toArray()) if found else (0, np.zeros(len(a)))
    lengths = float(np.linalg.norm(a) * np.linalg.norm(b))
    cosine = float(a @ b) / lengths if lengths else None
    distance = float(np.sqrt(max(2 - 2 * cosine, 0.0))) if lengths else None
    shares = _bins(profile.projection.place(features), profile.low, profile.width, bins)
    common = [float(np.minimum(p, q).sum()) for p, q in zip(profile.shares, shares)]
    facts = (profile.rows, int(n), *[None if v is None else round(v, 4) for v in (distance, cosine, *common)])
    summary = spark.createDataFrame(
        [facts],
        "reference_rows long, rows long, euclidean_mean_distance double, cosine_mean_similarity double, common_x double, common_y double",
    )
    bars = [
        (c, k, profile.low[i] + k * profile.width[i], profile.width[i], profile.shares[i][k], shares[i][k])
        for i, c in enumerate("xy") for k in range(bins)
    ]
    columns = "dimension string, bin int, low double, width double, reference_share double, share double"
    return summary, spark.createDataFrame(bars, columns)
