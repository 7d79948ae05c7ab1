"""Document quality by hierarchical empirical Bayes.

Two small classifiers give each document's own evidence: harmful words (hashed words and
word beginnings) and a poor shape (tables, shouting, symbols, repetition). Their joint
probability is summed per path (site and section) and per site; a site's rate is drawn
towards the global rate, a path's rate towards its site's, the more the fewer documents
there are. How strongly is estimated from the rates' own spread. The posterior of a
document adds its path's log-odds, against the global ones, to its own.

The classifiers are fitted on the driver on at most ``max_train`` labelled documents per
class and label, taken in hash order. Everything else covers all documents: scoring is one
narrow pass, and the grouped sums are whole numbers, combined before they move, so a hot
site is no single task's work and the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modsieve.llm import features, units
from modsieve.session import cut_lineage

MAX_TRAIN = 2500
SCALE = 1 << 20  # probabilities are summed as whole numbers of this fraction


@dataclass
class Classifiers:
    """Weights of both classifiers; all sizes are fixed by the feature dimension."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float
    centre: np.ndarray
    spread: np.ndarray
    shape_weights: np.ndarray
    shape_bias: float

    def score(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of harmful words and of a poor shape; a text without words gets zeros."""
        n = len(docs) - 1
        rows, places = features.terms(data, docs, self.kept)
        harmful = _sigmoid(np.bincount(rows, self.weights[places], minlength=n) + self.bias)
        standard = np.clip((features.shapes(data, docs) - self.centre) / self.spread, -8, 8)
        poor = _sigmoid(standard @ self.shape_weights + self.shape_bias)
        starts, _, offsets = units.words(data, docs, units.NOT_SPACE)
        full = np.diff(offsets) > 0
        return np.where(full, harmful, 0.0), np.where(full, poor, 0.0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam; the last place is the bias."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for i in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-6)
    return w


def _fit_terms(documents: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on term presence, scaled by the terms' log-odds ratios.

    Terms that are seen less than three times or lean to neither side stay at zero; only the
    others are put together, so memory follows them and not all terms of the sample.
    """
    n, size = len(labels), features.DIMENSION
    weights = np.zeros(size)
    if n == 0 or labels.min() == labels.max():
        return weights, -30.0 if n == 0 or labels.max() == 0 else 30.0
    seen = np.zeros((2, size), np.int32)
    for places, label in zip(documents, labels):
        seen[label, places] += 1  # a document has each term once
    neg, pos = seen
    lean = np.log((pos + 0.5) / (labels.sum() + 0.5)) - np.log((neg + 0.5) / (n - labels.sum() + 0.5))
    lean[(pos + neg < 3) | (np.abs(lean) < np.log(4))] = 0
    kept = [places[lean[places] != 0] for places in documents]
    rows = np.repeat(np.arange(n), [len(k) for k in kept])
    names, at = np.unique(np.concatenate(kept), return_inverse=True)
    values = lean[names][at]

    def gradient(w: np.ndarray) -> np.ndarray:
        error = _sigmoid(np.bincount(rows, w[at] * values, minlength=n) + w[-1]) - labels
        g = np.bincount(at, error[rows] * values, minlength=len(w)) / n + 1e-4 * w
        g[-1] = error.mean()
        return g

    w = _descend(gradient, len(names) + 1, 80)
    weights[names] = w[:-1] * lean[names]
    return weights, float(w[-1])


def _fit_shapes(shape: np.ndarray, labels: np.ndarray):
    centre, spread = np.zeros(features.SHAPES), np.ones(features.SHAPES)
    if len(labels) == 0 or labels.min() == labels.max():
        return centre, spread, np.zeros(features.SHAPES), -30.0 if len(labels) == 0 or labels.max() == 0 else 30.0
    centre, spread = shape.mean(0), shape.std(0) + 1e-3
    x = np.clip((shape - centre) / spread, -8, 8)

    def gradient(w: np.ndarray) -> np.ndarray:
        error = _sigmoid(x @ w[:-1] + w[-1]) - labels
        return np.append(x.T @ error / len(labels) + 1e-4 * w[:-1], error.mean())

    w = _descend(gradient, features.SHAPES + 1, 400)
    return centre, spread, w[:-1], float(w[-1])


def fit(documents: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN) -> Classifiers:
    """Fit both classifiers on at most ``4 * max_train`` labelled documents, in hash order.

    Null labels, unlabelled documents and null texts are not used. A document with several
    labels counts as harmful if one says so and as good if none denies it. Without examples
    of both sides a classifier gives the same answer for all.
    """
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality")
    )
    order = F.xxhash64("doc_id", F.lit(17))
    picked = None
    for column, value in (("toxic", 1), ("toxic", 0), ("quality", 0), ("quality", 1)):
        part = one.where(F.col(column) == value).orderBy(order, "doc_id").limit(max_train)
        picked = part if picked is None else picked.unionByName(part)
    # At most 4 * max_train rows by construction.
    picked = F.broadcast(picked.dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "label_id"))
    rows = (
        documents.select("doc_id", "text")
        .where(F.col("text").isNotNull())
        .join(picked, F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "text", F.col("toxic").cast("int"), F.col("quality").cast("int"))
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, docs in units.chunks(batch.column(1)):
                row, place = features.terms(data, docs)
                edges = np.searchsorted(row, np.arange(last - first + 1))
                shape = features.shapes(data, docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        batch.column(3).slice(first, last - first),
                        pa.array([place[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
                        pa.array([s.astype("<f4").tobytes() for s in shape], pa.binary()),
                    ],
                    names=["doc_id", "toxic", "quality", "places", "shape"],
                )

    found = rows.mapInArrow(describe, "doc_id bigint, toxic int, quality int, places binary, shape binary")
    sample = sorted(found.collect(), key=lambda r: r[0])
    places = [np.frombuffer(r["places"], "<i4") for r in sample]  # views
    shape = np.array([np.frombuffer(r["shape"], "<f4") for r in sample], float).reshape(len(sample), features.SHAPES)

    has = np.array([r["toxic"] is not None for r in sample], bool)
    toxic = np.array([r["toxic"] for r in sample if r["toxic"] is not None], int)
    weights, bias = _fit_terms([p for p, h in zip(places, has) if h], toxic)
    has = np.array([r["quality"] is not None for r in sample], bool)
    poor = np.array([1 - r["quality"] for r in sample if r["quality"] is not None], int)
    return Classifiers(weights != 0, weights, bias, *_fit_shapes(shape[has], poor))


def evidence(documents: DataFrame, model: Classifiers, *, text_col: str = "text") -> DataFrame:
    """All columns of the documents, and a struct ``__e`` of ``harmful, poor, own`` probabilities."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = documents.columns
    place = names.index(text_col)
    kind = pa.struct([("harmful", pa.float64()), ("poor", pa.float64()), ("own", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, docs in units.chunks(batch.column(place)):
                harmful, poor = shared.value.score(data, docs)
                own = 1 - (1 - harmful) * (1 - poor)
                given = pa.StructArray.from_arrays([pa.array(np.round(x, 9)) for x in (harmful, poor, own)], fields=list(kind))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, given], names=[*batch.schema.names, "__e"])

    schema = documents.withColumn(
        "__e", F.lit(None).cast("struct<harmful:double,poor:double,own:double>")
    ).schema
    return documents.mapInArrow(run, schema)


def log_odds(p: Column) -> Column:
    held = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(held / (1 - held))


def _strength(groups: DataFrame, rate: float) -> float:
    """How many documents the prior counts for: from the spread of the groups' rates."""
    noise = rate * (1 - rate)
    row = groups.where("n > 1").agg(
        F.count(F.lit(1)).alias("groups"),
        F.avg((F.col("s") / F.col("n") - rate) ** 2).alias("spread"),
        F.avg(noise / F.col("n")).alias("chance"),
    ).first()
    if not row["groups"] or noise == 0:
        return 100.0
    between = max(row["spread"] - row["chance"], noise / 10_000)
    return float(min(max(noise / between - 1, 1.0), 10_000.0))


def judge(
    documents: DataFrame,
    labels: DataFrame,
    *,
    site_col: str = "source",
    path_col: str = "lang",
    max_train: int = MAX_TRAIN,
    threshold: float = 0.8,
) -> DataFrame:
    """All columns of the documents, and ``__v``: probabilities, rates, posterior, ``rejected``.

    A document is rejected when its posterior reaches ``threshold``. Null sites and paths
    form groups of their own. A null or empty text has no evidence and is kept. Repeated
    rows count as often as they occur. Without labels nothing is rejected.
    """
    model = fit(documents, labels, max_train=max_train)
    narrow = documents.select(F.col(site_col), F.col(path_col), "text")
    sums = evidence(narrow, model).select(F.col(site_col).alias("__site"), F.col(path_col).alias("__path"), "__e")
    grouped = cut_lineage(
        sums.groupBy("__site", "__path").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("__e.own") * SCALE).cast("long")).alias("s")
        )
    )
    rates, rate = _rates(grouped)
    scored = evidence(documents, model).alias("d")
    on = F.col(f"d.{site_col}").eqNullSafe(F.col("r.__site")) & F.col(f"d.{path_col}").eqNullSafe(F.col("r.__path"))
    own, empty = F.col("d.__e.own"), F.col("d.__e.own") == 0
    shift = log_odds(F.col("r.path_rate")) - log_odds(F.lit(rate))
    posterior = F.when(empty, F.lit(0.0)).otherwise(1 / (1 + F.exp(-(log_odds(own) + shift))))
    verdict = F.struct(
        F.col("d.__e.harmful").alias("harmful"),
        F.col("d.__e.poor").alias("poor"),
        F.round("r.site_rate", 9).alias("site_rate"),
        F.round("r.path_rate", 9).alias("path_rate"),
        F.round(posterior, 6).alias("posterior"),
        (F.round(posterior, 6) >= threshold).alias("rejected"),
    )
    return scored.join(rates.alias("r"), on, "left").select(
        *[F.col(f"d.`{c}`") for c in documents.columns], verdict.alias("__v")
    )


def _rates(paths: DataFrame) -> tuple[DataFrame, float]:
    paths = paths.select("__site", "__path", "n", (F.col("s") / SCALE).alias("s"), F.col("s").alias("whole"))
    sites = paths.groupBy("__site").agg(F.sum("n").alias("n"), (F.sum("whole") / SCALE).alias("s"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("whole").alias("s")).first()
    rate = (total["s"] or 0) / SCALE / total["n"] if total["n"] else 0.0
    top, low = _strength(sites, rate), _strength(paths, rate)
    sites = sites.select("__site", ((F.lit(top * rate) + F.col("s")) / (F.lit(top) + F.col("n"))).alias("site_rate"))
    posterior = (F.lit(low) * F.col("s.site_rate") + F.col("p.s")) / (F.lit(low) + F.col("p.n"))
    joined = paths.alias("p").join(sites.alias("s"), F.col("p.__site").eqNullSafe(F.col("s.__site")))
    return joined.select("p.__site", "p.__path", "s.site_rate", posterior.alias("path_rate")), rate
