"""Near-duplicate embeddings by int8 tile products with exact error bounds.

Unit vectors are written as ``scale * codes + rest`` with int8 codes. For two of them

    |x.y - scale_x * scale_y * codes_x.codes_y| <= |scale_x codes_x| |rest_y| + |rest_x| |y|

so a tile of whole-number products tells which pairs may reach the threshold; only those
are computed again from the given components in double precision. Exact copies are one row
with a count. Tiles are dealt as pairs of blocks by an equi-join on the block pair, each row
copied once per block, so a task holds two blocks whatever the table's size. A task sends
back link counts per vector and a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.llm.components import components
from modsieve.session import cut_lineage

BLOCK_ROWS = 4096
TILE = 1024
#: Above float32 rounding of codes products scaled by two factors and of the bound itself.
SLACK = 1e-5


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the exact norms of what the codes leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    scale[scale == 0] = 1
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rest = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, rest


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision; norms do not overflow."""
    return np.einsum("ij,ij->i", x, y)


def units_of(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of linked pairs of two blocks of unit vectors (``i < j`` inside one block)."""
    ca, sa, ra = quantise(a)
    cb, sb, rb = (ca, sa, ra) if same else quantise(b)
    fa, fb = ca.astype(np.float32), cb.astype(np.float32)  # whole numbers below 2**24: exact
    norm_a = np.linalg.norm(ca * sa[:, None], axis=1)
    left, right = [], []
    for i in range(0, len(a), TILE):
        for j in range(i if same else 0, len(b), TILE):
            ti, tj = slice(i, i + TILE), slice(j, j + TILE)
            approx = (fa[ti] @ fb[tj].T) * (sa[ti, None] * sb[None, tj]).astype(np.float32)
            most = approx + (norm_a[ti, None] * rb[None, tj] + ra[ti, None]).astype(np.float32)
            p, q = np.nonzero(most >= np.float32(threshold - SLACK))
            p, q = p + i, q + j
            if same:
                p, q = p[p < q], q[p < q]
            for k in range(0, len(p), 1 << 16):
                u, v = p[k : k + (1 << 16)], q[k : k + (1 << 16)]
                yes = cosines(a[u], b[v]) >= threshold
                left.append(u[yes])
                right.append(v[yes])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the smallest node of its component, by repeated hooking."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def embedding_links(
    embeddings: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector row: ``id, n_links, component_id, kept``.

    Vectors link when their cosine, in double precision, reaches ``threshold``. A vector that
    is null, zero, or holds a null or non-finite component links with nothing, and vectors of
    different length do not link with each other. Copies (repeated rows too) link with each
    other. A row with a null id takes no part: no links, a null component, not kept. Other
    columns are ignored. An empty table gives an empty result.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    big = F.array_max(F.transform("v", lambda x: F.abs(x)))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & (big > 0)
    good = rows.where("id is not null and v is not null").where(F.size("v") > 0).where(sound)
    groups = good.groupBy("v").agg(F.min("id").alias("g"), F.count(F.lit(1)).alias("m"))
    groups = cut_lineage(groups)
    total = groups.count()
    blocks = max(1, -(-total // block_rows))

    # Each vector goes to the pairs (its block, any block), smaller first.
    own = F.pmod(F.xxhash64("g"), F.lit(blocks)).cast("int")
    dealt = groups.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select(
        (F.least("own", "other") * blocks + F.greatest("own", "other")).cast("long").alias("pair"),
        (F.col("own") == F.least("own", "other")).alias("first"), "own", "other", "g", "m", "v",
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        same = bool((pdf["own"] == pdf["other"]).iloc[0])
        out = []
        width = pdf["v"].map(len)
        for _, part in pdf.groupby(width):
            a = part if same else part[part["first"]]
            b = a if same else part[~part["first"]]
            if not len(a) or not len(b):
                continue
            ua, ub = units_of(np.stack(a["v"].to_numpy())), None
            ub = ua if same else units_of(np.stack(b["v"].to_numpy()))
            i, j = tile_links(ua, ub, same, threshold)
            if not len(i):
                continue
            ids = a["g"].to_numpy() if same else np.concatenate([a["g"], b["g"]])
            times = a["m"].to_numpy() if same else np.concatenate([a["m"], b["m"]])
            j = j if same else j + len(a)
            count = np.bincount(i, times[j], len(ids)) + np.bincount(j, times[i], len(ids))
            order = np.argsort(ids, kind="stable")
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            node, root = forest(rank[i], rank[j], len(ids))
            sorted_ids = ids[order]
            to = sorted_ids.copy()
            to[node] = sorted_ids[root]
            used = count[order] > 0
            out.append(
                pd.DataFrame({"a": sorted_ids[used], "b": to[used], "n": count[order][used].astype(np.int64)})
            )
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")

    met = cut_lineage(dealt.groupBy("pair").applyInPandas(compare, "a bigint, b bigint, n bigint"))
    counts = met.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "g")
    known = components(met.where("a <> b").select("a", "b")).withColumnRenamed("node", "g")
    table = groups.join(counts, "g", "left").join(known, "g", "left")
    table = table.select(
        F.col("v").alias("tv"), (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "g").alias("component_id"),
    )
    # Only groups that link are joined back, so a hot vector is at most one key, split by AQE.
    table = table.where("n_links > 0")
    out = rows.join(table, F.col("v") == F.col("tv"), "left")
    part = F.coalesce("component_id", "id")
    part = F.when(F.col("id").isNull(), F.lit(None)).otherwise(part)
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        part.alias("component_id"),
        F.coalesce(F.col("id") == part, F.lit(False)).alias("kept"),
    )
