"""Windows that occur more than once, found shard by shard.

Texts are rows of units (bytes or words). Every window of ``length`` units belongs to the
smallest k-gram in it (its *anchor*), which its content alone decides, so equal windows
have equal anchors at equal places. Neighbouring windows with one anchor are a *run*. Runs
go to the shard of their anchor; an anchor that occurs once is done. Runs that are equal as
a whole are settled as one. What remains, different runs around one anchor, is fetched as
text, and each shard builds an index over its runs (the operator's own) that finds the
windows they share. A shard is a bounded number of units; one anchor with more than that is
not indexed but has its windows counted one by one, by a combining aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.keys import running_total
from modsieve.llm import units
from modsieve.session import cut_lineage

SHARD_UNITS = 1 << 18
HOT_UNITS = 1 << 19
BROADCAST_ROWS = 1_000_000
_HALF = units.U64(0xD1342543DE82EF95)
_INVERSE = units.U64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_tables: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    if key not in _tables or len(_tables[key]) < n:
        full = np.full(max(n, 1 << 21), base)
        full[0] = 1
        _tables[key] = np.multiply.accumulate(full)
    return _tables[key]


@dataclass(frozen=True)
class Windows:
    """Windows of ``length`` units, met by k-grams of ``k``.

    ``split(bytes, document offsets)`` gives unit hashes and the documents' offsets in them.
    With ``earlier`` only windows with an earlier equal one count, else all with an equal one.
    """

    length: int
    k: int
    earlier: bool
    split: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def anchors(u: np.ndarray, w: Windows, step: int = 1 << 23) -> tuple[np.ndarray, np.ndarray]:
    """Place of every window's smallest k-gram, and all k-gram hashes.

    K-grams are compared by their upper 40 bits, equal ones by place; long texts are taken in steps, so that
    the rule is the same for texts of any length.
    """
    grams, width = units.grams(u, w.k), w.length - w.k + 1
    mask = units.U64((1 << 24) - 1)
    found = []
    for low in range(0, len(grams) - width + 1, step):
        part = grams[low : low + step + width - 1]
        tagged = (part & ~mask) | np.arange(len(part), dtype=np.uint64)
        found.append((units.sliding(tagged, width, np.minimum) & mask).astype(np.int64) + low)
    return np.concatenate(found), grams


def runs_of(u: np.ndarray, offsets: np.ndarray, w: Windows):
    """Document, first start, number of starts, anchor hash and content hash of every run."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if len(u) < w.length:
        return none
    anchor, grams = anchors(u, w)
    doc = np.searchsorted(offsets, np.arange(len(anchor)), side="right") - 1
    valid = np.arange(len(anchor)) + w.length <= offsets[doc + 1]
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(anchor)))
    use = valid[first]
    first, count = first[use], count[use]
    if not len(first):
        return none
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(u * _power(_HALF, len(u))[: len(u)], dtype=np.uint64)])
    stop = first + count - 1 + w.length
    content = (total[stop] - total[first]) * _power(_INVERSE, len(u))[first]
    shape = count.astype(np.uint64) * units.U64(1 << 20) + (anchor[first] - first).astype(np.uint64)
    return doc[first], first - offsets[doc[first]], count, grams[anchor[first]], units.mix(content + units.mix(shape))


_PACKED = "part int, anchor binary, content binary, doc binary, start binary, n binary"


def _spread(w: Windows, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def out() -> pa.RecordBatch:
            anchor, content, doc, start, n = (np.concatenate(x) for x in zip(*held))
            part = (anchor % units.U64(parts)).astype(np.int64)
            order = np.lexsort((doc, part))
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            rows = []
            for p in np.flatnonzero(np.diff(edges)):
                take = order[edges[p] : edges[p + 1]]
                rows.append(
                    (int(p), anchor[take].tobytes(), content[take].tobytes(), doc[take].tobytes(),
                     start[take].astype("<i4").tobytes(), n[take].astype("<i4").tobytes())
                )
            kinds = [pa.int32()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "anchor", "content", "doc", "start", "n"]
            )

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last, data, docs in units.chunks(batch.column(1)):
                u, offsets = w.split(data, docs)
                doc, start, n, anchor, content = runs_of(u, offsets, w)
                if len(doc):
                    held.append((anchor, content, ids[first:last][doc], start, n))
                    size += len(doc)
                if size >= 300_000:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return run


def _meet(earlier: bool):
    """Per part: settle equal runs, and name the different ones that share an anchor.

    ``settled`` runs have their windows counted already; ``open`` ones go to the index.
    """

    def settle(pieces) -> pa.RecordBatch | None:
        anchor, content, doc, start, n = (np.concatenate(x) for x in zip(*pieces))
        order = np.lexsort((start, doc, content, anchor))
        anchor, content, doc, start, n = (x[order] for x in (anchor, content, doc, start, n))
        if earlier:  # a repeated row is not earlier than itself
            once = np.ones(len(anchor), bool)
            once[1:] = (start[1:] != start[:-1]) | (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
            anchor, content, doc, start, n = (x[once] for x in (anchor, content, doc, start, n))
        new_anchor = np.ones(len(anchor), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new = new_anchor.copy()
        new[1:] |= content[1:] != content[:-1]
        kind = np.cumsum(new) - 1
        group = np.cumsum(new_anchor) - 1
        different = np.bincount(group[new], minlength=group[-1] + 1)[group] > 1
        copied = np.bincount(kind)[kind] > 1
        settled = (copied & ~new) if earlier else copied
        is_open = new & different
        use = settled | is_open
        if not use.any():
            return None
        columns = (doc, start.astype(np.int32), n.astype(np.int32), anchor.astype(np.int64), settled, is_open)
        return pa.RecordBatch.from_arrays([pa.array(c[use]) for c in columns], names=["doc", "start", "n", "anchor", "settled", "open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pieces = None, []
        for batch in batches:
            for p, *cells in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    if pieces and (found := settle(pieces)) is not None:
                        yield found
                    part, pieces = p, []
                kinds = (np.uint64, np.uint64, np.int64, np.int32, np.int32)
                pieces.append(tuple(np.frombuffer(c, k) for c, k in zip(cells, kinds)))
        if pieces and (found := settle(pieces)) is not None:
            yield found

    return run


def _fetch(w: Windows, pack: Callable):
    """Cut the open runs out of their documents; ``pack(bytes, unit starts, ends)`` gives what is indexed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            wanted = batch.column(2)
            for first, last, data, docs in units.chunks(batch.column(1)):
                u, offsets = w.split(data, docs)
                body = pack(data, u)
                rows = []
                for i in range(first, last):
                    low, high = int(offsets[i - first]), int(offsets[i - first + 1])
                    for r in wanted[i].as_py():
                        a = low + r["start"]
                        b = a + r["n"] - 1 + w.length
                        if b <= high:
                            rows.append((r["anchor"], ids[i].as_py(), r["start"], r["n"], r["settled"], body[a:b].tobytes()))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["anchor", "doc", "start", "n", "settled", "body"],
                    )

    return run


def _search(w: Windows, dtype: str, shared: Callable):
    """Index the open runs shard by shard; rows come sorted by anchor, document and start.

    ``shared(text, starts, counts, settled)`` flags the windows of a shard that count: the
    runs' units lie one after another in ``text`` from ``starts`` on, with ``counts`` windows.
    """

    def settle(rows) -> pa.RecordBatch | None:
        text = np.concatenate([r[4] for r in rows])
        sizes = np.array([len(r[4]) for r in rows])
        starts = np.cumsum(sizes) - sizes
        counts = np.array([r[2] for r in rows])
        flags = shared(text, starts, counts, sizes)
        out = []
        at = np.cumsum(counts) - counts
        for (doc, start, n, done, _), i in zip(rows, at):
            if done and not w.earlier:
                continue
            for a, b in zip(*units.runs(flags[i : i + n])):
                out.append((doc, start + int(a), int(b - a)))
        if not out:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32()))], names=["doc", "start", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for anchor, doc, start, n, done, body in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != last and size >= SHARD_UNITS:
                    if (found := settle(rows)) is not None:
                        yield found
                    rows, size = [], 0
                last = anchor
                rows.append((doc, start, n, done, np.frombuffer(body, dtype)))
                size += len(rows[-1][4])
        if rows and (found := settle(rows)) is not None:
            yield found

    return run


def _each_window(w: Windows, dtype: str):
    """Content hash of every single window of a run, for anchors too frequent to index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, start, n, body in zip(*(c.to_pylist() for c in batch.select(["doc", "start", "n", "body"]).columns)):
                u = units.mix(np.frombuffer(body, dtype).astype(np.uint64) + units.U64(1))
                one, two = units.grams(u, w.length), units.grams(units.mix(u), w.length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.astype(np.int64)), pa.array(two.astype(np.int64)), pa.array(np.full(n, doc)),
                     pa.array(np.arange(start, start + n, dtype=np.int32))],
                    names=["h1", "h2", "doc", "start"],
                )

    return run


def small(keys: DataFrame) -> DataFrame:
    """A checkpointed table of ids, marked for broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def distinct_ids(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``texts`` (id, text, more) with an id for every different text, and ``(id, given)`` if any id was changed.

    Ids that name several texts would mix up their spans. Only then all rows with an id are numbered anew, in the
    order of ids, texts of one id by their digests; equal rows keep sharing a number. Otherwise the
    rows come back as they are: a hash of each text, combined where it is read, tells.
    """
    hashed = texts.where("id is not null").select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    if hashed.groupBy("id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").isEmpty():
        return texts, None
    keyed = texts.withColumn("digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    rows = keyed.where("id is not null").select("id", "digest").distinct().withColumn("one", F.lit(1))
    numbers = running_total(rows, ["id", "digest"], "one", "number").select(
        F.col("id").alias("given"), F.col("digest").alias("__digest"), F.col("number").cast("long").alias("number")
    )
    numbers = cut_lineage(numbers)
    both = keyed.join(numbers, (F.col("id") == F.col("given")) & (F.col("digest") == F.col("__digest")), "left")
    more = [c for c in texts.columns if c not in ("id", "text")]
    return both.select(F.col("number").alias("id"), "text", *more), numbers.select(F.col("number").alias("id"), "given")


def given_ids(rows: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """``rows`` with the ids that were given instead of the numbers of ``distinct_ids``."""
    if numbers is None:
        return rows
    others = [c for c in rows.columns if c != "id"]
    return rows.join(numbers.withColumnRenamed("id", "__number"), F.col("id") == F.col("__number"), "left").select(F.col("given").alias("id"), *others)


def repeated_windows(texts: DataFrame, w: Windows, pack: Callable, dtype: str, shared: Callable) -> DataFrame:
    """``doc, spans``: the starts of windows that count, as runs ``(start, n)``; see Windows.

    ``texts`` has ``id bigint, text string``; rows without an id or a text take no part.
    """
    spark = texts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = texts.where("id is not null and text is not null")
    spread = named.mapInArrow(_spread(w, 4 * n), _PACKED).repartition(n, "part").sortWithinPartitions("part")
    met = spread.mapInArrow(_meet(w.earlier), "doc bigint, start int, n int, anchor bigint, settled boolean, open boolean")
    met = cut_lineage(met)

    wanted = met.where("open").groupBy("doc").agg(
        F.collect_list(F.struct("start", "n", "anchor", "settled")).alias("wanted")
    )  # at most one row per window of a document
    wanted = cut_lineage(wanted)
    some = named.join(small(wanted.select(F.col("doc").alias("id"))), "id", "left_semi")
    some = some.join(wanted.withColumnRenamed("doc", "id"), "id").select("id", "text", "wanted")
    schema = "anchor bigint, doc bigint, start int, n int, settled boolean, body binary"
    bodies = cut_lineage(some.mapInArrow(_fetch(w, pack), schema))

    width = np.dtype(dtype).itemsize
    hot = bodies.groupBy("anchor").agg(F.sum(F.octet_length("body") / width).alias("size")).where(F.col("size") > HOT_UNITS)
    hot = cut_lineage(hot.select("anchor"))
    few = small(hot)
    shards = bodies.join(few, "anchor", "left_anti").repartition(n, "anchor")
    shards = shards.sortWithinPartitions("anchor", "doc", "start")
    found = shards.mapInArrow(_search_columns(w, dtype, shared), "doc bigint, start int, n int")
    runs = met.where("settled").select("doc", "start", "n").unionByName(found)
    if not hot.isEmpty():
        each = bodies.join(few, "anchor", "left_semi")
        singles = each.mapInArrow(_each_window(w, dtype), "h1 bigint, h2 bigint, doc bigint, start int")
        first = singles.groupBy("h1", "h2").agg(F.min(F.struct("doc", "start")).alias("f"), F.count(F.lit(1)).alias("m"))
        both = singles.join(first.where("m > 1"), ["h1", "h2"])
        if w.earlier:
            both = both.where((F.col("doc") != F.col("f.doc")) | (F.col("start") != F.col("f.start")))
        runs = runs.unionByName(both.select("doc", "start", F.lit(1).alias("n")))
    return runs.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``id, text, spans`` for all texts; only those with spans meet them in a shuffle."""
    spans = cut_lineage(spans.withColumnRenamed("doc", "id"))
    ids = small(spans.select("id"))
    touched = texts.join(ids, "id", "left_semi").join(spans, "id").select("id", "text", "spans")
    empty = F.expr("cast(array() as array<struct<start:int,n:int>>)").alias("spans")
    return touched.unionByName(texts.join(ids, "id", "left_anti").select("id", "text", empty))


def _search_columns(w: Windows, dtype: str, shared: Callable):
    inner = _search(w, dtype, shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return inner(b.select(["anchor", "doc", "start", "n", "settled", "body"]) for b in batches)

    return run
