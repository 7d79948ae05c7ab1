"""Top-k search, hard negatives and lexical search against brute force and hand-made edge rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from modsieve.llm import bond, lexical, maxscore, shards

VECTORS = "vec_id bigint, embedding array<float>, label int, score string, id int, q string"


def vectors(seed, n, width=6, spread=0.3):
    rng = np.random.default_rng(seed)
    out = [(i, rng.normal(0, spread, width).astype(np.float32).tolist(), int(i) % 3) for i in range(n)]
    out += [(n, None, 1), (n + 1, [], 0), (n + 2, [0.1, None, 0.2, 0.0, 0.0, 0.0], 1)]
    out += [(n + 3, [math.nan] + [0.5] * (width - 1), 1), (n + 4, [math.inf] + [0.5] * (width - 1), 1)]
    out += [(None, [0.5] * width, 1), (n + 5, [0.0] * width, 0), (n + 6, [0.5] * width, None), (n + 7, [0.9, 0.9], 2)]
    out += [(n + 8 + i, out[4][1], out[4][2]) for i in range(8)]  # ties
    return [*out, out[5], out[5]]  # repeated rows


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, x, "clash", 7, "clash") for i, v, x in rows], VECTORS).repartition(3)


def codes(rows, scale):
    good = [(i, v, x) for i, v, x in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(scale * c) for c in v], x) for i, v, x in good]


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, asked, k, scale):
    known, out = codes(rows, scale), []
    for i, q in {(i, tuple(v)) for i, v, _ in codes(asked, scale)}:
        found = sorted((-inner(q, v), j) for j, v, _ in known if j != i)[:k]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, n, k, components", [(1, 120, 5, 1 << 22), (2, 90, 20, 60), (3, 40, 500, 1 << 22)])
def test_top_k(spark, monkeypatch, seed, n, k, components):
    monkeypatch.setattr(shards, "RUN_QUERIES", 4)
    rows = vectors(seed, n)
    df = frame_of(spark, rows)
    got = maxscore.top_k(df, df.where("vec_id % 5 = 0"), k=k, shard_components=components)
    asked = [r for r in rows if r[0] is not None and r[0] % 5 == 0]
    assert sorted(map(tuple, got.collect())) == brute_top(rows, asked, k, 64)


@pytest.mark.parametrize("share", [0.0, 0.7])
def test_maxscore_leaves_lists_out_and_rows_unprobed(share):
    """Skewed sizes, once as columns and once as lists: lists are left out, most rows are never probed."""
    rng = np.random.default_rng(5)
    table = np.floor(64 * rng.normal(0, 1, (4000, 24)) * (0.7 ** np.arange(24)))
    table[rng.random(table.shape) < share] = 0
    table[rng.random(table.shape) < share] = 0
    known, probed = maxscore.Postings(np.arange(4000), table, 500), []
    assert (known.lists is not None) == (share > 0)
    probe = known.probe
    known.probe = lambda *a: (probed.append((len(a[1]), len(a[3]))), probe(*a))[1]
    left_out = 0
    for q in range(0, 4000, 200):
        probed.clear()
        scores, ids = known.best(q, table[q], 20)
        whole = table @ table[q]
        whole[q] = -np.inf
        want = np.lexsort((np.arange(4000), -whole))[:20]
        assert ids.tolist() == want.tolist() and scores.tolist() == whole[want].tolist()
        if scores[-1] > 0:
            left_out += sum(cut > 0 for cut, _ in probed[-2:])
            assert sum(n for _, n in probed[-2:]) < 500
    assert left_out >= 5


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**30, 1.0, 3.0], 0), (1, [2.0**24, 1.0, 0.0], 0), (2, [2.0**24, 0.5, 0.0], 0), (3, [-1.0, 0.0, 0.0], 1), (4, [3e38, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in maxscore.top_k(df, df, scale=64).collect()}
    for i, v, _ in rows:
        for j, w, _ in rows:
            if i != j:
                exact = inner([math.floor(64 * c) for c in v], [math.floor(64 * c) for c in w])
                assert got[i, j] == min(max(exact, -(2**63)), 2**63 - 1)
    assert bond.hard_negatives(df, df, scale=64).count() >= 0


@pytest.mark.parametrize("side", ["rows", "queries", "both"])
def test_search_on_empty_tables(spark, side):
    df = frame_of(spark, vectors(1, 10))
    rows, asked = df.where(F.lit(side == "queries")), df.where(F.lit(side == "rows"))
    assert maxscore.top_k(rows, asked).collect() == []
    assert bond.hard_negatives(rows, asked).collect() == []


def brute_negatives(rows, asked, scale, positives=5, negatives=5, low=80, high=100):
    known, out = [r for r in codes(rows, scale) if r[2] is not None], []
    for i, a, x in {(i, tuple(v), x) for i, v, x in codes(asked, scale) if x is not None}:
        near = sorted((-inner(a, v), j, y) for j, v, y in known if j != i)
        found = [(-s, j) for s, j, y in near if y == x][:positives]
        for place, (p, pid) in enumerate(found, 1):
            window = [(-s, j) for s, j, y in near if y != x and low * p <= -100 * s <= high * p][:negatives]
            out += [(i, pid, rank, j, p, s, place) for rank, (s, j) in enumerate(window, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, n, components, low, high", [(1, 150, 1 << 22, 80, 100), (2, 120, 100, 80, 100), (3, 90, 1 << 22, 20, 130)])
def test_hard_negatives(spark, monkeypatch, seed, n, components, low, high):
    monkeypatch.setattr(shards, "RUN_QUERIES", 4)
    monkeypatch.setattr(bond, "STEP", 2)
    rows = vectors(seed, n)
    df = frame_of(spark, rows)
    got = bond.hard_negatives(df, df.where("vec_id % 4 = 0"), low_percent=low, high_percent=high, shard_components=components)
    asked = [r for r in rows if r[0] is not None and r[0] % 4 == 0]
    want = brute_negatives(rows, asked, 256, low=low, high=high)
    assert sorted(map(tuple, got.collect())) == want and want


def test_bond_bounds_shrink_the_bitmap():
    rng = np.random.default_rng(8)
    table = np.floor(256 * rng.normal(0, 1, (3000, 40)) * (0.6 ** np.arange(40)))
    part = shards.Part(np.arange(3000), table, ["x"] * 3000, None, [])
    known, alive = bond.Columns(part, table), []
    decide = bond.reaches_best(5)
    rows, scores = known.scan(table[7], np.arange(3000), lambda a, b: (alive.append(len(a)), decide(a, b))[1])
    whole = table @ table[7]
    assert sorted(scores[np.argsort(-scores)][:5]) == sorted(np.sort(whole)[-5:])
    assert alive[0] == 3000 and alive[2] < 300


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    bags = [(i, Counter(t), len(t)) for i, x in docs if (t := terms(x))]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for name, text in sorted(set(items), key=str):
        found = []
        for i, bag, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(weight[t] * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t in terms(text) if t in bag)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(name, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "A1", "x"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " -- \n"), (None, text(30)), (303, text(20_000)), (304, "w5," * 500 + "x" * 3000)]
    docs += [(305 + i, docs[3][1]) for i in range(30)] + [docs[7], docs[7]]
    items = [(1, text(12)), (2, None), (3, ""), (4, "?!"), (5, "unknown words only zz"), (6, "W1 w1 w1 W50"), (7, text(400)), (8, docs[3][1]), (8, "日本 été Été"), (9, "w0"), (9, "w0"), (10, "x" * 3000)]
    return docs, items


@pytest.mark.parametrize("k, block, run", [(20, 1 << 22, 1 << 20), (3, 100, 50), (1000, 1 << 22, 7)])
def test_ranked_search(spark, corpus, monkeypatch, k, block, run):
    monkeypatch.setattr(lexical, "RUN_POSTINGS", run)
    docs, items = corpus
    d = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id bigint, text string, name string, q int").repartition(3)
    b = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id bigint, text string, score double")
    got = lexical.ranked_search(d, b, k=k, block_bytes=block)
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items, k)


def test_ranked_search_on_empty_tables(spark, corpus):
    d = spark.createDataFrame(corpus[0], "doc_id bigint, text string")
    b = spark.createDataFrame(corpus[1], "item_id bigint, text string")
    assert lexical.ranked_search(d.limit(0), b).collect() == []
    assert lexical.ranked_search(d, b.limit(0)).collect() == []


def test_long_texts_are_counted_in_pieces():
    data = ("abc déf " * 400 + "q" * 900 + " abc").encode()
    raw = np.frombuffer(data, np.uint8)
    cut = [p.tobytes() for p in lexical.pieces(raw, 64)]
    assert b"".join(cut) == data and len(cut) > 20
    assert Counter(t for p in cut for t in terms(p.decode())) == Counter(terms(data.decode()))


def test_no_accumulators_are_made_for_common_terms():
    """With k strong documents the postings of common terms only update survivors."""
    queries = lexical.Queries([("a", "rare common")])
    df = np.array([40, 5000])[np.argsort(np.argsort(queries.vocabulary[[0, 1]]))]
    number = {w: int(queries.numbers(lexical.term_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0])[1][0]) for w in ("rare", "common")}
    df = np.zeros(2, np.int64)
    df[number["rare"]], df[number["common"]] = 40, 5000
    scorer = lexical.Scorer(queries, 5000, 50_000, df, 20)
    assert scorer.lists[0][0] == [number["rare"], number["common"]]
    docs = np.arange(5000)
    lists = [(docs[:40], np.full(40, 1000), 1000, 1), (docs, np.full(5000, 3), 3, 1)]
    found, scores = scorer.accumulate(lists, 5000, np.zeros(0, np.int64))
    assert found.tolist() == list(range(40)) and set(scores.tolist()) == {1003}
