"""HTML extraction, licences, quality, mixing and the pipeline on hand-made rows."""

import math
import os
import random
import re
import time
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from modsieve.llm import html_text, jaccard, licences, mixing, quality
from modsieve.session import cut_lineage, release, shared_dir


def page(i, body, head="<header><a href='/'>Home</a></header>"):
    return (
        f"<html><head><title>t{i}</title><style>p{{}}</style></head><body>{head}<nav><ul><li>menu</ul></nav>"
        f"<div class='cookie-notice'>We use cookies</div>{body}<aside>side</aside>"
        "<section id=comments><article>first!</article></section><form><p>mail</p></form><footer>&copy; us</footer></body></html>"
    )


def test_html_cases(spark):
    body = "<article><h1>A &amp; B</h1><p>one <b>two</b>\n  three<br>four<p>five &lt;tag&gt; &amp;amp;<script>var a='</p>'</script></article>"
    plain = "<div class='wrap'><p>Shared line of the site</p><p>text of {0}</p></div>"
    rows = [
        (1, "https://a.example/x", page(1, body)), (2, None, None), (3, "nonsense", ""), (4, "https://a.example/y", "no markup at all"),
        (5, "https://a.example/z", page(5, "<article><p>cut off &am")),
        (6, "https://a.example/w", "<article><p>a < b and c</p><!-- open"), (7, "https://a.example/v", "<body><nav>only menu</nav></body>"),
        (8, "https://a.example/u", "<div>" * 3000 + "deep" + "</div>" * 3000),
    ]
    rows += [(i, f"https://B.example:80/{i}", page(i, plain.format(i))) for i in range(20, 40)]
    rows += [(40, "https://B.example/copy", page(39, plain.format(39)))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string").repartition(3)
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()}
    assert got[1] == "A & B\n\none two three four\n\nfive <tag> &amp;"
    assert got[2] == got[3] == got[7] == ""
    assert got[4] == "no markup at all" and got[5] == "cut off &am" and got[6] == "a < b and c" and got[8] == "deep"
    # The line that all pages of the host share is template; copies of one page are not.
    assert {got[i] for i in range(20, 41)} == {f"text of {i}" for i in range(20, 40)}


def test_html_of_the_given_pages(spark, sf_dir):
    """A plain reading of the given pages' one layout."""
    import html as h

    def plain(source):
        source = re.sub(r"(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->", "", source)
        m = re.search(r"(?s)<article>(.*?)(</article>|<footer|\Z)", source)
        text = re.sub(r"<[^>]*\Z", "", m[1] if m else "")
        parts = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|li|ul|div)>", "\0", text.replace("<br>", " "))).split("\0")
        return "\n\n".join(x for x in (" ".join(h.unescape(p).split()) for p in parts) if x)

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in corpus_pipeline.QUERIES["op3_html"](spark, sf_dir).collect():
        assert r["text"] == plain(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    "page, text",
    [
        ('<body><article><p>Story.</p></article><article class="comment"><p>Nice!</p></article></body>', "Story."),
        ('<article><p>Story.</p><article class="comment">Nice!</article></article>', "Story."),
        ('<body class="no-sidebar"><div class="content no-sidebar"><article><p>Story.</p></article></div></body>', "Story."),
        ('<div class="page-without-menu"><article>Story.</article></div>', "Story."),
        ('<article><p class="ad-hoc">One.</p><div class="search-results">Two.</div><p class="ad">Buy</p><div class="ad-slot">Buy</div></article>', "One.\n\nTwo."),
        ('<article><p data-x="hidden">One.</p><p title=" hidden ">Two.</p><p title="class=menu">Three.</p><p hidden>Four.</p><p HIDDEN="">Five.</p></article>', "One.\n\nTwo.\n\nThree."),
        ('<div id="site-footer">Foot</div><main><div class="sidebar-left">Side</div><p>Story.</p><div class="cookie-banner">Yes?</div></main>', "Story."),
        ('<article role="main" id=post-12><p>Story.</p><div role="complementary">More</div></article>', "Story."),
    ],
)
def test_names_of_parts(page, text):
    assert html_text.main_text(html_text.parse(page)) == text


def test_licences(spark):
    mit = "Released under the MIT License."
    rows = [
        ("a/LICENSE", "Licensed under the Apache License, Version 2.0."), ("a/b/c/x.py", "code\nmore"), ("a/b/own.py", f"# {mit}\nimport a, b\nfor x in y:\n    print(x)"),
        ("a/b/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."), ("a/y.py", None), ("a/z.py", ""),
        ("top.py", "the license of this is unknown under version 2"), (None, "no path"), (None, None),
        ("d/two.py", f"{mit}\n\nLicensed under CC BY-NC 4.0.\n"), ("d/three.py", "x"), ("ab/q.py", "q"),
        ("long.py", "word " * 60_000 + "\n" + mit), ("twice.py", "x"), ("twice.py", mit),
    ]
    df = spark.createDataFrame([(p, t, "clash") for p, t in rows], "path string, text string, licences string").repartition(3)
    got = {r["path"]: (r["licences"], r["origin"], r["licence_dir"]) for r in licences.scan_licences(df).collect()}
    assert got == {
        "a/LICENSE": (["Apache-2.0"], "file", None), "a/b/COPYING.txt": (["GPL-3.0"], "file", None),
        "a/b/c/x.py": (["GPL-3.0"], "inherited", "a/b"), "a/b/own.py": (["MIT"], "header", None),
        "a/y.py": (["Apache-2.0"], "inherited", "a"), "a/z.py": (["Apache-2.0"], "inherited", "a"),
        "top.py": (["MIT"], "inherited", ""), None: ([], "none", None),
        "d/two.py": (["CC-BY-NC-4.0", "MIT"], "header", None), "d/three.py": (["MIT"], "inherited", ""),
        "ab/q.py": (["MIT"], "inherited", ""), "long.py": (["MIT"], "header", None), "twice.py": (["MIT"], "file", None),
    }
    empty = spark.createDataFrame([], "path string, text string")
    assert licences.scan_licences(empty).collect() == []


def test_licences_are_not_taken_for_others(spark):
    """Notices that the given tables do not hold, among files that hold the frequent ones."""
    usual = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0."]
    cases = {
        "Licensed under the ISC License.": ["ISC"], "Licensed under the BSD 3-Clause License.": ["BSD-3-Clause"], "Eclipse Public License 2.0": ["EPL-2.0"],
        "This program is licensed under the GNU Affero General Public License, version 3.": ["AGPL-3.0"], "Licensed under the GNU General Public License, version 2.": ["GPL-2.0"],
        "Licensed under the BSD License.": ["BSD"], "Licensed under the Apache License, Version 1.1.": ["Apache-1.1"], "Licensed under the Apache License, Version 7.3.": [], "Licensed under the Apache License.": ["Apache"],
        "Licensed under the Quux License.": [], "This work is licensed under the Frobnicate Public License, version 3.": [], "SPDX-License-Identifier: MIT": ["MIT"],
        "SPDX-License-Identifier: LicenseRef-Quux": [], "Licensed under CC BY-SA 3.0.": ["CC-BY-SA-3.0"], "Licensed under GPLv3.": ["GPL-3.0"],
        "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\n  13. Use with the GNU Affero General Public License.\n": ["GPL-3.0"],
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Keep it.\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": ["BSD-3-Clause"],
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": ["ISC"],
        "they ate under the tree and read the public notice": [],
    }
    rows = [(f"n{i}/f.py", f"word{i} other words\n{usual[i % 4]}") for i in range(240)] + [(f"p{i}/f.py", f"the plain prose number {i} under a tree") for i in range(4000)]
    rows += [(f"c{i}/f.py", text) for i, text in enumerate(cases)]
    df = spark.createDataFrame(rows, "path string, text string").repartition(3)
    got = {r["path"]: r["licences"] for r in licences.scan_licences(df).collect()}
    assert {text: got[f"c{i}/f.py"] for i, text in enumerate(cases)} == cases
    assert all(len(got[f"n{i}/f.py"]) == 1 for i in range(240)) and not any(got[f"p{i}/f.py"] for i in range(4000))


def test_denied_joined_and_short_notices(spark):
    rows = [
        ("a/f.py", "# This is not licensed under the MIT License.\nx"), ("b/f.py", "// SPDX-License-Identifier: (Apache-2.0 OR MIT)\nx"),
        ("c/f.py", "/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note AND BSD-3-Clause */"),
        ("d/f.py", "# Released under the MIT License.\nprint('one line of code')"), ("d/g.py", "x"),
        ("e/f.py", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ]
    rows += [(f"p{i}/f.py", f"the plain prose number {i} under a tree") for i in range(400)]
    got = {r["path"]: (r["licences"], r["origin"]) for r in licences.scan_licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/f.py"] == ([], "none")
    assert got["b/f.py"] == (["Apache-2.0", "MIT"], "header")
    assert got["c/f.py"] == (["BSD-3-Clause", "GPL-2.0"], "header")
    assert got["d/f.py"] == (["MIT"], "header") and got["d/g.py"] == ([], "none")
    assert got["e/f.py"] == (["MPL-2.0"], "file")


def test_licences_equal_brute_force_cosines(spark, monkeypatch):
    """Lines cut from statements and mixed with other words: the tests before the cosine lose none and add none."""
    monkeypatch.setattr(licences, "COMMON_TERMS", 30)
    rng = random.Random(21)
    noise = [f"word{i}" for i in range(60)] + ["the", "of", "software", "version", "license"]
    lines = []
    for i in range(400):
        some = licences._python_terms(rng.choice(licences.STATEMENTS)[1])
        rng.shuffle(some)
        lines.append(" ".join(some[: rng.randrange(1, len(some) + 1)] + rng.choices(noise, [1 / (k + 1) for k in range(len(noise))], k=rng.randrange(0, 9))))
    rows = [(f"d{i}/f.py", line) for i, line in enumerate(lines)]
    bags = [Counter(licences._python_terms(t)) for t in lines]
    df = Counter(t for b in bags for t in b)
    idf = {t: math.log((1 + len(rows)) / (1 + max(1, df[t]))) + 1 for t in [*df, *(t for _, x in licences.STATEMENTS for t in licences._python_terms(x))]}
    vectors = [(name, licences.weights(Counter(licences._python_terms(text)), idf)) for name, text in licences.STATEMENTS]
    want = {}
    for (path, _), bag in zip(rows, bags):
        x = {t: n * idf[t] for t, n in bag.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        cosines = [(round(sum(v * vector.get(t, 0) for t, v in x.items()) / norm, 6), name) for name, vector in vectors]
        best = max(c for c, _ in cosines)
        names = {name for c, name in cosines if c == best and name} if best >= 0.75 else set()
        want[path] = {n for n in names if not any(o != n and o.startswith(n + "-") and o[len(n) + 1].isdigit() for o in names)}
    got = {r["path"]: set(r["licences"]) for r in licences.scan_licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == want and sum(map(bool, want.values())) > 60


def test_licence_prefilter_loses_nothing():
    """Every segment without a needed term stays below the threshold."""
    rng = random.Random(2)
    count = [Counter(licences._python_terms(t)) for _, t in licences.STATEMENTS]
    idf = {t: rng.uniform(0.5, 9) for c in count for t in c}
    for counts in count:
        vector = licences.weights(counts, idf)
        needed = licences.needed_terms(vector, 0.75)
        rest = [t for t in vector if t not in needed]
        for _ in range(50):
            segment = Counter(rng.choices(rest, k=rng.randrange(1, 30))) if rest else Counter()
            x = {t: n * idf[t] for t, n in segment.items()}
            norm = math.sqrt(sum(v * v for v in x.values())) or 1
            assert sum(v * vector[t] for t, v in x.items()) / norm < 0.75


def labelled(rng, n):
    rows, labels = [], []
    for i in range(n):
        kind = i % 4
        text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "river", "stone"]) + rng.choice(["", "s", "ing"]) for _ in range(60))
        if kind == 1:
            text += " you are vilegrub" + rng.choice(["a", "b", "c"]) + " " + text[:50]
        if kind == 2:
            text = " | ".join(text.upper().split()) + "!!! ### %%%"
        rows.append((i, text, "s0" if i % 3 else f"s{i % 7}", "en"))
        labels.append((i, int(kind != 2), int(kind == 1)))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = labelled(random.Random(4), 800)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").repartition(3)
    known = spark.createDataFrame(labels[:400], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["__v"]["rejected"] for r in quality.judge(docs, known, max_train=120).collect()}
    wrong = sum(got[i] != (i % 4 in (1, 2)) for i in range(400, 800))
    assert wrong <= 4


def test_quality_edges(spark):
    rows, labels = labelled(random.Random(4), 200)
    rows += [(900, None, None, None), (901, "", "s1", None), (None, "plain words", "s0", "en"), rows[0], (902, "stone river " * 20_000, "s0", "en")]
    schema = "doc_id bigint, text string, source string, lang string"
    docs = spark.createDataFrame(rows, schema)
    nulls = [(None, 1, 0), (5, None, None), (5, 0, 1), (999, 1, 1)]
    known = spark.createDataFrame(labels + nulls, "doc_id bigint, quality int, toxic int")
    got = quality.judge(docs, known).collect()
    assert len(got) == len(rows)
    assert not any(r["__v"]["rejected"] for r in got if not r["text"])
    none = quality.judge(docs, known.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["__v"]["rejected"] for r in none)
    assert quality.judge(docs.limit(0), known).collect() == []


def test_site_rates_shrink(spark):
    """Posterior rates lie between a path's own rate and the global one, nearer to it for few rows."""
    rows = [("a", "p", 1000, 500), ("a", "q", 4, 4), ("b", "p", 1000, 100), ("b", None, 1, 0)]
    paths = spark.createDataFrame([(s, p, n, k * quality.SCALE) for s, p, n, k in rows], "__site string, __path string, n bigint, s bigint")
    rates, total = quality._rates(paths)
    got = {(r["__site"], r["__path"]): (r["site_rate"], r["path_rate"]) for r in rates.collect()}
    assert total == pytest.approx(604 / 2005)
    assert total < got["a", "p"][0] < 504 / 1004 and 100 / 1001 < got["b", "p"][0] < total
    assert abs(got["a", "p"][1] - 0.5) < 0.01 and got["a", "q"][1] < 0.95


def test_mixing(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), "big") for i in range(300)]
    rows += [(i, " ".join(["w"] * rng.randrange(1, 40)), "mid") for i in range(300, 380)]
    rows += [(i, "w w w", "tiny") for i in range(380, 384)] + [(390, "a\tb  c\n", None), (391, "", "big"), (392, None, "void")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    size = {i: len((t or "").split()) for i, t, _ in rows}
    total = Counter()
    for i, _, s in rows:
        total[s] += size[i]
    everything = sum(total.values())
    for entropy, limit in ((0.9, 3.0), (0.99, 1000.0), (0.0, 4.0)):
        got = mixing.mix(df, entropy=entropy, max_repeat=limit, block_tokens=100).collect()
        used, seen = Counter(), defaultdict(Counter)
        for r in got:
            used[r["source"]] += size[r["doc_id"]]
            seen[r["source"]][r["doc_id"]] += 1
            assert r["__m"]["n_tokens"] == size[r["doc_id"]]
        weight = {r["source"]: r["__m"]["weight"] for r in got}
        assert sum(weight.values()) == pytest.approx(1, abs=1e-6)
        for s, w in weight.items():
            largest = max(size[i] for i, _, x in rows if x == s)
            assert w * everything - largest - 1 <= used[s] <= w * everything + 1e-3
            assert used[s] <= limit * total[s] + 1e-6
            copies = [seen[s][i] for i, _, x in rows if x == s and size[i]]
            assert max(copies) - min(copies) <= 1  # whole epochs, and part of one more
        h = -sum(w * math.log(w) for w in weight.values())
        if limit > 100:
            assert h >= entropy * math.log(len(weight)) - 1e-3
        if entropy == 0:
            assert all(w == pytest.approx(total[s] / everything, abs=1e-6) for s, w in weight.items())
    assert mixing.mix(df.limit(0)).collect() == []
    again = mixing.mix(df.repartition(7), entropy=0.9, max_repeat=3.0, block_tokens=100)
    assert sorted(map(str, again.collect())) == sorted(map(str, mixing.mix(df, entropy=0.9, max_repeat=3.0, block_tokens=100).collect()))


def test_stages_against_plain_code(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_copies", "decontaminate", "secrets", "mixing"]

    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages["quality"](spark, docs, sf_dir).collect()}
    assert all((i in kept) == (r["quality"] == 1 and r["toxic"] == 0) for i, r in labels.items())

    want = {i for i, (_, part) in brute.jaccard(list(given.items()), 5, 80).items() if i == part}
    got = stages["near_copies"](spark, docs, sf_dir)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == sorted(want)

    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {r[0] for r in brute.contaminated(list(given.items()), items) if not r[-1]}
    assert {r["doc_id"] for r in stages["decontaminate"](spark, docs, sf_dir).collect()} == want

    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["secrets"](spark, docs, sf_dir).collect()}
    assert set(masked) == set(given)
    for i, (text, n) in masked.items():
        assert n == len(text) and brute.secrets(text)[:3] == (0, 0, 0)
        assert text == given[i] or brute.secrets(given[i])[:3] != (0, 0, 0)


def test_pipeline_edges(spark, tmp_path, sf_dir):
    rows = [
        (1, None, "en", "s", None), (2, "", None, None, 0), (3, "a b c d e f g", "en", "s", 13), (3, "a b c d e f g", "en", "s", 13),
        (4, "a b c d e f g", "en", "s", 13), (None, "token = abcdefghijklmnop", "en", "s", 24), (5, "x " * 30_000, "en", "s", 60_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    here = str(tmp_path)
    for name in ("labels", "benchmark"):
        os.symlink(f"{sf_dir}/{name}.parquet", f"{here}/{name}.parquet")
    stage = docs
    for name, function in corpus_pipeline.STAGES[:4]:
        stage = function(spark, stage, here)
        stage.write.parquet(f"{here}/{name}")
        stage = spark.read.parquet(f"{here}/{name}")
        assert stage.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"]) for r in stage.collect() if r["doc_id"] != 5)
    assert got == [(0, "[secret]"), (1, None), (2, ""), (3, "a b c d e f g")]
    for table in ("documents",):
        docs.limit(0).write.parquet(f"{here}/{table}.parquet")
    assert corpus_pipeline.run(spark, here).collect() == []


def test_near_copies_keep_every_text_of_an_id(spark, sf_dir):
    import corpus_pipeline

    rng = random.Random(12)
    a, b, c = (" ".join(f"w{rng.randrange(500)}" for _ in range(120)) for _ in range(3))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (3, b + " z", "x"), (3, c, "x"), (None, a, "x"), (4, None, "x"), (4, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(2)
    got = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert got.columns == docs.columns
    kept = [tuple(r) for r in got.collect()]
    assert sorted(map(str, kept))[:3] == sorted(map(str, [(1, a, "x"), (2, b, "x"), (3, c, "x")]))
    assert (None, a, "x") in kept and len(kept) == 5


def test_near_copies_store_few_sets(spark, sf_dir, monkeypatch):
    """Documents that share a third of their phrases with others, and one near copy."""
    rng, seen, plain = random.Random(8), [], jaccard._small
    monkeypatch.setattr(jaccard, "_small", lambda keys: seen.append(keys.count()) or plain(keys))
    phrase = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(10))
    pool = [phrase() for _ in range(15)]
    texts = [" ".join(rng.choice(pool) if rng.random() < 0.33 else phrase() for _ in range(40)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate([*texts, f"{texts[7]} end"])), "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()}
    assert got == set(range(40)) and seen[0] < 10


def test_tables_that_nothing_needs_leave_the_disk(spark):
    def files():
        return [f for d, _, names in os.walk(shared_dir(spark)) for f in names if f.startswith("part-")]

    release(spark)
    time.sleep(2)
    before = len(files())
    kept = cut_lineage(spark.range(100).repartition(7))
    assert len(files()) == before + 7 and kept.count() == 100
    del kept
    release(spark)
    until = time.time() + 20
    while len(files()) > before and time.time() < until:
        time.sleep(0.2)
    assert len(files()) <= before
