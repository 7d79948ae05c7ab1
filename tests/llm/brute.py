"""Plain rewritings of the contracts, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def secrets(text):
    text = text or ""
    base = []
    for m in re.finditer(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 12:
            base.append((m.start(), 0, "assign", m.end()))
    base += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    base.sort()
    n = Counter(b[2] for b in base)
    return n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in base))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contaminated(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known = defaultdict(set)
    for name, text in items:
        w = word.findall(lower(text))
        n = min(13, len(w))
        for i in range(len(w) - n + 1):
            if n:
                known[n].add((tuple(w[i : i + n]), name))
    where = {n: defaultdict(set) for n in known}
    for n, pairs in known.items():
        for words, name in pairs:
            where[n][words].add(name)
    out = []
    for doc, text in docs:
        w = word.findall(lower(text))
        hit, names = set(), set()
        for n in where:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in where[n]:
                    hit.update(range(i, i + n))
                    names |= where[n][tuple(w[i : i + n])]
        names.discard(None)
        out.append(
            (doc, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit) and 20 * len(hit) >= len(w))
        )
    return out


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard(docs, size=4, percent=85):
    """Doc id to (set size, component), by comparing all pairs."""
    sets = {}
    for doc, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        if len(w) < size:
            sets[doc] = {tuple(w)} if w else set()
        else:
            sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    inverse = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            inverse[x].append(doc)
    links = []
    for doc, s in sets.items():
        both = Counter(o for x in s for o in inverse[x] if o < doc)
        for other, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                links.append((doc, other))
    parts = smallest_reachable(sets, links)
    return {doc: (len(s), parts[doc]) for doc, s in sets.items()}


def embeddings(rows, threshold=0.95):
    import math

    def sound(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, v) for i, v in rows if sound(v)]
    links = []
    for k, (i, v) in enumerate(good):
        for j, w in good[:k]:
            if len(v) == len(w):
                cos = sum(a * b for a, b in zip(v, w)) / math.sqrt(sum(a * a for a in v)) / math.sqrt(sum(b * b for b in w))
                if cos >= threshold:
                    links.append((i, j))
    n = Counter(x for pair in links for x in pair)
    parts = smallest_reachable([i for i, _ in rows], links)
    return {i: (n[i], parts[i], parts[i] == i) for i, _ in rows}


def drop_bytes(docs, length=400):
    """Doc id to (bytes, removed, spans, digest of the rest)."""
    seen = Counter()
    raw = [(doc, (text or "").encode()) for doc, text in docs]
    for _, b in raw:
        seen.update(hash(b[i : i + length]) for i in range(len(b) - length + 1))
    out = []
    for doc, b in raw:
        gone, until, spans = bytearray(len(b)), 0, 0
        for i in range(len(b) - length + 1):
            if seen[hash(b[i : i + length])] > 1:
                spans += i > until or not gone[i - 1 : i] == b"\x01"
                for j in range(max(i, until), i + length):
                    gone[j] = 1
                until = i + length
        flags = bytes(gone)
        spans = len(re.findall(b"\x01+", flags))
        out.append((doc, len(b), sum(flags), spans, sha(bytes(x for x, g in zip(b, flags) if not g))))
    return out


def drop_words(docs, length=20):
    """Doc id to (words, removed, digest of the rest); ids in ascending order count as earlier."""
    seen, out = set(), []
    for doc, text in sorted(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            if key in seen:
                gone[i : i + length] = [True] * length
            else:
                seen.add(key)
        out.append((doc, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out
