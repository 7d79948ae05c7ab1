"""Main text of web pages by wrapper induction.

Pages of a host share a template. A few pages of each host, drawn by hash, are its examples.
Every page's tree is aligned with those of its host's examples by simple tree matching: two
nodes match if their labels agree, and their children are aligned in order for the largest
number of matched nodes. Neighbouring children with one label (paragraphs, list items) are
one repeated slot. A matched node whose text is the same in most examples belongs to the
template; slots whose text varies are content. Examples that are copies of the page itself
have no vote. Parts whose tag or class names their role (menus, adverts, forms, ...) go in
any case, also on hosts with a single page.

Examples are at most ``EXAMPLES`` pages per host and reach the pages by a join on the host,
so a host with a third of all pages is spread like any other rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modsieve.session import cut_lineage

EXAMPLES = 4
_CACHE = 256
#: Examples of at most so many bytes in all are broadcast; more reach the pages by a shuffle.
BROADCAST_BYTES = 32 << 20
BROADCAST_ROWS = 1_000_000

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption option optgroup html body".split())
#: A start tag closes an open element of the second kind, up to the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
# What parts of a page are for, by tag, and by words of their class, id or role.
DROP_TAGS = frozenset(
    "head nav footer aside form button select input textarea script style title noscript template iframe object embed "
    "svg canvas audio video map dialog menu".split()
)
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead "
    "comment comments replies respond disqus related recommended share sharing social newsletter subscribe subscription "
    "login signup search toolbar pagination pager skip complementary contentinfo dialog".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# What a name's last part says about a place, not about its content; and parts that turn a name round.
PLACES = frozenset(
    "list box wrapper wrap container section area block bar left right top bottom slot unit widget panel item items "
    "links form inner group posts column zone label title link links".split()
)
TURNED = frozenset("no not non without with has hide hidden".split())


class Node:
    __slots__ = ("tag", "dropped", "label", "children", "parent", "template", "_text", "_runs")

    def __init__(self, tag: str, names: frozenset[str], parent: "Node | None", dropped: bool = False):
        self.tag, self.dropped, self.parent = tag, dropped or "#hidden" in names, parent
        self.label = (tag, names)
        self.children: list[Node | str] = []
        self.template = False
        self._text: str | None = None
        self._runs: list[list[Node]] | None = None

    @property
    def text(self) -> str:
        """All text below, with single spaces (iterative, so depth does not matter)."""
        if self._text is None:
            out, stack = [], [self]
            while stack:
                x = stack.pop()
                if isinstance(x, str):
                    out.append(x)
                else:
                    stack.extend(reversed(x.children))
            self._text = " ".join("".join(out).split())
        return self._text

    @property
    def runs(self) -> list[list["Node"]]:
        """Child elements, neighbours with one label together."""
        if self._runs is None:
            self._runs = []
            for child in self.children:
                if isinstance(child, str):
                    continue
                if self._runs and self._runs[-1][0].label == child.label:
                    self._runs[-1].append(child)
                else:
                    self._runs.append([child])
        return self._runs


def parse(page: str) -> Node:
    """The page's tree, forgiving as browsers are; script and style contents are left out."""
    root = node = Node("#page", frozenset(), None)
    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            node.children.append(html.unescape(page[at:]))
            break
        if start > at:
            node.children.append(html.unescape(page[at:start]))
        m = _TOKEN.match(page, start)
        if not m:
            if start + 1 == n or page.startswith("</", start):
                at = (page.find(">", start) + 1) or n  # a cut or empty tag
            else:
                node.children.append("<")
                at = start + 1
            continue
        at = m.end()
        closing, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            node = _close(node, tag)
            continue
        node = _make_room(node, tag)
        names, tokens = _names(rest) if "=" in rest or "hidden" in rest.lower() else (frozenset(), ())
        child = Node(tag, names, node, any(map(_says_drop, tokens)))
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = n if end is None else (page.find(">", end.start()) + 1) or n
        elif tag not in VOID:
            node = child
    return root


def _names(rest: str) -> tuple[frozenset[str], list[str]]:
    """Words of class, id and role, which name a part alike on all pages, and the whole names."""
    words: set[str] = set()
    tokens: list[str] = []
    for m in _ATTRIBUTE.finditer(rest):
        if m[1].lower() == "hidden":
            words.add("#hidden")
        elif m[1].lower() in ("class", "id", "role"):
            value = (m[2] or m[3] or m[4] or "").lower()
            tokens.extend(value.split())
            words.update(re.findall(r"[a-z]+", value))
    return frozenset(words), tokens


def _says_drop(token: str) -> bool:
    """Does a name say that its part is no content? A compound is what its last part says (``site-footer``), or
    its first part if the last one only says where (``sidebar-left``)."""
    parts = re.findall(r"[a-z]+", token)
    if not parts or TURNED & set(parts[:-1]):
        return False
    return parts[-1] in DROP_WORDS or len(parts) > 1 and parts[0] in DROP_WORDS and parts[-1] in PLACES


def _close(node: Node, tag: str) -> Node:
    x = node
    while x.parent is not None and x.tag != tag:
        x = x.parent
    return node if x.parent is None else x.parent


def _make_room(node: Node, tag: str) -> Node:
    kinds, until = CLOSES.get(tag, (None, None))
    if kinds is None and tag in CLOSES_P:
        kinds, until = {"p"}, {"button", "table", "td", "th", "article", "section", "div", "body", "li", "blockquote"}
    if kinds:
        x = node
        while x.parent is not None and x.tag not in until:
            if x.tag in kinds:
                return _make_room(x.parent, tag)
            x = x.parent
    return node


def is_furniture(node: Node) -> bool:
    """Does the part's own tag or naming say that it is no content?"""
    if node.tag in DROP_TAGS:
        return True
    if node.tag in ("html", "body", "main", "#page"):
        return "#hidden" in node.label[1]
    if node.tag == "header" and "#hidden" not in node.label[1]:
        # A page's header goes; an article's header with its heading stays.
        return not (_inside(node, "article") and any(isinstance(c, Node) and c.tag in ("h1", "h2") for c in node.children))
    return node.dropped


def _inside(node: Node, tag: str) -> bool:
    x = node.parent
    while x is not None:
        if x.tag == tag:
            return True
        x = x.parent
    return False


def align(a: Node, b: Node) -> list[tuple[list[Node], list[Node]]]:
    """Matched slots of two trees, by simple tree matching over runs of children."""
    matched: list[tuple[list[Node], list[Node]]] = []
    sizes: dict[tuple[int, int], int] = {}

    def size(x: list[Node], y: list[Node], depth: int) -> int:
        if x[0].label != y[0].label:
            return 0
        if len(x) > 1 or len(y) > 1 or depth > 60:
            return min(len(x), len(y))
        key = id(x[0]), id(y[0])
        if key not in sizes:
            sizes[key] = 1 + table(x[0].runs, y[0].runs, depth + 1)[-1][-1]
        return sizes[key]

    def table(xs: list[list[Node]], ys: list[list[Node]], depth: int) -> list[list[int]]:
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs):
            for j, y in enumerate(ys):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + size(x, y, depth))
        return best

    stack = [(a, b, 0)]
    while stack:
        x, y, depth = stack.pop()
        xs, ys = x.runs, y.runs
        best = table(xs, ys, depth + 1)
        i, j = len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                matched.append((xs[i], ys[j]))
                if len(xs[i]) == len(ys[j]) == 1 and depth < 60:
                    stack.append((xs[i][0], ys[j][0], depth + 1))
    return matched


def mark_template(page: Node, examples: list[tuple[Node, str]]) -> None:
    """Flag nodes that are the same in most examples (trees with their own main texts).

    Two examples at least must agree.
    """
    votes: dict[int, int] = {}
    nodes: dict[int, Node] = {}
    usable = 0
    own = main_text(page) if examples else ""
    for example, text in examples:
        if text == own:
            continue  # a copy tells nothing
        usable += 1
        for mine, theirs in align(page, example):
            known = {x.text for x in theirs}
            for x in mine:
                if x.text and x.text in known:
                    votes[id(x)] = votes.get(id(x), 0) + 1
                    nodes[id(x)] = x
    for key, n in votes.items():
        x = nodes[key]
        if n >= 2 and 2 * n > usable and x.tag not in ("html", "body", "article", "main"):
            x.template = True


def content_roots(page: Node) -> list[Node]:
    """The outermost articles, or else the main part, or else the whole page."""
    for tag in ("article", "main"):
        found, stack = [], [page]
        while stack:
            x = stack.pop()
            if is_furniture(x):
                continue  # reader comments may be articles too
            if x.tag == tag:
                found.append(x)
            else:
                stack.extend(c for c in reversed(x.children) if isinstance(c, Node))
        if found:
            return found
    return [page]


def blocks(root: Node) -> list[str]:
    """Text of the root's blocks in page order, without furniture and template."""
    out: list[str] = []
    current: list[str] = []

    def flush() -> None:
        text = " ".join("".join(current).split())
        current.clear()
        if text:
            out.append(text)

    stack: list[Node | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            current.append(x)
        elif x is not root and (x.template or is_furniture(x)):
            if x.tag in BLOCK:
                flush()
        elif x.tag == "br":
            current.append(" ")
        else:
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(x.children))
    flush()
    return out


def main_text(page: Node) -> str:
    return "\n\n".join(b for root in content_roots(page) for b in blocks(root))


def host_of(url) -> F.Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def extract_text(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", examples: int = EXAMPLES
) -> DataFrame:
    """One row per page row: ``id, url, text``; the text is empty if there is none.

    Blocks are joined by an empty line; white space inside a block is one space. A null page
    is an empty one. Pages without a usable address have no host and are read by themselves.
    Repeated rows give repeated results. Other columns are ignored.
    """
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    base = base.withColumn("host", host_of(F.col("url")))
    drawn = [
        F.min(F.struct(F.xxhash64(F.lit(i), "id", "url").alias("o"), F.col("id"), F.col("url"))).alias(f"e{i}")
        for i in range(examples)
    ]
    picked = base.where("host is not null and html is not null").groupBy("host").agg(*drawn)
    each = picked.select("host", F.explode(F.array(*[f"e{i}" for i in range(examples)])).alias("e"))
    each = each.select("host", F.col("e.id").alias("id"), F.col("e.url").alias("url")).distinct()
    each = cut_lineage(each)
    each = F.broadcast(each) if each.count() <= BROADCAST_ROWS else each
    texts = base.select("host", "id", "url", "html").alias("b").join(
        each.alias("x"), F.expr("b.host = x.host and b.id <=> x.id and b.url <=> x.url")
    )
    texts = texts.select(F.col("b.host").alias("h"), "html").distinct()
    by_host = texts.groupBy("h").agg(F.array_sort(F.collect_list("html")).alias("examples"))  # few per host
    by_host = by_host.select("h", F.slice("examples", 1, 2 * examples).alias("examples"))
    by_host = cut_lineage(by_host)
    size = by_host.agg(F.sum(F.aggregate("examples", F.lit(0), lambda n, x: n + F.octet_length(x))).alias("n")).first()["n"]
    by_host = F.broadcast(by_host) if (size or 0) <= BROADCAST_BYTES else by_host
    joined = base.join(by_host, F.col("host") == F.col("h"), "left").select("id", "url", "html", "host", "examples")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple[Node, str]]] = {}
        for batch in batches:
            texts = []
            hosts, sets = batch.column(3).to_pylist(), batch.column(4)
            for i, value in enumerate(batch.column(2)):
                page = value.as_py()
                if not page:
                    texts.append("")
                    continue
                host = hosts[i]
                if host is not None and host not in known:
                    if len(known) >= _CACHE:
                        known.clear()
                    trees = [parse(x) for x in sets[i].as_py() or []]
                    known[host] = [(t, main_text(t)) for t in trees]
                tree = parse(page)
                mark_template(tree, known.get(host, []) if host is not None else [])
                texts.append(main_text(tree))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    out = joined.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
