"""Main text of web pages by site style trees.

Pages of one host are merged into a tree of element nodes. A node is named by
the tags, classes and ids from the root to it; equal siblings merge. Inside article
and main, where ids are mostly anchors made for one page, only hints of them count. Two entropies
tell how much a node matters, both to the base of the number m of pages that
have it, so that 1 means it differs on every page and 0 that it never changes:

* presentation, of the children that an inner node shows on the pages;
* content, of a text: if it stands on n of m pages, its feature has entropy
  log n / log m, and the importance of a text node is 1 minus the mean of these.

The importance of an inner node combines its own presentation with that of its
children, weighed by how often they occur and by ``DECAY`` for their number.
Branches with an importance below ``LEAST`` are removed from each page. Hosts
with few pages borrow from the tree of all hosts, in proportion to ``BORROWED``
pages. What HTML itself calls navigation, script and so on has importance 0,
unless it holds an article or main. A form, or what class, id or role call
boilerplate, is a hint: such a branch goes unless it was seen on ``ENOUGH`` pages of
the host with an importance of ``OVERRULES``. A hint decides alone only beside the
article or main of a page, never above it. Within article or main a branch goes
below ``LEAST_INSIDE`` on ``ENOUGH`` articles of the host; an article counts once
there, however many copies of it the site has.

Statistics are counted over all pages, first by (host, node, text) and then by
(host, node). The nodes of a host that are on two pages or more, here or at another
host, are gathered in one task, which combines them; the tree of a host is one row.
Nodes on a single page, which names made for one post give without end, have
importance 1 and only add to the weight of their parent.

Defined results: NULL or empty html, or a page without text, gives an empty
text; a NULL or odd url belongs to the host ``""``; unclosed, misnested and cut
tags are taken as browsers do in simple cases; repeated rows give repeated
results; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scan, stored

LEAST = 0.3
LEAST_INSIDE = 0.1
DECAY = 0.9
BORROWED = 5
ENOUGH = 10
OVERRULES = 0.6
BROADCAST_NODES = 200_000

# Elements of HTML by their meaning.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes template".split())
NEVER = RAW | frozenset(
    "head nav header footer aside button select option input label menu svg canvas object audio video map".split()
)
CONTENT = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINT_TAGS = frozenset("form fieldset dialog".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
ENDS_P = BLOCK - {"br", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
SAME_ENDS = {"li": {"ul", "ol"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
HINTS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus "
    "disclaimer dropdown footer footnav header masthead menu menubar modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
HINT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_SPACES = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Node:
    """An element; ``path`` names it in the style tree."""

    tag: str
    path: int
    never: bool
    hinted: bool
    content: bool
    parent: Node | None
    hidden: bool = False
    holds: bool = False  # an article or main
    children: list = field(default_factory=list)  # elements, and texts as str


def _hash(*parts: object) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _open(tag: str, attributes: dict[str, str], parent: Node) -> Node:
    inside, name = parent.content or tag in CONTENT, attributes.get("id", "").lower()
    if inside:
        name = "" if tag in HEADINGS else " ".join(sorted(HINTS.intersection(_WORDS.findall(name))))
    names = _DIGITS.sub("", f"{attributes.get('class', '')} {name}".strip().lower())
    hinted = bool(HINTS.intersection(_WORDS.findall(names))) or attributes.get("role", "").lower() in HINT_ROLES
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")
    # a header of the article itself holds its title
    never = hidden or tag in NEVER and not (tag == "header" and parent.content)
    hinted = (hinted or tag in HINT_TAGS) and tag not in ("html", "body", *CONTENT)
    node = Node(tag, _hash(parent.path, tag, names), never, hinted, inside, parent, hidden=hidden)
    parent.children.append(node)
    if tag in CONTENT:
        above = parent
        while above is not None and not above.holds:
            # what is around an article is no boilerplate by its name
            above.holds, above.hinted, above.never = True, False, above.never and above.hidden
            above = above.parent
    return node


def _decided(node: Node, root: Node) -> bool:
    """Whether the branch goes by its names, whatever the figures of the host."""
    return node.never or node.hinted and root.holds and not node.content


def parse(page: str) -> Node:
    """The tree of a page; end tags close the nearest open element of their name."""
    root = at = Node("", 0, False, False, False, None)
    end, raw = 0, None
    for m in _TOKEN.finditer(page):
        if raw is not None:  # inside script, style and the like until their own end tag
            if (m[1] or "").lower() != raw:
                continue
            raw = None
        elif m.start() > end:
            at.children.append(page[end : m.start()])
        end = m.end()
        if m[1]:
            tag, node = m[1].lower(), at
            while node.parent is not None and node.tag != tag:
                node = node.parent
            if node.parent is not None:
                at = node.parent
        elif m[2]:
            tag = m[2].lower()
            if tag in ENDS_P:
                at = _close(at, "p", {"article", "main", "section", "div", "td", "th", "li", "blockquote", "body"})
            if tag in SAME_ENDS:
                at = _close(at, tag, SAME_ENDS[tag])
            if tag in VOID:
                _open(tag, {}, at)
                continue
            at = _open(tag, _attributes(m[3]), at)
            if tag in RAW and not m[3].rstrip().endswith("/"):
                raw = tag
    if raw is None and end < len(page):
        at.children.append(page[end:])
    return root


def _close(at: Node, tag: str, within: set[str]) -> Node:
    """Close an open ``tag`` that stands inside the nearest of ``within``."""
    node = at
    while node.parent is not None and node.tag not in within:
        if node.tag == tag:
            return node.parent
        node = node.parent
    return at


def _own_text(node: Node) -> str:
    return _SPACES.sub(" ", " ".join(x for x in node.children if isinstance(x, str))).strip()


def walk(root: Node):
    """The elements but for branches that go by their names."""
    stack = [root]
    while stack:
        node = stack.pop()
        if _decided(node, root):
            continue
        yield node
        stack.extend(x for x in reversed(node.children) if not isinstance(x, str))


def observe(page: str) -> set[tuple[int, int, int, int, int | None]]:
    """``(node, parent, kind, feature, article)`` of a page: kind 0 the children shown, kind 1 a text.

    ``article`` is the same for copies of all that stands inside article or main, and None outside.
    """
    outside, inside = set(), set()
    for node in walk(parse(page)):
        seen = inside if node.content else outside
        parent = node.parent.path if node.parent else 0
        shown = dict.fromkeys(x.path for x in node.children if not isinstance(x, str))
        seen.add((node.path, parent, 0, _hash(*shown)))
        if text := _own_text(node):
            seen.add((node.path, parent, 1, _hash(text)))
    article = _hash(*sorted(inside))
    return {(*x, None) for x in outside} | {(*x, article) for x in inside}


def _stays(node: Node, root: Node, importance: dict[int, tuple[float, int]]) -> bool:
    if _decided(node, root):
        return False
    known, pages = importance.get(node.path, (1.0, 0))
    if node.hinted:
        return pages >= ENOUGH and known >= OVERRULES
    return known >= LEAST_INSIDE or pages < ENOUGH if node.content else known >= LEAST


def main_text(page: str | None, importance: dict[int, tuple[float, int]]) -> str:
    """Text of the branches that are left, blocks joined by a space; ``importance`` has pages as well."""
    if not page:
        return ""
    pieces: list[str] = []
    root = parse(page)
    stack: list = [root]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            pieces.append(item)
            continue
        if item.tag in BLOCK:  # it parts what stands around it, even where it goes
            pieces.append(" ")
        if _stays(item, root, importance):
            if item.tag in BLOCK:
                stack.append(" ")
            stack.extend(reversed(item.children))
    # references are decoded last, so that none of them can end a tag
    return _SPACES.sub(" ", html.unescape("".join(pieces))).strip()


def tree_importance(nodes: pd.DataFrame) -> dict[int, float]:
    """Importance of each node of one tree from its own figures, children first; ``single`` counts children left out."""
    rows = {r.node: r for r in nodes.itertuples()}
    children: dict[int, list[int]] = {}
    for r in rows.values():
        if r.node != r.parent:
            children.setdefault(r.parent, []).append(r.node)
    order, stack = [], [n for n, r in rows.items() if r.parent not in rows or r.node == r.parent]
    while stack:
        order.append(n := stack.pop())
        stack.extend(children.get(n, ()))
    out: dict[int, float] = {}
    for n in reversed(order):
        r, below = rows[n], [c for c in children.get(n, ()) if c in out]
        parts = [(rows[c].pages, out[c]) for c in below]
        if r.content == r.content:  # it has text of its own
            parts.append((r.pages, r.content))
        weight = r.single + sum(w for w, _ in parts)  # those on a single page have importance 1
        inner = (r.single + sum(w * x for w, x in parts)) / weight if weight else 0.0
        own = DECAY ** (len(parts) + r.single)
        shown = r.presentation if below or r.single else inner
        # a branch matters as much as its better half: steady layout may hold changing text
        out[n] = max((1 - own) * shown + own * inner, inner)
    return out


def node_figures(pages: DataFrame, url: str, page: str) -> DataFrame:
    """``host, node, parent, pages, pages_all, presentation, content`` of every node."""
    rows = pages.select(host_of(url).alias("host"), F.col(page).alias("html"))

    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    seen.update((host, *x) for x in observe(text))
            if seen:
                names = ("host", "node", "parent", "kind", "feature", "article")
                yield {**dict(zip(names, map(list, zip(*seen)))), "n": list(seen.values())}

    ddl = "host string, node long, parent long, kind long, feature long, article long, n long"
    names = ["host", "node", "parent", "kind", "feature"]
    features = scan(rows, ddl, run).groupBy(*names, "article").agg(F.sum("n").alias("n"))
    once = F.when(F.col("article").isNull(), F.col("n")).otherwise(1)
    features = features.groupBy(*names).agg(F.sum(once).alias("n"))
    features = stored(features, "style-features")
    everywhere = features.groupBy("node", "parent", "kind", "feature").agg(F.sum("n").alias("n"))
    # of each node: pages, and per kind the sum of n * log n over features and of n
    def figures(counted: DataFrame, *keys: str) -> DataFrame:
        n, shown = F.col("n").cast("double"), F.col("kind") == 0
        own = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
        return counted.groupBy(*keys, "node", "parent").agg(
            F.sum(F.when(shown, n)).alias("pages"),
            own(0, n * F.log(n)).alias("shown_log"),
            own(1, n).alias("texts"),
            own(1, n * F.log(n)).alias("text_log"),
        )

    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("log_part")))

    def entropies(counted: DataFrame, end: str) -> DataFrame:
        base = F.log(F.greatest(F.col("pages"), F.lit(2.0)))
        one = F.col("pages") <= 1
        # -sum p log p with p = n / pages, to the base pages
        shown = F.when(one, 1.0).otherwise(1 - F.col("shown_log") / F.col("pages") / base)
        texts = F.when(one, 1.0).otherwise(1 - F.col("text_log") / F.col("texts") / base)
        frame = counted.withColumn("log_part", shown).withColumn(f"presentation{end}", share)
        frame = frame.withColumn("log_part", texts).withColumn(f"content{end}", F.when(F.col("texts") > 0, share))
        return frame.drop("log_part", "shown_log", "text_log", "texts").withColumnRenamed("pages", f"pages{end}")

    own = entropies(figures(features, "host"), "")
    general = entropies(figures(everywhere), "_all").drop("parent")
    joined = own.join(general, "node", "left")
    few = F.lit(float(BORROWED)) / (F.col("pages") + BORROWED)
    for name in ("presentation", "content"):
        joined = joined.withColumn(name, F.col(name) * (1 - few) + F.col(f"{name}_all") * few)
    return joined.select("host", "node", "parent", "pages", "pages_all", "presentation", "content")


def without_single(nodes: DataFrame) -> DataFrame:
    """The nodes on two pages or more over all hosts, with the number of their other children in ``single``."""
    alone = F.col("pages_all") <= 1
    nodes = stored(nodes, "style-nodes")
    single = nodes.where(alone).groupBy("host", F.col("parent").alias("node")).agg(F.count("*").alias("single"))
    left = nodes.where(~alone).drop("pages_all").join(single, ["host", "node"], "left")
    return left.withColumn("single", F.coalesce("single", F.lit(0)))


def build_trees(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """One row for each host: ``host, nodes, importance, pages`` (arrays side by side)."""
    nodes = without_single(node_figures(pages, url, page))

    def one_host(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = tree_importance(frame)
        seen = dict(zip(frame["node"], frame["pages"].astype(np.int64)))
        told = [n for n, x in out.items() if x < LEAST or seen[n] >= ENOUGH]  # the others need no entry
        columns = {"nodes": np.array(told, np.int64), "importance": np.array([out[n] for n in told], float), "pages": np.array([seen[n] for n in told], np.int64)}
        return pd.DataFrame({"host": [key[0]], **{name: [x] for name, x in columns.items()}})

    return nodes.groupBy("host").applyInPandas(one_host, "host string, nodes array<long>, importance array<double>, pages array<long>")


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` of every page."""
    trees = stored(build_trees(pages, url, page).where(F.size("nodes") > 0), "style-trees")
    size = trees.agg(F.sum(F.size("nodes") + 10)).first()[0] or 0
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"), host_of(url).alias("host"))
    # 24 bytes a node; beyond the bound the pages are shuffled by host, and AQE splits hot hosts
    joined = rows.join(F.broadcast(trees) if size <= BROADCAST_NODES else trees, "host", "left")

    def run(batches):
        for batch in batches:
            c = {name: batch.column(name).to_pylist() for name in ("html", "nodes", "importance", "pages")}
            texts = [main_text(h, dict(zip(n or (), zip(i or (), m or ())))) for h, n, i, m in zip(*c.values())]
            yield {"key": batch.column("key"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return scan(joined, f"key {kind}, url string, text string, n_chars long", run).withColumnRenamed("key", key)
