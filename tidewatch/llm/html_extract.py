"""Main text of web pages by wrapper induction (operator 6).

Method: DOM trees of pages of one host are aligned by simple tree matching;
text that stays the same at an aligned node becomes template, varying slots
become content.

1. *Trees.*  Each page is parsed into a tree whose sibling elements of one
   label (tag plus class names, digits folded) are one repeated node, and into
   text blocks, each at a node.
2. *Alignment.*  Distinct pages of a host meet in blocks of about ``BLOCK``
   (more blocks for a larger host, so one host with a third of all pages is
   many groups).  In each block every page is aligned with the page of the
   most nodes by simple tree matching; aligned nodes get that page's paths.
3. *Template.*  Per (host, node, text) the pages are counted over all blocks
   with map-side combine.  Text seen at a node on ``CONSTANT`` of the pages
   that have the node, on at least ``LEAST_PAGES`` of them, and on pages whose
   own content differs (so not mere copies of one page), is template.  A page
   that would lose half of its text to the template keeps it: near copies of
   one article are no wrapper.
4. *Content.*  The remaining blocks, without those inside menus, headers,
   footers, sidebars, notices, adverts, forms and reader comments (by element
   or by class, id and role names), and if the page marks its article
   (``article``, ``main``), only those inside its outermost ones, all of them,
   with all that is nested in them (outermost ones that by their names are comments
   and the like only if there are no others).

Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one space.  Nothing is capped; an
element nested deeper than ``DEPTH`` is kept as a child of its ancestor there.

Edge cases: null or empty html and pages without content give an empty text;
pages without a host share the host ''; a host of few pages has no template
and falls back to step 4 alone; equal pages are aligned once; null page_id and
repeated rows keep their rows; empty table, empty result; extra columns are
ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.store import Scratch

BLOCK = 64
CONSTANT = 0.6
LEAST_PAGES = 4
DEPTH = 150

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"
                    r"((?:[^>\"']|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?/][^>]*+>", re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                    "span strike strong sub sup time tt u var".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
_SELF_ENDING = {"li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option", "tr": "tr td th", "td": "td th", "th": "td th"}
_LISTS = frozenset("ul ol dl table select menu".split())
_NO_CONTENT = frozenset("head nav header footer aside form button dialog menu".split()) | _RAW
_NO_CONTENT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|banner|promo|nav|navbar|navigation|menu|breadcrumbs?|sidebar|"
    r"aside|header|masthead|footer|cookies?|consent|notice|popup|modal|overlay|newsletter|subscribe|share|sharing|social|"
    r"related|recommended|comments?|replies|disqus|complementary|contentinfo|search|login|pagination|widget|toolbar|"
    r"skip-link)(?:$|[\s_-])", re.IGNORECASE)


class Node:
    __slots__ = ("label", "parent", "children", "depth")

    def __init__(self, label: str, parent):
        self.label, self.parent, self.children = label, parent, {}
        self.depth = parent.depth + 1 if parent else 0

    def child(self, label: str) -> "Node":
        if label not in self.children:
            self.children[label] = Node(label, self)
        return self.children[label]

    def path(self) -> str:
        return (self.parent.path() + "/" if self.parent else "") + self.label


class Page:
    """Tree and text blocks (node, text, hidden, scope) of a page; ``scope``
    numbers the outermost article or main element around a block (0: none)."""

    def __init__(self, source: str | None):
        self.root = Node("", None)
        self.blocks: list[tuple[Node, str, bool, int]] = []
        self.scopes: dict[int, bool] = {}   # True: its names say that it is no content
        self._parse(source or "")

    def _parse(self, source: str) -> None:
        # open elements: (tag, node, hidden, scope)
        stack = [("", self.root, False, 0)]
        count: Counter = Counter()   # open elements by tag: no search through a deep stack
        text: list[str] = []

        def close_from(k: int) -> None:
            count.subtract(e[0] for e in stack[k:])
            del stack[k:]

        def innermost(*tags: str) -> int:
            return next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in tags)

        def flush() -> None:
            if text:
                words = html_lib.unescape("".join(text)).split()
                if words:
                    # an inline element has its block's node
                    self.blocks.append((stack[-1][1], " ".join(words), stack[-1][2], stack[-1][3]))
                text.clear()

        pos, end = 0, len(source)
        while pos < end:
            m = _TOKEN.search(source, pos)
            text.append(source[pos:m.start() if m else end])
            if not m:
                break
            pos = m.end()
            if not m[2]:
                if m[0].startswith("<![CDATA["):
                    text.append(html_lib.escape(m[0][9:].removesuffix("]]>")))
                continue
            tag = m[2].lower()
            if m[1]:
                if count[tag]:
                    if tag not in _INLINE:
                        flush()
                    close_from(innermost(tag))
                continue
            if tag not in _INLINE:
                flush()
            if tag in _RAW:
                close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, pos)
                pos = close.end() if close else end
                continue
            if tag in _VOID:
                continue
            if tag in _ENDS_P and count["p"]:
                close_from(innermost("p"))
            for open_tag in _SELF_ENDING.get(tag, "").split():
                if count[open_tag]:
                    k = innermost(open_tag, *_LISTS)
                    if stack[k][0] == open_tag:
                        close_from(k)
            names = " ".join(a or b or c for kind, a, b, c in _ATTRIBUTE.findall(m[3])) if "=" in m[3] else ""
            _, node, hidden, scope = stack[-1]
            if tag not in _INLINE:
                label = tag + ("." + re.sub(r"\d+", "#", names).replace("/", "|") if names else "")
                node = node.child(label) if node.depth < DEPTH else node
                outside = scope == 0
                if (tag in _NO_CONTENT and (outside or tag not in ("header", "footer"))) or (
                        names and (tag not in ("html", "body", "article", "main") or (not outside and tag == "article"))
                        and _NO_CONTENT_NAMES.search(names)):
                    hidden = True
                if outside and (tag in ("article", "main") or re.search(r"(?:^|\s)(?:main|articleBody)(?:$|\s)", names)):
                    scope = len(self.scopes) + 1
                    self.scopes[scope] = bool(names and _NO_CONTENT_NAMES.search(names))
            stack.append((tag, node, hidden, scope))
            count[tag] += 1
        flush()

    def content(self, template: frozenset = frozenset()) -> str:
        """Text without template blocks ((node path, text) digests).  A page
        that would lose half of its text repeats other pages and keeps it."""
        if template:
            short, whole = self._content(template), self._content(frozenset())
            return short if 2 * len(short) > len(whole) else whole
        return self._content(template)

    def _content(self, template: frozenset) -> str:
        left = [(text, scope) for node, text, hidden, scope in self.blocks
                if not hidden and (not template or block_key(node.path(), text) not in template)]
        # every outermost scope with text, but for comments and the like beside the article
        scopes = {scope for _, scope in left if scope}
        scopes = {scope for scope in scopes if not self.scopes[scope]} or scopes
        if scopes:
            left = [x for x in left if x[1] in scopes]
        return " ".join(text for text, _ in left)


def block_key(path: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{path}\0{text}".encode()) - (1 << 63)


def simple_tree_matching(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Size of the largest order-preserving top-down matching and its pairs."""
    if a.label != b.label:
        return 0, []
    # siblings carry distinct labels, so a child can match one counterpart only and the
    # best matching is the heaviest run of matches in rising order on both sides:
    # ends[j] holds the heaviest one over a stretch of counterparts (binary indexed)
    others = list(b.children.values())
    place = {n.label: j for j, n in enumerate(others, 1)}
    ends: list[tuple[int, tuple]] = [(0, ())] * (len(others) + 1)

    def heaviest(j: int) -> tuple[int, tuple]:
        best = ends[0]
        while j:
            if ends[j][0] > best[0]:
                best = ends[j]
            j &= j - 1
        return best

    for n in a.children.values():
        if n.label in place:
            j = place[n.label]
            size, inner = simple_tree_matching(n, others[j - 1])
            before, chain = heaviest(j - 1)
            longer = (before + size, (chain, inner))
            while j <= len(others):
                if longer[0] > ends[j][0]:
                    ends[j] = longer
                j += j & -j
    score, chain = heaviest(len(others))
    pairs = [(a, b)]
    while chain:
        chain, inner = chain
        pairs += inner
    return score + 1, pairs


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees and block digests of pages: (k, host, paths, nodes, keys, own)."""
    for batch in batches:
        out = ([], [], [], [])
        for source in batch.column(2).to_pylist():
            page = Page(source)
            order = {}
            for node, *_ in page.blocks:
                while node is not None and id(node) not in order:
                    order[id(node)] = node
                    node = node.parent
            paths = sorted({n.path() for n in order.values()})
            number = {p: i for i, p in enumerate(paths)}
            out[0].append(paths)
            out[1].append([number[n.path()] for n, *_ in page.blocks])
            out[2].append([block_key(n.path(), t) for n, t, *_ in page.blocks])
            out[3].append(block_key("", page.content()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out[0], pa.list_(pa.string())), pa.array(out[1], pa.list_(pa.int32())),
             pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.int64())],
            ["k", "host", "paths", "nodes", "keys", "own"])


def _tree(paths) -> Node:
    """The tree of a list of label paths (labels hold no '/')."""
    root = Node("", None)
    for p in paths:
        node = root
        for label in p.split("/")[1:]:
            node = node.child(label)
    return root


def _aligned(pages: pd.DataFrame) -> pd.DataFrame:
    """Blocks at nodes that align with the block's reference page; a support
    row (key null) for each aligned node of a page."""
    reference = _tree(max(zip(pages["paths"].map(len), pages["k"], pages["paths"]), key=lambda x: (x[0], x[1]))[2])
    k, node, key, own = [], [], [], []
    for page_k, paths, nodes, keys, digest in zip(pages["k"], pages["paths"], pages["nodes"], pages["keys"], pages["own"]):
        _, pairs = simple_tree_matching(reference, _tree(paths))
        known = {b.path(): xxhash.xxh3_64_intdigest(a.path().encode()) - (1 << 63) for a, b in pairs}
        place = [known.get(p) for p in paths]
        rows = {(place[n], b) for n, b in zip(nodes, keys) if place[n] is not None}
        rows |= {(place[n], None) for n in nodes if place[n] is not None}
        for n, b in rows:
            k.append(page_k)
            node.append(n)
            key.append(b)
            own.append(digest)
    return pd.DataFrame({"host": pages["host"].iat[0], "k": pd.array(k, "Int64"), "node": pd.array(node, "Int64"),
                         "key": pd.array(key, "Int64"), "own": pd.array(own, "Int64")})


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def template_blocks(pages: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """(k, template): per distinct page the keys of its template blocks."""
    distinct = pages.groupBy("k").agg(F.first("host").alias("host"), F.first("html").alias("html"))
    trees = scratch.keep(distinct.select("k", "host", "html").mapInArrow(
        _tree_rows, "k bigint, host string, paths array<string>, nodes array<int>, keys array<bigint>, own bigint"), "trees")
    sizes = trees.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    sizes = scratch.keep(sizes, "hosts")
    rows = scratch.keep(
        trees.join(sizes, "host").withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")))
        .groupBy("host", "block").applyInPandas(_aligned, "host string, k bigint, node bigint, key bigint, own bigint"), "rows")
    counts = rows.groupBy("host", "node", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("own").alias("lo"), F.max("own").alias("hi"))
    counts = scratch.keep(counts, "counts")
    support = counts.where("key IS NULL").select("host", "node", F.col("n").alias("pages"))
    constant = (counts.where((F.col("key").isNotNull()) & (F.col("n") >= LEAST_PAGES) & (F.col("lo") < F.col("hi")))
                .join(support, ["host", "node"]).where(F.col("n") >= F.col("pages") * CONSTANT)
                .select("host", "node", "key"))
    constant = scratch.keep(constant, "constant")
    return (rows.where("key IS NOT NULL").join(constant, ["host", "node", "key"])
            .groupBy("k").agg(F.collect_set("key").alias("template")))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [Page(source).content(frozenset(template or ()))
                 for source, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    scratch = Scratch(pages.sparkSession, "html")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("k", F.xxhash64("host", "html"))
    template = scratch.keep(template_blocks(rows.select("k", "host", "html"), scratch, block), "template")
    scratch.drop("trees", "rows", "counts")
    kind = rows.schema["page_id"].dataType.simpleString()
    return (rows.join(template, "k", "left").select("page_id", "url", "html", "template")
            .mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars bigint"))
