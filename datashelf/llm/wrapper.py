"""Main text of web pages by wrapper induction: same-host pages aligned by simple tree matching."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datashelf.llm.common import BROADCAST_ROWS, keyed, stored

# A quote opens a value only after an equals sign; what the text's end leaves open takes the rest of it. Nothing goes back.
MARKUP = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]++)?+)*+)(?:>|\Z)|[!?][^>]*+(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=>/\"']+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?+")
# Text inside these is no markup and no text.
RAW = {"script", "style", "template", "textarea", "noscript", "svg", "iframe", "title", "math", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Elements that do not begin a block of text.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
BREAKS = {"br", "hr", "wbr"}
# An element that ends when one of these begins.
CLOSED_BY = {
    "p": {"p", "div", "ul", "ol", "dl", "table", "article", "section", "aside", "nav", "footer", "header", "main", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "address", "fieldset", "details"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
    "option": {"option"}, "head": {"body"},
}
ASIDE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "object", "canvas"}
ASIDE_WORDS = {
    "nav", "navbar", "navigation", "menu", "header", "masthead", "banner", "footer", "sidebar", "aside", "ad", "ads",
    "advert", "adverts", "advertisement", "advertising", "promo", "promotion", "sponsor", "sponsored", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "share", "sharing", "social", "breadcrumb", "breadcrumbs", "pagination", "pager", "related",
    "recommended", "comment", "comments", "respond", "reply", "replies", "disqus", "login", "search", "widget", "toolbar",
    "skip", "copyright", "disclaimer", "tags", "toc", "complementary", "contentinfo",
}
MAIN_ROLES = {"article", "main"}
# Elements whose names say what they are about, not what they are.
UNNAMED = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
# How far an element is aside: not at all; the main element within one that is by its name; by a name; for good.
CLEAR, DOUBTFUL, NAMED, OUT = range(4)
SPACE = re.compile(r"\s+")
CONSTANT_PAGES, CONSTANT_SHARE = 5, 0.6
LINK_SHARE = 0.5


class Node:
    __slots__ = ("aside", "blocks", "children", "inside", "label", "tag")

    def __init__(self, tag: str, label: str, aside: int, inside: str):
        self.tag, self.label, self.aside, self.inside = tag, label, aside, inside
        self.children, self.blocks = [], []


def says_aside(token: str) -> bool:
    """Whether a class, id or role has no other words than those of asides: cookie-notice, but not has-sidebar."""
    parts = [w for w in re.split(r"[^a-z]+", token) if w]
    return bool(parts) and ASIDE_WORDS.issuperset(parts)


def parse(source: str) -> tuple[Node, list[tuple[Node, str, float]]]:
    """The tree of block elements, and the text blocks in page order: (element, text, share of it within links)."""
    root = Node("html", "html", CLEAR, "")
    stack, blocks, parts, links = [root], [], [], 0
    opened = Counter()  # how many elements of each tag are on the stack
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", "".join(parts)).strip()
            if text:
                blocks.append((stack[-1], text, linked / max(1, sum(map(len, parts)))))
            parts.clear()
        linked = 0

    def add(raw: str):
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += len(text)

    at = 0
    while True:
        found = MARKUP.search(source, at)
        if not found:
            add(source[at:])
            break
        add(source[at : found.start()])
        at = found.end()
        closing, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
            continue
        if tag in BREAKS:
            parts.append(" ")
        elif tag in VOID:
            continue
        elif tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
        elif closing:
            flush()
            links = 0
            while opened[tag]:
                last = stack.pop().tag
                opened[last] -= 1
                if last == tag:
                    break
        else:
            flush()
            links = 0
            while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1].tag, ()):
                opened[stack.pop().tag] -= 1
            if tag in ("html", "body"):
                continue
            above = stack[-1]
            attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(found[3])}
            names = " ".join(attributes.get(k, "") for k in ("class", "id", "role")).lower()
            words = set(re.split(r"[^a-z]+", names))
            main = tag in MAIN_ROLES or "main" == attributes.get("role") or "articleBody" == attributes.get("itemprop")
            tokens = [] if tag in UNNAMED else names.split()
            hard = (tag in ASIDE_TAGS and tag != "form") or (tag == "header" and not above.inside)
            hard = hard or "comment" in tokens or "comments" in tokens
            hard = hard or "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "")
            aside = above.aside
            if hard:
                aside = OUT
            elif main:
                aside = DOUBTFUL if aside == NAMED and not above.inside else aside
            elif tag == "form" or any(map(says_aside, tokens)):
                aside = max(aside, NAMED)
            inside = "article" if tag == "article" or above.inside == "article" else "main" if main else above.inside
            label = tag + "".join(f".{w}" for w in sorted(words) if w)
            node = Node(tag, label, aside, inside)
            above.children.append(node)
            if not found[3].endswith("/"):
                stack.append(node)
                opened[tag] += 1
    flush()
    return root, blocks


def shape(root: Node) -> tuple[str, dict[Node, int]]:
    """The tree with runs of like siblings folded into one, as text, and each node's number in it (preorder).

    Children of folded siblings are folded together, so lists of any length have the same shape.
    """
    number: dict[Node, int] = {}
    out: list[str] = []
    count = 0
    waiting: list[list[Node] | None] = [[root]]  # None: the end of an element
    while waiting:
        nodes = waiting.pop()
        if nodes is None:
            out.append(")")
            continue
        for node in nodes:
            number[node] = count
        count += 1
        out.append(re.sub(r"[()]", "", nodes[0].label) + "(")
        waiting.append(None)
        waiting.extend(reversed(folded(nodes)))
    return "".join(out), number


def folded(nodes: list[Node]) -> list[list[Node]]:
    """The children of like siblings, in groups of like ones."""
    groups: list[list[Node]] = []
    last: dict[str, list[Node]] = {}
    for node in nodes:
        previous = None
        for child in node.children:
            if previous is not None and previous[0].label == child.label:
                previous.append(child)
            elif child.label in last and len(nodes) > 1:
                previous = last[child.label]
                previous.append(child)
            else:
                previous = [child]
                last[child.label] = previous
                groups.append(previous)
    return groups


def tree_of(text: str) -> tuple[str, int, list]:
    """(label, number, children) from a shape."""
    stack: list[tuple[str, int, list]] = [("", -1, [])]
    number = 0
    for label, mark in re.findall(r"([^()]*)([()])", text):
        if mark == "(":
            node = (label, number, [])
            number += 1
            stack[-1][2].append(node)
            stack.append(node)
        else:
            stack.pop()
    return stack[0][2][0]


def simple_tree_matching(a: tuple, b: tuple) -> dict[int, int]:
    """The largest mapping of two ordered trees in which mapped nodes have mapped parents and equal labels."""

    # Pairs with equal labels under pairs with equal labels, parents first; scored the other way round.
    pairs = [(a, b)] if a[0] == b[0] else []
    for x, y in pairs:
        like: dict[str, list] = {}
        for q in y[2]:
            like.setdefault(q[0], []).append(q)
        pairs.extend((p, q) for p in x[2] for q in like.get(p[0], ()))
    score: dict[tuple[int, int], int] = {}

    def table(x, y) -> list[list[int]]:
        m = [[0] * (len(y[2]) + 1) for _ in range(len(x[2]) + 1)]
        for i, p in enumerate(x[2], 1):
            for j, q in enumerate(y[2], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + score.get((p[1], q[1]), 0))
        return m

    for x, y in reversed(pairs):
        score[x[1], y[1]] = 1 + table(x, y)[-1][-1]
    mapped: dict[int, int] = {}
    waiting = pairs[:1]
    while waiting:
        x, y = waiting.pop()
        mapped[x[1]] = y[1]
        m, i, j = table(x, y), len(x[2]), len(y[2])
        while i and j:
            if m[i][j] == m[i - 1][j]:
                i -= 1
            elif m[i][j] == m[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                waiting.append((x[2][i], y[2][j]))
    return mapped


def content(blocks: list[tuple[Node, str, float]]) -> list[tuple[Node, str, float]]:
    """Blocks that may be content: those within <article>, else within <main>, else within such an element below one that
    is aside by its name only, else all that are not mostly links."""
    clear = [b for b in blocks if b[0].aside == CLEAR]
    for some in (clear, [b for b in blocks if b[0].aside == DOUBTFUL]):
        for role in ("article", "main"):
            inner = [b for b in some if b[0].inside == role]
            if inner:
                return inner
    return [b for b in clear if b[2] < LINK_SHARE]


def hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def page_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shape of each page, of its blocks the place and a hash of the text, and a digest of these texts."""
    kind = pa.list_(pa.struct([("said", pa.int64()), ("node", pa.int32())]))
    for batch in batches:
        shapes, digests, kept = [], [], []
        for source in batch.column("html").to_pylist():
            root, blocks = parse(source or "")
            text, number = shape(root)
            shapes.append(text)
            inner = content(blocks)
            digests.append(hashed("\n".join([b[1] for b in inner])))
            kept.append([{"said": hashed(b[1]), "node": number[b[0]]} for b in inner])
        yield pa.record_batch(
            [batch.column("row"), batch.column("url"), pa.array(shapes, pa.string()), pa.array(digests, pa.int64()), pa.array(kept, kind)],
            names=["row", "url", "shape", "digest", "blocks"],
        )


def page_writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each page's blocks, less those that are template."""
    for batch in batches:
        texts = []
        for source, gone in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist()):
            gone = set(gone or ())
            texts.append(" ".join(b[1] for i, b in enumerate(content(parse(source or "")[1])) if i not in gone))
        yield pa.record_batch(
            [batch.column("row"), batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array(map(len, texts), pa.int64())],
            names=["row", "page_id", "url", "text", "n_chars"],
        )


def aligner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    @lru_cache(10_000)
    def places(own: str, reference: str) -> list[int]:
        tree = tree_of(own)
        mapped = simple_tree_matching(tree, tree_of(reference))
        return [mapped.get(i, -1 - i) for i in range(own.count("("))]

    for batch in batches:
        pairs = zip(batch.column("shape").to_pylist(), batch.column("reference").to_pylist())
        yield pa.record_batch(
            [batch.column("host"), batch.column("shape"), pa.array([places(*p) for p in pairs], pa.list_(pa.int32()))],
            names=["host", "shape", "places"],
        )


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: (row, page_id, url, text, n_chars).

    Each page is parsed to a tree of block elements, in which runs of like siblings are folded. A host's most frequent
    shape is its reference; every page's tree is aligned with it by simple tree matching. A text that stands at one
    place of the reference in at least 5 pages and 60 % of the host's is template and goes; varying texts stay.
    Pages whose content is the same count once, whatever stands around it. Places that name themselves as something else than the article (navigation, footers,
    forms, adverts, notices, comments ...; see ``ASIDE_TAGS`` and ``ASIDE_WORDS``) are no slots; a class or id counts if
    all of its words are such, not on headings and paragraphs, and not against a main element within. Of the rest, slots
    within <article> are content, without one those within <main>, without either all that are not mostly links.

    A null or empty html gives an empty text, a page without markup its whole text. Pages without a host are not
    compared with others. A tag or comment that the page's end leaves open takes the rest of it. Null ids and repeated rows are pages of their own. An empty table gives no rows.

    Hosts meet in counts and in joins that adaptive execution can split, so one host may hold most pages. Only hashes of
    texts are kept between the two passes over the pages, which are parsed again for the result.
    """
    source = keyed(pages, page_id=id_col, url=F.col(f"`{url_col}`").cast("string"), html=html_col)
    kind = source.schema["page_id"].dataType.simpleString()
    read = source.select("row", "url", "html").mapInArrow(
        page_reader, "row long, url string, shape string, digest long, blocks array<struct<said:long,node:int>>"
    )
    host = F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]+)", 1))
    hosted = stored(read.withColumn("host", host).drop("url").filter("host <> ''"), "pages")
    distinct = hosted.groupBy("host", "digest").agg(F.min("shape").alias("shape"))
    shapes = stored(distinct.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("m")), "shapes")
    hosts = shapes.groupBy("host").agg(
        F.max_by("shape", F.struct("m", "shape")).alias("reference"), F.sum("m").alias("pages")
    )
    wanted = hosts.filter(F.col("pages") >= CONSTANT_PAGES)
    aligned = stored(
        shapes.join(wanted, "host").select("host", "shape", "reference")
        .mapInArrow(aligner, "host string, shape string, places array<int>"),
        "aligned",
    )
    texts = hosted.select("row", "host", "shape", "digest", F.posexplode("blocks").alias("at", "block"))
    slots = texts.join(aligned, ["host", "shape"]).select(
        "row", "host", "digest", "at", F.get("places", F.col("block.node")).alias("place"), "block.said"
    )
    slots = stored(slots, "slots")
    pages_of = slots.select("host", "place", "said", "digest").distinct().groupBy("host", "place", "said").count()
    constant = (
        pages_of.filter(F.col("count") >= CONSTANT_PAGES)
        .join(wanted, "host")
        .filter(F.col("count") >= CONSTANT_SHARE * F.col("pages"))
        .select("host", "place", "said")
    )
    dropped = stored(slots.join(constant, ["host", "place", "said"]).select("row", "at"), "template")
    template = dropped.groupBy("row").agg(F.collect_set("at").alias("gone"))
    if dropped.count() <= BROADCAST_ROWS:
        template = F.broadcast(template)
    return source.join(template, "row", "left").mapInArrow(
        page_writer, f"row long, page_id {kind}, url string, text string, n_chars long"
    )
