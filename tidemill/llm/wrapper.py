"""Main text of web pages by wrapper induction.

Pages of one host share a template. One complete page per host is its reference; the trees of all other pages
are aligned with it by simple tree matching, the largest order-preserving match of nodes with equal tags
and classes. Pages with most of their text in elements that the reference lacks have another layout; they are aligned
again with a reference of their own. A node whose text is the same on most of the host's or the layout's different
articles is template; what varies is content.
Regions that are no article by their element or their class (menus, headers, footers, sidebars, notices,
adverts, forms, comments) are left out on every page, also where a host has too few pages to tell.

Trees are parsed and aligned next to the page, once per layout tried. What is shuffled are references, numbers of nodes,
and the pages of further layouts.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import HOT_CLASSES, join_classes

BROADCAST_BYTES = 1 << 25    # references of hot hosts up to this are broadcast; those of further ones are copied to shares of the host
LEAST_ARTICLES = 5           # different articles a host needs before a constant node counts as template
CONSTANT = 0.5               # the share of different articles, of the host or of the layout, that must have its text
EVERY = -2                   # stands for a node that every article has

# fixed values: elements by what they mean for the text
RAW = "script style noscript template iframe textarea svg title select".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table
tbody td tfoot th thead tr ul caption br""".split())
ENDS_P = BLOCKS - {"br", "html", "body", "head"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
NO_ARTICLE = set("nav footer aside form dialog menu button head".split())
NO_ARTICLE_WORDS = set("""ad ads nav menu aside footer header masthead topbar comment comments reply replies respond notice
popup modal overlay signup login share sharing social related legal skip search toolbar alert pager tags widget""".split())
NO_ARTICLE_STARTS = tuple("""advert adsense banner sponsor promo navbar navigation breadcrumb sidebar commentlist disqus
cookie consent newsletter subscri recommend pagination copyright disclaimer sitemap""".split())

TEASERS = {"teaser", "teasers"}     # also as the class of an article element

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?:\s[^>]*)?/>|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z|[^<]+|<""",
    re.S | re.I)
_ATTR = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


class Node:
    """A block element: its symbol for matching, its blocks of text between its child elements, and its children."""

    __slots__ = ("tag", "symbol", "out", "main", "children", "text", "number", "inside")

    def __init__(self, tag: str, attrs: str, out: bool):
        self.tag, self.children, self.text, self.number = tag, [], [], -1
        self.inside = False         # whether it is, or is below, an element marked as the article's
        found = {name.lower(): a or b or c for name, a, b, c in _ATTR.findall(attrs)} if "=" in attrs else {}
        self.symbol = (tag, found.get("class", ""))
        words = re.split(r"[^a-z]+", " ".join(found.get(k, "") for k in ("class", "id", "role")).lower())
        self.main = tag in ("article", "main") or "main" in words or found.get("itemprop") == "articleBody"
        body = tag in ("html", "body", "article", "main")
        self.out = out or tag in NO_ARTICLE or not TEASERS.isdisjoint(words) or (not body and any(
            w in NO_ARTICLE_WORDS or w.startswith(NO_ARTICLE_STARTS) for w in words if w))


def parse(page: str) -> Node:
    """The tree of block elements; text runs are children of their own, as nodes without a tag."""
    root = Node("", "", False)
    stack: list[tuple[str, Node]] = [("", root)]       # open elements, inline ones with their block
    opened: Counter[str] = Counter()                   # how many of each tag are open
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            run = Node("", "", stack[-1][1].out)
            run.text = text
            stack[-1][1].children.append(run)

    def close(down_to: int) -> None:
        if any(tag in BLOCKS for tag, _ in stack[down_to:]):
            flush()
        opened.subtract(tag for tag, _ in stack[down_to:])
        del stack[down_to:]

    for token in _TOKEN.finditer(page):
        tag = token["tag"]
        if tag is None:
            if not token["raw"] and (token[0][0] != "<" or token[0] == "<"):
                pieces.append(token[0])
            continue
        tag = tag.lower()
        if token["end"]:
            at = opened[tag] and next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)
            if at:
                close(at)
            continue
        if tag in ENDS_P:
            at = opened["p"] and next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "p")
            if at and not any(t in ENDS_P for t, _ in stack[at + 1:]):
                close(at)
        if tag in SIBLINGS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in SCOPES.get(tag, ()):
                    break
                if stack[i][0] in SIBLINGS[tag]:
                    close(i)
                    break
        if tag in VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        if token["attrs"].endswith("/") and tag not in BLOCKS:
            continue
        block = stack[-1][1]
        if tag in BLOCKS:
            flush()
            outer = block
            block = Node(tag, token["attrs"], outer.out or (tag == "header" and not outer.inside))
            block.inside = block.main or outer.inside
            outer.children.append(block)
        stack.append((tag, block))
        opened[tag] += 1
    close(1)
    flush()
    return root


def _number(root: Node) -> Node:
    todo, n = [root], 0
    while todo:
        node = todo.pop()
        node.number, n = n, n + 1
        todo += reversed(node.children)
    return root


def _table(a: list[Node], b: list[Node], scores: dict) -> list[list[int]]:
    """Best match of the first i and j children, in order."""
    table = [[0] * (len(b) + 1)]
    for x in a:
        above, row, left = table[-1], [0], 0
        for j, y in enumerate(b):
            w = _score(x, y, scores)
            best = above[j] + w if w else 0
            left = max(best, left, above[j + 1])
            row.append(left)
        table.append(row)
    return table


def _score(a: Node, b: Node, scores: dict) -> int:
    """Nodes in the largest match of two trees whose roots match; equal texts count more. Inner nodes are in ``scores``."""
    if a.symbol != b.symbol:
        return 0
    if not a.children or not b.children:
        return 3 if a.text and a.text == b.text else 1
    return scores[id(a), id(b)]


def _fill(a: Node, b: Node, scores: dict) -> None:
    """The scores of all inner nodes below two that match, from the bottom up."""
    todo, order = [(a, b)], []
    while todo:
        x, y = todo.pop()
        order.append((x, y))
        inner = [c for c in y.children if c.children]
        todo += [(c, d) for c in x.children if c.children for d in inner if c.symbol == d.symbol]
    for x, y in reversed(order):
        scores[id(x), id(y)] = 1 + _table(x.children, y.children, scores)[-1][-1]


def align(page: Node, reference: Node) -> dict[int, Node]:
    """The reference's node for the nodes (by identity) of the page that match one."""
    pairs, scores, todo = {}, {}, [(page, reference)]
    _fill(page, reference, scores)
    while todo:
        a, b = todo.pop()
        pairs[id(a)] = b
        table, i, j = _table(a.children, b.children, scores), len(a.children), len(b.children)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((a.children[i], b.children[j]))
    return pairs


def _runs(node: Node) -> list[Node]:
    """The text runs below a node that are in no excluded region, in page order."""
    out, todo = [], [node]
    while todo:
        here = todo.pop()
        if here.out:
            continue
        if here.text:
            out.append(here)
        todo += reversed(here.children)
    return out


def _sizes(root: Node) -> tuple[list[Node], dict[int, int]]:
    """The nodes in no excluded region, outer ones first, and the characters below each by identity."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.out:
            order.append(node)
            todo += node.children
    size: dict[int, int] = {}
    for n in reversed(order):
        size[id(n)] = len(n.text) + sum(size.get(id(c), 0) for c in n.children)
    return order, size


def _article(root: Node) -> Node:
    """The element that tells the article from others: the fullest one marked as such, else the smallest with most of the text."""
    order, size = _sizes(root)
    marked = [n for n in order if n.main]
    if marked:
        inner = [n for n in marked if n.tag == "article"] or marked
        return max(inner, key=lambda n: size[id(n)])
    node, whole = root, size.get(id(root), 0)
    while True:
        larger = [c for c in node.children if size.get(id(c), 0) > 0.7 * whole]
        if not larger or larger[0].text:
            return node
        node = larger[0]


def _identity(root: Node) -> int:
    """Equal for pages of one article: a hash of the longest text run of the element that holds it."""
    text = max((r.text for r in _runs(_article(root))), key=len, default="")
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _other_layout(root: Node, pairs: dict[int, Node]) -> str | None:
    """If most of the page's text is in elements unknown to the reference at their place: the fullest one's place and symbol."""
    order, size = _sizes(root)
    unknown: dict[tuple, int] = {}
    for node in order:
        twin = pairs.get(id(node))
        if twin is None or not node.children:
            continue
        symbols = {c.symbol for c in twin.children}
        for c in node.children:
            if c.tag and c.symbol not in symbols and size.get(id(c)):
                at = (twin.number, *c.symbol)
                unknown[at] = unknown.get(at, 0) + size[id(c)]
    if 2 * sum(unknown.values()) <= size.get(id(root), 0):
        return None
    return hashlib.blake2b(repr(max(unknown, key=lambda at: (unknown[at], at))).encode("utf-8", "replace"), digest_size=8).hexdigest()


def _judged(root: Node, pairs: dict[int, Node]) -> list[tuple[int, bool, str]]:
    out = []
    for run in _runs(root):
        twin = pairs.get(id(run))
        out.append((-1 if twin is None else twin.number, twin is not None and twin.text == run.text, run.text))
    return out


def blocks(page: str | None, reference: Node | None) -> list[tuple[int, bool, str]]:
    """The page's text runs in no excluded region: number of the reference's node (-1: none), same text there, the text."""
    root = parse(page or "")
    return _judged(root, align(root, reference) if reference is not None else {})


def _extract(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    kept: dict[str, Node] = {}
    for pages, references in batches:
        out = []
        for page, reference in zip(pages, references, strict=True):
            if reference is not None and reference not in kept:
                if len(kept) >= 200:
                    kept.clear()
                kept[reference] = _number(parse(reference))
            root = parse(page or "")
            pairs = align(root, kept[reference]) if reference is not None else {}
            out.append((_identity(root), _other_layout(root, pairs),
                        [{"node": n, "same": s, "text": t} for n, s, t in _judged(root, pairs)]))
        yield pd.DataFrame(out, columns=["article", "layout", "blocks"])


def _with_references(rows: DataFrame, hosts: DataFrame, total: int) -> DataFrame:
    """Every row with its host's reference, of any length.

    Of the hot hosts (see ``join_classes``), the largest are broadcast as far as their references have a bounded size;
    the rows of the others are dealt to several shares of the host, each with a copy of the reference.
    """
    hot = hosts.filter(F.col("pages") * HOT_CLASSES > total).select(
        "host", "pages", F.coalesce(F.octet_length("reference"), F.lit(0)).alias("size")).collect()   # under HOT_CLASSES rows
    marks, used = [], 0
    for host, pages, size in sorted(hot, key=lambda r: (-r["pages"], r["host"])):
        fits = used + size <= BROADCAST_BYTES
        used += size if fits else 0
        marks.append((host, 0 if fits else -(-pages * HOT_CLASSES // total)))
    marked = F.broadcast(rows.sparkSession.createDataFrame(marks, "host string, shares int"))
    near = F.broadcast(hosts.join(marked.filter("shares = 0"), "host").select("host", "reference"))
    shares = F.coalesce("shares", F.lit(1))
    far = rows.join(marked, "host", "left").filter(shares > 0).withColumn("share", (F.monotonically_increasing_id() % shares).cast("int"))
    copies = hosts.join(marked, "host", "left").filter(shares > 0).select(
        "host", "reference", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    return rows.join(near, "host").unionByName(
        far.drop("shares").join(copies, ["host", "share"], "left").drop("share"))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``id_col, url_col, text``, the article's blocks joined by single spaces.

    Null, empty and textless pages have an empty text. Pages without a readable host are one group. Repeated
    rows keep a row each and count as one article, as do pages whose article has an equal longest block. Elements
    marked as the article's say which block that is; what is outside of them is judged as all else.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host.alias("host"), F.lit(None).cast("array<boolean>").alias("gone"))
    finished = None
    while rows is not None:
        done, rows = _round(rows)
        finished = done if finished is None else finished.unionByName(done)
    kept = F.filter("blocks", lambda b, i: ~F.get("gone", i))
    return finished.select(F.col("id").alias(id_col), F.col("url").alias(url_col),
                           F.array_join(F.transform(kept, lambda b: b["text"]), " ").alias("text"))


def _round(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Align every page with its group's reference: the rows that are done, and those that another layout's reference fits.

    ``gone`` tells which text runs are template. Pages of another layout form a group of their own, if it has
    enough different articles to tell anything; what was found with the first reference stays found.
    The reference is never of another layout than itself, so groups shrink from round to round.
    """
    complete = F.lower(F.substring("html", -20, 20)).contains("</html")
    candidate = F.struct(~complete, F.xxhash64("html"), F.col("html"))
    hosts = cut_lineage(rows.groupBy("host").agg(F.min(F.when(F.col("html").isNotNull(), candidate))["html"].alias("reference"),
                                                 F.count("*").alias("pages")))
    total = hosts.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    extract = F.pandas_udf(_extract, "article long, layout string, blocks array<struct<node:int,same:boolean,text:string>>")
    parsed = _with_references(rows, hosts, total).withColumn("found", extract("html", "reference")).select(
        "id", "url", "host", "gone", F.when(F.col("found.layout").isNotNull(), F.col("html")).alias("html"), "found.*")
    parsed = cut_lineage(parsed)
    seen = F.transform("blocks", lambda b: F.struct(b["node"], b["same"].cast("int").alias("same")))
    articles = parsed.select("host", "article", F.struct(F.col("layout").isNotNull().alias("other"), seen.alias("seen")).alias("page")
                             ).groupBy("host", "article").agg(F.min("page").alias("page"))
    every = F.struct(F.lit(EVERY).alias("node"), F.lit(1).alias("same"))
    nodes = articles.select("host", (~F.col("page.other")).cast("int").alias("own"), F.explode(F.array_append(
        F.filter("page.seen", lambda s: s["node"] >= 0), every)).alias("s")).groupBy("host", "s.node").agg(
            F.sum("s.same").alias("same"), F.sum(F.col("s.same") * F.col("own")).alias("own"))
    count = F.struct("node", "same", "own")
    counted = nodes.groupBy("host").agg(F.max(F.when(F.col("node") == EVERY, count)).alias("all"),
                                        F.collect_list(F.when(F.col("node") != EVERY, count)).alias("nodes"))
    most = lambda c, n: (F.col(f"all.{n}") >= LEAST_ARTICLES) & (c[n] >= CONSTANT * F.col(f"all.{n}"))
    constant = F.filter("nodes", lambda c: most(c, "same") | most(c, "own"))
    wrappers = counted.select("host", constant["node"].alias("template")).filter(F.size("template") > 0)
    wrappers = hosts.select("host", "pages").join(wrappers, "host", "left")
    template = F.coalesce("template", F.array().cast("array<int>"))
    gone = F.transform("blocks", lambda b, i: (b["same"] & F.array_contains(F.col("t"), b["node"]))
                       | F.coalesce(F.get("gone", i), F.lit(False)))
    judged = join_classes(parsed, wrappers, "host", "pages", total).withColumn("t", template).withColumn("gone", gone)
    done = judged.select("id", "url", "blocks", "gone")
    others = parsed.filter("layout is not null").select("host", "layout", "article").distinct().groupBy("host", "layout").agg(
        F.count("*").alias("n")).filter(F.col("n") >= LEAST_ARTICLES).select("host", "layout", F.lit(True).alias("again"))
    others = cut_lineage(others)
    if others.isEmpty():
        return done, None
    moved = judged.filter("layout is not null").join(others, ["host", "layout"], "left")
    done = judged.filter("layout is null").unionByName(moved.filter("again is null").drop("again")).select(
        "id", "url", "blocks", "gone")
    return done, cut_lineage(moved.filter("again").select(
        "id", "url", "html", F.concat_ws("#", "host", "layout").alias("host"), "gone"))
