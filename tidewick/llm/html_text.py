"""Main text of web pages by consensus host paths.

Every page's containers are scored by the text that they hold, links and boilerplate counted against them. Each page votes,
by score, for the generalised paths of its containers (tags and classes from the root, numbers in classes set to 0, so that
pages of one template agree; a path is told by a digest, so that deep pages cost no more than others of their size). Votes
are summed for each host in Spark, and the best path of a host wins. Pages are then extracted again by the winning path; a
page without such a container falls back to its own best one.

The text is that of the container's blocks in page order, without menus, headers and footers of the page, sidebars,
notices, adverts, forms, scripts, styles and reader comments: elements are left out by their tag or role, or by their class
or id, where it is a word of ``STRONG`` or ``WEAK``, alone or with words for boxes and pages (share-buttons, article-menu, but not
share-price or menu-du-jour, which may stand on content). Where a word of ``STRONG`` stands with others, the content
decides: it is left out if half of its text or more is linked, as in menus. Character references are decoded in each text
node by itself, white space inside a block becomes one space, blocks are joined by one.

All containers of positive score vote; votes are pre-aggregated before they are shuffled, so that a host with a third of
all pages is no hot spot. Winners, a short row for each host, are broadcast where they are few (``common.meet``), so that no
page is shuffled; beyond, hosts are salted on both sides.

Defined cases: a null html or url counts as empty (the empty host votes like any other); a page without text gives the empty
text; very long and deeply nested pages are read whole, in time in proportion to their length; equal votes go to the deeper
path, then by digest, equal scores on a page likewise; repeated rows each get their own result and vote each; a column named
like the result is replaced, all others pass through, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from hashlib import blake2b
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST, meet, scratch
from .url_filter import host_of

VOTED = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("depth", T.IntegerType()), T.StructField("share", T.DoubleType())]))
LEVEL, TITLE = 0.9, 1.15
WEIGHTS = {"article": 1.5, "main": 1.2, "body": 0.9}
# Possessive, so that a tag that never ends costs one pass.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/<>]*+)((?>[^<>"'=]++|=\s*+(?:"[^"]*"|'[^']*')|[="'])*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$)")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
# An opening tag that ends an open one of the same family, up to the list or table that holds it.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Left out by tag, by role and by a word of the class or id.
SKIP_TAGS = RAW | frozenset("head nav aside footer form button select option input svg canvas object embed audio video template dialog menu datalist".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense promo promos sponsor sponsored sponsors outbrain taboola "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc sidebar sidebars masthead topbar toolbar "
    "footer comment comments commentlist disqus reply replies respond cookie cookies consent gdpr popup modal newsletter".split()
)
WEAK = frozenset(
    "banner promotion aside rail widget widgets foot header discussion notice notices alert alerts warning overlay subscribe "
    "subscription signup login share sharing social related recommended recommendations form search hidden".split()
)
BOXES = frozenset(
    "area bar bars block box btn button buttons column container content grid group icon icons inner items left link links list main message mobile "
    "module outer panel primary region right row secondary section slot strip text top bottom unit wrap wrapper zone "
    "article blog entry global page post reader site story user users".split()
)
LINKED = 0.5
# What holds the text of a page must not be left out for a word of its own class, as in <body class="has-sidebar">.
ROOTS = frozenset(("html", "body", "main", "article"))
CONTAINERS = frozenset(("article", "main", "section", "div", "td", "body", "center"))


class Node:
    """An element: the digest of its path, and its texts and elements in order."""

    __slots__ = ("tag", "key", "depth", "parts", "skip", "doubt")

    def __init__(self, tag: str, key: bytes, depth: int, skip: bool, doubt: bool = False):
        self.tag, self.key, self.depth, self.skip, self.doubt, self.parts = tag, key, depth, skip, doubt, []


def _named_so(names: str) -> bool | None:
    """Whether a class or id tells of something beside the text; None where it may, and may tell of what the text is about."""
    doubt = False
    for name in names.split():
        words = [w.lower() for w in WORD.findall(name)]
        if any(w in STRONG or w in WEAK for w in words):
            if all(w in STRONG or w in WEAK or w in BOXES or w.isdigit() for w in words):
                return True
            doubt |= any(w in STRONG for w in words)
    return None if doubt else False


def _left_out(tag: str, attributes: dict[str, str], in_article: bool) -> bool | None:
    """Whether an element is left out; None where its content decides."""
    if tag in SKIP_TAGS or attributes.get("role", "").lower() in SKIP_ROLES or attributes.get("aria-hidden") == "true" or "hidden" in attributes:
        return True
    if tag == "header":
        # An article's own header holds its title; the page's holds its name and menu.
        return not in_article
    if tag in ROOTS:
        # An article inside a comment list is left out with the list, or by its own class.
        return tag == "article" and bool({"comment", "reply"} & {w.lower() for w in WORD.findall(attributes.get("class", ""))})
    told = [_named_so(attributes.get("class", "")), _named_so(attributes.get("id", ""))]
    return True if True in told else None if None in told else False


class Open:
    """The open elements, innermost last, with the places of each tag and of blocks among them."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.blocks = [root], {}, [0]

    def innermost(self, tags: Iterable[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag not in INLINE:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Close the element at the place, and with it all inside."""
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()
            if self.blocks[-1] == len(self.nodes):
                self.blocks.pop()


def parse(page: str) -> Node:
    """The tree of a page, lenient to tags that are not closed or closed twice."""
    root = Node("", b"", 0, False)
    held = Open(root)
    doubts = False
    at, end = 0, len(page)
    while at < end:
        node = held.nodes[-1]
        found = TAG.search(page, at)
        text = page[at : found.start() if found else end]
        if text:
            node.parts.append(html.unescape(text) if "&" in text else text)
        if found is None:
            break
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if (place := held.innermost((tag,))) > 0:
                held.close(place)
            elif tag == "p":
                node.parts.append(" ")
            continue
        if tag in ENDS:
            # A row ends the cell in it and the row itself.
            ends, within = ENDS[tag]
            while (place := held.innermost(ends)) > held.innermost(within):
                held.close(place)
        elif tag in CLOSES_P and (place := held.innermost("p")) > 0 and place == held.blocks[-1]:
            held.close(place)
        node = held.nodes[-1]
        attributes = {name.lower(): html.unescape(a or b or c or "") for name, a, b, c in ATTRIBUTE.findall(found[3])} if "=" in found[3] else {}
        if HIDDEN.search(found[3]):
            attributes["hidden"] = ""
        names = re.sub("[0-9]+", "0", ".".join(sorted(set(attributes.get("class", "").split()))))
        key = blake2b(f"{tag}.{names}".encode("utf-8", "surrogatepass"), digest_size=12, key=node.key).digest()
        beside = _left_out(tag, attributes, held.innermost(("article", "main")) > 0)
        new = Node(tag, key, len(held.nodes), node.skip or bool(beside), beside is None)
        doubts |= new.doubt
        node.parts.append(new)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not found[3].endswith("/"):
            held.push(new)
    if doubts:
        _settle(root)
    return root


def _settle(root: Node) -> None:
    """Leave out what is doubtful and mostly linked."""
    order, work = [], [root]
    while work:
        node = work.pop()
        order.append(node)
        work += [x for x in node.parts if isinstance(x, Node) and not x.skip]
    sums: dict[int, tuple[int, int]] = {}  # text and linked text
    for node in reversed(order):
        inner = [sums[id(x)] for x in node.parts if isinstance(x, Node) and id(x) in sums]
        text = sum(len(x.strip()) for x in node.parts if isinstance(x, str)) + sum(x[0] for x in inner)
        linked = text if node.tag == "a" else sum(x[1] for x in inner)
        sums[id(node)] = text, linked
        if node.doubt and text and linked >= LINKED * text:
            node.skip = True
            sums[id(node)] = 0, 0


def text_under(top: Node) -> str:
    """The text of a node's blocks in page order, joined by one space."""
    out, work = [], [top]
    while work:
        part = work.pop()
        if isinstance(part, str):
            out.append(part)
        elif not part.skip or part is top:
            edge = "" if part.tag in INLINE else " "
            out.append(edge)
            work += [edge, *reversed(part.parts)]
    return " ".join("".join(out).split())


def containers(root: Node) -> list[tuple[float, Node]]:
    """Containers by score, best first.

    A container scores its text, that of inner containers a little less for each level between, so that of nested ones the
    closest wins, less twice what is linked; holding the title, or being an article or main, raises the score.
    """
    order, work = [], [root]
    while work:
        node = work.pop()
        order.append(node)
        work += [x for x in node.parts if isinstance(x, Node) and not x.skip]
    sums: dict[int, tuple[float, float, bool]] = {}  # text, linked text, whether there is a title
    found = []
    for node in reversed(order):
        text, linked, title = float(sum(len(x.strip()) for x in node.parts if isinstance(x, str))), 0.0, node.tag == "h1"
        for x in node.parts:
            if isinstance(x, Node) and not x.skip:
                inner, link, head = sums[id(x)]
                text, linked, title = text + inner * (LEVEL if x.tag in CONTAINERS else 1), linked + link, title or head
        sums[id(node)] = (text, text if node.tag == "a" else linked, title)
        if node.tag in CONTAINERS and text:
            weight = WEIGHTS.get(node.tag, 1.0) * (TITLE if title else 1)
            found.append(((text - 2 * linked) * weight, node))
    return sorted(found, key=lambda x: (-x[0], -x[1].depth, x[1].key))


def votes_of(page: str) -> list[tuple[str, int, float]]:
    """All paths of a page's containers of positive score with their depth and share of its best score."""
    found = [x for x in containers(parse(page)) if x[0] > 0]
    best: dict[str, tuple[int, float]] = {}
    for score, node in found:
        best.setdefault(node.key.hex(), (node.depth, score / found[0][0]))
    return [(path, *x) for path, x in best.items()]


def extract(page: str, path: str | None) -> str:
    """The text of all containers at the path, or of the page's best one where there is none."""
    root = parse(page)
    found = containers(root)
    chosen = [node for _, node in found if node.key.hex() == path] or [node for _, node in found[:1]] or [root]
    if len(chosen) > 1:
        # In page order, and none inside another.
        held, order, work = {id(n) for n in chosen}, [], [root]
        while work:
            node = work.pop()
            if id(node) in held:
                order.append(node)
            else:
                work += [x for x in reversed(node.parts) if isinstance(x, Node) and not x.skip]
        chosen = order
    return " ".join(x for x in map(text_under, chosen) if x)


@F.pandas_udf(VOTED)
def _votes(pages: pd.Series) -> pd.Series:
    return pages.map(lambda page: [dict(zip(("path", "depth", "share"), x)) for x in votes_of(page)])


@F.pandas_udf(T.StringType())
def _extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for pages, paths in batches:
        yield pd.Series([extract(page, path) for page, path in zip(pages, paths)], dtype="object")


def consensus(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """The winning path of each host: host, path (its digest), depth, votes."""
    votes = pages.select(host_of(F.col(url_col)).alias("host"), F.explode(_votes(F.coalesce(F.col(html_col), F.lit("")))).alias("vote"))
    # Shares are counted in thousandths, so that sums are the same in any order.
    summed = votes.groupBy("host", F.col("vote.path").alias("path")).agg(F.sum(F.round(F.col("vote.share") * 1000).cast("bigint")).alias("votes"), F.max("vote.depth").alias("depth"))
    best = summed.groupBy("host").agg(F.max(F.struct("votes", "depth", "path")).alias("best"))
    return best.select("host", "best.path", "best.depth", "best.votes")


def with_main_text(pages: DataFrame, out: str = "text", html_col: str = "html", url_col: str = "url", broadcast: int = BROADCAST) -> DataFrame:
    """pages with the main text of each whole html."""
    host, path = scratch(pages, "host", "path")
    paths = consensus(pages, html_col, url_col).select(F.col("host").alias(host), F.col("path").alias(path))
    joined = meet(pages.withColumn(host, host_of(F.col(url_col))), paths, host, broadcast)
    return joined.withColumn(out, _extracted(F.coalesce(F.col(html_col), F.lit("")), F.col(path))).select(*[c for c in pages.columns if c != out], out)
