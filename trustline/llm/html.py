"""Main text of web pages by site style trees.

The pages of a host are merged into one style tree of all that they show.  Its nodes are the
structural elements and those that carry a style (class, id or role), by the path that leads to
them; paragraphs, headings, whole lists and tables are the leaves of the node around them.  A
node's importance, over the distinct pages of the host that have it, is

    (1 - G) * entropy of its layouts  +  G * (1 - mean over its leaves of log(pages with it) / log(pages))

and a leaf's is 1 - log(pages with it) / log(pages with its node).  So what looks and reads the
same on page after page comes out near 0 and is removed from each page, while what a few pages
share stays.  Of what a page marks as its article the leaves are judged and the branches in it;
it stays whole where most of it would go, as a copy of another page.  A heading stays with what
it heads.  Of what is left the article is taken if the page marks one, else the body without
blocks that are mostly links.

Elements and roles that say what they are (menus, forms ...) and hidden ones go on any host.  A
name that says so goes only as a whole (a class or the id, all its words), never from a heading,
a paragraph, a branch with the page's h1 or one with most of its text; in an article, words that
can be a subject don't count.  Where enough pages have the style node, its importance must
confirm the name.

A page is parsed once: its blocks with their nodes are stored as a draft, and texts are put
together from drafts.  Nothing of a host meets in one task: layouts and leaves are counted by (host, node, leaf), with
pages of equal main text counted once.

Defined cases: a NULL or empty page has the empty text; unclosed and misnested elements are
closed as browsers do; a page without a host name belongs to the host ''.  Repeated rows give
repeated results; other columns stay out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustline.llm.shared import lean, stored

MIN_PAGES = 5  # distinct pages of a host that a node needs before it can be judged
IMPORTANT = 0.2
G = 0.9
LINKS = 0.6  # of a block's characters, in a page that marks no article

_WORDS = str.split
VOID = set(_WORDS("area base br col embed hr img input link meta param source track wbr"))
BLOCKS = set(
    _WORDS(
        "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul"
    )
)
STRUCTURE = set(_WORDS("article aside body div footer form header main nav section table"))
SILENT = set(_WORDS("audio button canvas datalist embed form head iframe input label map menu meter nav noscript object optgroup option output progress script select style svg template textarea title video"))
MARGIN = set(_WORDS("aside dialog footer header"))
SILENT_ROLES = set(_WORDS("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar"))
SILENT_STYLES = set(
    _WORDS(
        "ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
        "disclaimer discussion disqus dropdown footer gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice notices "
        "notification pager pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharing sidebar "
        "signup skip social sponsor sponsored subscribe subscription teaser toolbar widget"
    )
)
#: What also an element marked as article can be.
SILENT_ARTICLES = set(_WORDS("ad ads advert advertisement comment comments promo promoted related reply sponsored teaser"))
#: Of these words those that also name a part or a subject of a text; in an article they don't count.
TOPICS = set(
    _WORDS(
        "alert banner comment consent cookie cookies copyright disclaimer discussion header hidden legal login menu navigation newsletter notice notices "
        "notification promotion recommended related replies reply respond search share sharing skip social sponsor subscription teaser"
    )
)
#: Words that add nothing to such a name.
HOLDERS = set(_WORDS("area bar block box button buttons container form group icons inner link links list outer panel site slot unit wrap wrapper"))
HEADINGS = set(_WORDS("h1 h2 h3 h4 h5 h6"))
#: Elements that are one content node with all plain elements in them.
UNITS = BLOCKS - STRUCTURE - set(_WORDS("br center fieldset head hr html title")) | {"table"}
#: Elements that end when one of the others starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCKS - {"br", "head", "html", "body", "title", "option", "legend", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
SCOPES = set(_WORDS("article aside body div footer form header html main nav ol section table td th ul"))


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.opened: dict[str, int] = {}  # elements of each tag that are open

    def _close(self, node: Node) -> None:
        while self.at is not node:
            self.opened[self.at.tag] -= 1
            self.at = self.at.parent
        self.opened[node.tag] -= 1
        self.at = node.parent

    def _open(self, tags: set[str], within: set[str]) -> Node | None:
        # Most of the time there is none, and no way up to be gone.
        if not any(self.opened.get(tag) for tag in tags):
            return None
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                return node
            if node.tag in within:
                return None
            node = node.parent
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body" or (tag in BLOCKS and tag not in ("head", "title", "html")):
            if head := self._open({"head"}, set()):
                self._close(head)
        if tag in CLOSES_P and (p := self._open({"p"}, SCOPES)):
            self._close(p)
        if tag in ENDS and (before := self._open(ENDS[tag], SCOPES - {"td", "th"} if tag == "tr" else SCOPES - ENDS[tag])):
            self._close(before)
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.opened[tag] = self.opened.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "a", "b", "i", "span", "em", "strong") and self.at.tag == tag:
            self._close(self.at)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag not in VOID and (node := self._open({tag}, set() if tag in SCOPES or tag in ("head", "p") else SCOPES)):
            self._close(node)

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(re.sub(r"<!\[[^>]*>", "", html))  # marked sections are comments up to the next >
    tree.close()
    return tree.root


def _style(node: Node) -> list[str]:
    names = f"{node.attrs.get('class') or ''} {node.attrs.get('id') or ''}"
    return re.findall(r"[a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", names).lower())


def _names(node: Node) -> list[list[str]]:
    """The words of each class and of the id."""
    names = f"{node.attrs.get('class') or ''} {node.attrs.get('id') or ''}"
    return [re.findall(r"[a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()) for name in names.split()]


def _walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """Nodes and texts in order; each node once as it begins and once as it ends."""
    stack: list = [(root, True)]
    while stack:
        node, begins = stack.pop()
        yield node, begins
        if begins and isinstance(node, Node):
            stack.append((node, False))
            stack.extend((c, True) for c in reversed(node.children))


def _marked(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attrs.get("role") in ("main", "article") or node.attrs.get("itemprop") == "articleBody"


def _article(node: Node) -> bool:
    """Whether the page marks it as its article, not as a comment or a teaser."""
    return _marked(node) and not any(words and set(words) <= SILENT_ARTICLES | HOLDERS and set(words) & SILENT_ARTICLES for words in _names(node))


def _silent(node: Node, holds_article: bool, in_article: bool, holds_title: bool) -> bool:
    """Whether its element or role says that a branch is not main text, or the page hides it."""
    if node.tag in SILENT:
        return True
    attrs = node.attrs
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style") or ""):
        return True
    if node.tag in ("", "html", "body") or _marked(node) or holds_article:
        return False
    if in_article and holds_title and node.tag == "header":
        return False
    return node.tag in MARGIN or (attrs.get("role") or "").lower() in SILENT_ROLES


def _named(node: Node, holds_article: bool, in_article: bool, holds_title: bool) -> bool:
    """Whether one of its names as a whole says that a branch is not main text; only its host's pages or their lack confirm it."""
    if _marked(node):
        return not _article(node)
    if node.tag in ("", "html", "body", "p") or node.tag in HEADINGS or holds_article or holds_title:
        return False
    says = SILENT_STYLES - TOPICS if in_article else SILENT_STYLES
    return any(set(words) & says and set(words) <= SILENT_STYLES | HOLDERS for words in _names(node))


class Block(NamedTuple):
    node: int  # style node
    inside: bool  # of a marked article
    text: str
    linked: int  # characters in links
    tag: str
    unit: int
    names: tuple[int, ...]  # branches around it whose name speaks against them

    @property
    def chars(self) -> int:
        return len("".join(self.text.split()))


class Draft:
    """What is left of a parsed page: for each style node its blocks of text, in page order."""

    def __init__(self, blocks: list[Block], marked: set[int], parent: dict[int, int], has_article: bool, leaves: dict[tuple[int, int], int]) -> None:
        self.blocks = blocks
        #: Nodes that the page itself marks as its article; of these only the leaves are judged.
        self.marked = marked
        self.parent = parent
        self.has_article = has_article
        #: The content node that each block belongs to.
        self.leaves = leaves

    def stored(self) -> bytes:
        """Everything as one value; the last names of nodes are enough to find their parents."""
        text = json.dumps([self.blocks, sorted(self.marked), list(self.parent.items()), self.has_article, [(*at, leaf) for at, leaf in self.leaves.items()]], ensure_ascii=False, separators=(",", ":"))
        return text.encode("utf-8", "surrogatepass")

    @classmethod
    def restored(cls, raw: bytes) -> Draft:
        blocks, marked, parent, has_article, leaves = json.loads(raw.decode("utf-8", "surrogatepass"))
        return cls([Block(*b) for b in blocks], set(marked), dict(map(tuple, parent)), has_article, {(n, u): leaf for n, u, leaf in leaves})

    def _leaf(self, block: Block) -> int:
        return self.leaves[block.node, block.unit]

    def _under(self, node: int, top: int) -> bool:
        while node != top and node:
            node = self.parent[node]
        return node == top

    def text(self, low: set[int], high: set[int] | frozenset = frozenset()) -> str:
        """The main text without the style nodes and leaves in ``low``; names don't remove nodes in ``high``."""
        if self.has_article:
            blocks = [b for b in self.blocks if b.inside]
        else:
            blocks = [b for b in self.blocks if b.linked < LINKS * b.chars]
        total, held = sum(b.chars for b in blocks), {}
        for b in blocks:
            for n in b.names:
                held[n] = held.get(n, 0) + b.chars
        most = {n for n, chars in held.items() if 2 * chars > total}
        gone = [
            (b.node in low and b.node not in self.marked) or (b.node not in high and any(n not in most for n in b.names)) for b in blocks
        ]
        leaf = [not out and self._leaf(b) in low for b, out in zip(blocks, gone, strict=True)]
        # A heading stays with what it heads.
        for i in reversed(range(len(blocks))):
            if leaf[i] and blocks[i].tag in HEADINGS:
                for j in range(i + 1, len(blocks)):
                    if (blocks[j].tag in HEADINGS and blocks[j].tag <= blocks[i].tag) or not self._under(blocks[j].node, blocks[i].node):
                        break
                    if not (gone[j] or leaf[j]):
                        leaf[i] = False
                        break
        # An article that is mostly repeated is a copy of another page's, not its frame.
        own = [at and b.node in self.marked for b, at in zip(blocks, leaf, strict=True)]
        if 2 * sum(b.chars for b, at in zip(blocks, own, strict=True) if at) > total:
            leaf = [at and not o for at, o in zip(leaf, own, strict=True)]
        return " ".join(b.text for b, *out in zip(blocks, gone, leaf, strict=True) if not any(out))

    def nodes(self) -> Iterator[tuple[int, int, list[int], bool, bool, bool]]:
        """(style node, hash of its layout, its distinct leaves, whether it is an article, can be in the text, and there has a name against it)."""
        own: dict[int, list[Block]] = {}
        for b in self.blocks:
            own.setdefault(b.node, []).append(b)
        for node, blocks in own.items():
            layout = xxhash.xxh64_intdigest(" ".join(b.tag for b in blocks))
            shown = [b for b in blocks if b.inside or not self.has_article]
            yield node, layout >> 1, sorted({self._leaf(b) for b in blocks}), node in self.marked, bool(shown), any(b.names for b in shown)


class Page(Draft):
    """A page as it is parsed."""

    def __init__(self, html: str) -> None:
        super().__init__([], set(), {}, False, {})
        root = parse(html)
        holds, titled = set(), set()
        for node, begins in _walk(root):
            if begins and isinstance(node, Node) and (_article(node) or node.tag == "h1"):
                found, up = holds if _article(node) else titled, node.parent
                while up is not None and id(up) not in found:
                    found.add(id(up))
                    up = up.parent
        self.has_article = bool(holds)
        path, inside, links, texts, linked = [(0, {})], 0, 0, [], 0
        skipped: Node | None = None
        block_tag = ""
        units, unit, names, named = [0], 0, [], 0

        def flush() -> None:
            nonlocal texts, linked, unit
            text = " ".join("".join(texts).split())
            if text:
                if not units[-1]:
                    unit += 1
                self.blocks.append(Block(path[-1][0], inside > 0, text, linked, block_tag, units[-1] or unit, tuple(n for _, n in names)))
            texts, linked = [], 0

        for node, begins in _walk(root):
            if skipped is not None:
                if node is skipped and not begins:
                    skipped = None
                continue
            if not isinstance(node, Node):
                texts.append(node)
                if links:
                    linked += len("".join(node.split()))
                continue
            if node.tag in BLOCKS:
                flush()
                block_tag = node.tag if begins else ""
            styled = node.tag in STRUCTURE or (node.tag in BLOCKS and any(node.attrs.get(a) for a in ("class", "id", "role")))
            if begins:
                where = id(node) in holds, inside > 0, id(node) in titled
                if _silent(node, *where):
                    skipped = node
                    continue
                if node.tag in BLOCKS and _named(node, *where):
                    named += 1
                    names.append((node, named))
                inside += _article(node)
                links += node.tag == "a"
                if node.tag in BLOCKS:
                    if node.tag in UNITS and not units[-1] and (node.tag == "table" or not styled):
                        unit += 1
                        units.append(unit)
                    else:
                        units.append(0 if styled else units[-1])
                if styled:
                    name = ".".join([node.tag, *sorted(_style(node))])
                    seen = path[-1][1]
                    seen[name] = seen.get(name, 0) + 1
                    nth = min(seen[name], 3) if name == node.tag else 0
                    own = xxhash.xxh64_intdigest(f"{path[-1][0]}/{name}/{nth}") >> 1
                    self.parent[own] = path[-1][0]
                    path.append((own, {}))
                    if _article(node):
                        self.marked.add(own)
            else:
                if names and names[-1][0] is node:
                    names.pop()
                inside -= _article(node)
                links -= node.tag == "a"
                if node.tag in BLOCKS:
                    units.pop()
                if styled:
                    path.pop()
        flush()
        together: dict[tuple[int, int], list[str]] = {}
        for b in self.blocks:
            together.setdefault((b.node, b.unit), []).append(b.text)
        self.leaves = {at: xxhash.xxh64_intdigest(f"{at[0]}/{chr(10).join(t)}") >> 1 for at, t in together.items()}


def host_of(url: str | None) -> str:
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return found[1].rpartition("@")[2].lower() if found else ""


_NODE = pa.struct([("node", pa.int64()), ("layout", pa.int64()), ("leaves", pa.list_(pa.int64())), ("article", pa.bool_()), ("shown", pa.bool_()), ("named", pa.bool_())])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns in: key, id, url, html. Out: key, id, url, host, a digest of the text, the page's style nodes, and its draft."""
    for batch in batches:
        hosts, digests, nodes, drafts = [], [], [], []
        for url, html in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            page = Page(html)
            hosts.append(host_of(url))
            digests.append(xxhash.xxh64_intdigest(page.text(set())) >> 1)
            nodes.append([dict(zip(_NODE.names, node, strict=True)) for node in page.nodes()])
            drafts.append(page.stored())
        columns = [*batch.columns[:3], pa.array(hosts, pa.string()), pa.array(digests, pa.int64()), pa.array(nodes, pa.list_(_NODE)), pa.array(drafts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["key", "id", "url", "host", "digest", "nodes", "draft"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns in: id, url, draft, low (style nodes and leaves to remove), high (named style nodes to keep)."""
    for batch in batches:
        texts = [Draft.restored(raw).text(set(low or ()), set(high or ())) for raw, low, high in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])


def judged(features: DataFrame, min_pages: int = MIN_PAGES, important: float = IMPORTANT) -> tuple[DataFrame, DataFrame]:
    """(host, node, low) of the branches in their host's style tree and (host, node, leaf) of the leaves of low importance."""
    # Of pages with equal main texts one counts, the same one on every run.
    once = features.groupBy("host", "node", "digest").agg(F.min(F.struct("layout", "leaves")).alias("f")).select("host", "node", "f.*")
    layouts = once.groupBy("host", "node", "layout").agg(F.count("*").alias("n"))
    pages = layouts.groupBy("host", "node").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("of_layouts")).where(F.col("pages") >= min_pages)
    leaves = once.select("host", "node", F.explode("leaves").alias("leaf")).groupBy("host", "node", "leaf").agg(F.count("*").alias("n"))
    texts = leaves.groupBy("host", "node").agg(F.avg(F.log("n")).alias("of_texts"))
    presentation = 1 - F.col("of_layouts") / (F.col("pages") * F.log("pages"))
    content = 1 - F.col("of_texts") / F.log("pages")
    nodes = pages.join(texts, ["host", "node"]).select("host", "node", ((1 - G) * presentation + G * content < important).alias("low"))
    # A leaf that can be low is on so many pages; this keeps the large branches of a host out of the join.
    often = leaves.where(F.col("n") >= max(2, min_pages ** (1 - important)))
    low = often.join(pages, ["host", "node"]).where(1 - F.log("n") / F.log("pages") < important).select("host", "node", "leaf")
    return nodes, low


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """Per page: id, url, and the main text."""
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    source = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))
    source = source.select(F.xxhash64("id", "url", "html").alias("key"), "*")
    kind = source.schema["id"].dataType.simpleString()
    node = "node long, layout long, leaves array<long>, article boolean, shown boolean, named boolean"
    kinds = f"key long, id {kind}, url string, host string, digest long, nodes array<struct<{node.replace(' ', ':').replace(',:', ', ')}>>, draft binary"
    parsed = stored(source.mapInArrow(lean(_parsed), kinds), "parsed")
    features = parsed.select("key", "host", "digest", F.inline("nodes"))
    nodes, leaves = judged(features, **options)
    nodes = stored(nodes, "judged")
    of_nodes = features.join(nodes, ["host", "node"]).where("if(low, shown and not article, named)").select("key", F.col("node").alias("item"), "low")
    of_leaves = features.where("shown").select("key", "host", "node", F.explode("leaves").alias("leaf")).join(leaves, ["host", "node", "leaf"]).select("key", F.col("leaf").alias("item"), F.lit(True).alias("low"))
    items = of_nodes.unionByName(of_leaves).groupBy("key").agg(F.collect_set(F.when(F.col("low"), F.col("item"))).alias("low"), F.collect_set(F.when(~F.col("low"), F.col("item"))).alias("high"))
    # Its size is known once it is stored: where few pages lose anything the pages aren't shuffled.
    found = parsed.join(stored(items, "removed"), "key", "left").select("id", "url", "draft", "low", "high")
    return found.mapInArrow(lean(_extract), f"id {kind}, url string, text string")
