"""Main text of web pages by site template removal.

Pages are cut into element trees. Every element subtree gets a hash of its tags, attributes and text; Spark counts, for
each host, on how many different pages each hash stands. Pages of a host with the same main part, templates included, are
copies and count once. Subtrees on ``MIN_PAGES`` pages, however many the host has, recur: they may be its template.

Elements that are never article text go first: navigation, forms, scripts, adverts, notices, reader comments, and what is
not shown, by tag, attribute, or the words of a class, id or role. Of the rest a page's main part is read, chosen by how
much text it holds: its largest article, its main element where that has more text beside its articles, or its body
where paragraphs outside of both have over four times its text and 200 letters more. Articles inside the chosen part that are not it (cards,
comments) are left out.

An article is read whole. Elsewhere recurring subtrees are deleted, by their place: the smallest element with half of the
part's own (not recurring) text stays whole, and what recurs outside of it goes. Where no element is smaller than the part
itself, what recurs before its first or after its last own text goes; lists, tables and plain text blocks there only if
they are mostly links. A part without any text of its own stays whole.

The deletion set is broadcast while it has at most ``BROADCAST_ROWS`` rows; beyond that it is joined to the pages by
element.

Defined cases: null html is empty; pages without a host share one empty host; unclosed and wrongly nested tags end where
their parent ends; a page of markup only has an empty text; repeated rows are pages of their own; pages of any length and depth are read
whole, without recursion and with one hash per element; a column ``text`` is replaced, others stay as they are; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MIN_PAGES = 5
BROADCAST_ROWS = 200_000
OUTSIDE_TIMES, OUTSIDE_LETTERS = 4, 200

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th tr pre blockquote figcaption caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
NOT_TEXT = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video nav footer aside form button input select"
    " option textarea label fieldset dialog menu title".split()
)
# Words in class, id and role that mark parts which are not the article, and words that go with them.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle adslot banner sponsor sponsored promo promos nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe"
    " signup login search share sharing social related recommended recommendations comment comments commentlist replies reply disqus"
    " pagination pager toolbar widget widgets skip complementary contentinfo commenter commenters commenting respond responses".split()
)
#: Words that mark a class or role by themselves, as its first or last word; an id only with known words.
STRONG = frozenset(
    "ad ads advert adverts advertisement adsense adsbygoogle adslot sponsored comment comments commentlist commenter disqus cookie cookies"
    " gdpr consent newsletter".split()
)
BESIDE = frozenset(
    "area article articles author count date discussion list meta post reader readers sticky thread user users aside bar block body bottom box btn button buttons center container content col column cta desktop fixed form"
    " google group head header icon icons inner item items label layer left link links list main mobile module outer overlay page panel"
    " placeholder posts primary reader region right row secondary section site slot small space stories text title top unit user wrap"
    " wrapper".split()
)
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
# Quotes open a value only right after "=": elsewhere they are letters like others.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
CASES = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])|[-_]+")
#: A slash that closes a tag, and not the end of a bare value.
CLOSED = re.compile(r"(?:^|[\s\"'])/$")
SIZE = re.compile(r"\d+(?:x\d+)?")
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element; ``end`` is the number in page order of the first element behind it."""

    __slots__ = ("attributes", "children", "end", "inside", "number", "skip", "tag")

    def __init__(self, tag: str, attributes: str = "", number: int = 0) -> None:
        self.tag, self.attributes, self.children, self.number = tag, attributes, [], number
        self.end, self.inside, self.skip = number + 1, False, False


def parse(html: str) -> list[Node]:
    """The elements of a page in page order, the root first; their children are elements and texts with decoded references."""
    nodes = [Node("html")]
    stack = nodes[:]
    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        if (text := html[at : m.start() if m else end]).strip():
            stack[-1].children.append(unescape(text))
        elif text:
            stack[-1].children.append(" ")
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in BLOCKS:
            shut, stops = CLOSES.get(tag, set()) | {"p"}, STOPS.get(tag, set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in shut:
                    del stack[k:]
                    break
                if stack[k].tag in stops or stack[k].tag in BLOCKS:
                    break
        node = Node(tag, m[3].strip(), len(nodes))
        nodes.append(node)
        stack[-1].children.append(node)
        if tag in VOID or CLOSED.search(node.attributes) and tag not in BLOCKS:
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(html, at)
            node.children.append(html[at : close.start() if close else end])
            at = close.end() if close else end
            continue
        stack.append(node)
    # Parents stand before their elements: one pass down, one pass up.
    for node in nodes:
        inside = node.inside or node.tag in ("article", "main")
        node.skip = not_text(node)
        for child in node.children:
            if isinstance(child, Node):
                child.inside = inside
    for node in reversed(nodes):
        for child in reversed(node.children):
            if isinstance(child, Node):
                node.end = child.end
                break
    return nodes


def attributes_of(text: str) -> dict[str, str]:
    """Names in lower case and their decoded values; of a repeated name the first counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(double or single or bare))
    return out


def is_mark(token: str, strong: bool = False) -> bool:
    """True for a class or id of marking words, alone or with words of layout: ``ad-box``, not ``related-work``.

    ``strong``: also where its first or last word, of three at most, is one that marks by itself.
    """
    known = [w.lower() for w in CASES.split(token) if w and not SIZE.fullmatch(w)]
    if any(w in MARKS for w in known) and all(w in MARKS or w in BESIDE for w in known):
        return True
    return strong and 0 < len(known) <= 3 and (known[-1] in STRONG or known[0] in STRONG and known[1:] != ["hoc"])


def not_text(node: Node) -> bool:
    """By its tag or its marks, an element is not part of an article.

    Headings carry no marks. Ids inside an article are often made from titles: there they mark only by known words, of
    which one marks by itself.
    """
    if node.tag in NOT_TEXT:
        return True
    if not node.attributes or node.tag in ("html", "body"):
        return False
    found = attributes_of(node.attributes)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or NOT_SHOWN.search(found.get("style", "")):
        return True
    if node.tag in HEADINGS or node.tag == "main":
        return False
    if any(name.startswith("data-ad-") for name in found):
        return True
    tokens = f"{found.get('class', '')} {found.get('role', '')}".split()
    if node.tag == "article":
        # Of an article, only its own comments and adverts.
        return any(is_mark(token, True) and STRONG & {w.lower() for w in CASES.split(token)} for token in tokens)
    if any(is_mark(token, True) for token in tokens) or "discussion" in tokens:
        return True
    ids = [] if node.tag in TEXT_BLOCKS else found.get("id", "").split()
    return any(is_mark(token) and (not node.inside or bool(STRONG & {w.lower() for w in CASES.split(token)})) for token in ids)


def subtree_hashes(nodes: list[Node]) -> Iterator[tuple[int, Node]]:
    """``(hash, element)`` of each element with text or elements that may be deleted, in page order; each is hashed once."""
    digests: list[bytes] = [b""] * len(nodes)
    for node in reversed(nodes):
        h = blake2b(f"{node.tag}\0{node.attributes}".encode("utf-8", "surrogatepass"), digest_size=8)
        for child in node.children:
            h.update(b"\1" + digests[child.number] if isinstance(child, Node) else b"\2" + " ".join(child.split()).encode("utf-8", "surrogatepass"))
        digests[node.number] = h.digest()
    at = 1
    while at < len(nodes):
        node = nodes[at]
        if node.tag in VOID or node.tag in ("head", "script", "style") or node.inside and node.tag in TEXT_BLOCKS:
            at = node.end
            continue
        if node.tag in BLOCKS and node.tag not in ("html", "body", "article", "main"):
            yield int.from_bytes(digests[at], "little", signed=True), node
        at += 1


def _letters(text: str) -> int:
    return sum(map(len, text.split()))


class _Sums:
    """Letters below each element that may be text: all, of links, and outside of what recurs and of other articles."""

    def __init__(self, nodes: list[Node], gone: set[int]) -> None:
        n = len(nodes)
        self.all, self.links, self.own, self.prose = ([0] * n for _ in range(4))
        for node in reversed(nodes):
            at = node.number
            for child in node.children:
                if not isinstance(child, Node):
                    k = _letters(child)
                    self.all[at] += k
                    self.own[at] += k
                    self.prose[at] += k if node.tag == "p" else 0
                elif not child.skip and child.tag != "article":
                    c = child.number
                    self.all[at] += self.all[c]
                    self.links[at] += self.all[c] if child.tag == "a" else self.links[c]
                    self.prose[at] += 0 if child.tag == "a" or c in gone else self.all[c] if node.tag == "p" else self.prose[c]
                    self.own[at] += 0 if c in gone else self.own[c]


def main_part(nodes: list[Node], sums: _Sums) -> Node:
    """The article, main element or whole page that holds the text."""
    articles, mains, at = [], [], 1
    while at < len(nodes):
        node = nodes[at]
        if not node.skip:
            if node.tag == "article":
                articles.append(node)
            elif node.tag == "main":
                mains.append(node)
        at = node.end if node.skip else at + 1

    def most(found: list[Node]) -> Node | None:
        return max(found, key=lambda x: sums.all[x.number], default=None)

    article, main = most(articles), most(mains)
    own = sums.all[article.number] if article else 0
    best = main if main and sums.all[main.number] > own else article
    if best is None or not sums.all[best.number]:
        return nodes[0]
    outside = sums.prose[0] - (sums.prose[main.number] if main else 0)
    return nodes[0] if outside > OUTSIDE_TIMES * max(own, sums.all[main.number] if main else 0) + OUTSIDE_LETTERS else best


def template_parts(nodes: list[Node], part: Node, gone: set[int], sums: _Sums) -> set[int]:
    """Of the recurring elements ``gone`` in the main part those that are template by their place."""
    if part.tag == "article" or not gone or not sums.own[part.number]:
        return set()
    whole = part
    while True:
        inner = [c for c in whole.children if isinstance(c, Node) and not c.skip and c.number not in gone and 2 * sums.own[c.number] >= sums.own[part.number]]
        if not inner or inner[0].tag not in BLOCKS or inner[0].tag in TEXT_BLOCKS:
            break
        whole = inner[0]
    if whole.tag not in ("html", "body", "main"):
        return {at for at in gone if not whole.number <= at < whole.end}
    # The part's text stands in itself: what recurs at its ends goes, but for text.
    places, at = [], part.number
    while at < part.end:
        node = nodes[at]
        if at in gone or node.skip:
            at = node.end
            continue
        if any(not isinstance(c, Node) and c.strip() for c in node.children):
            places.append(at)
        at += 1
    out = set()
    for at in gone:
        if places and places[0] < at < places[-1]:
            continue
        text = nodes[at].tag in TEXT_BLOCKS or nodes[at].tag in ("ul", "ol", "dl", "table", "tbody", "menu")
        if not text or 2 * sums.links[at] >= max(1, sums.all[at]):
            out.add(at)
    return out


def main_text(nodes: list[Node], deleted: set[int]) -> str:
    """The blocks of the page's main part without the template parts among ``deleted`` and what is not text."""
    gone = {node.number for h, node in subtree_hashes(nodes) if h in deleted} if deleted else set()
    sums = _Sums(nodes, gone)
    part = main_part(nodes, sums)
    gone = template_parts(nodes, part, gone, sums)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(line).split()):
            blocks.append(text)
        line.clear()

    # Elements under way, each with what is left of its children.
    way = [(part, iter(part.children))]
    while way:
        node, rest = way[-1]
        for child in rest:
            if not isinstance(child, Node):
                line.append(child)
            elif child.tag == "br":
                line.append(" ")
            elif not child.skip and child.number not in gone and (child.tag != "article" or not sums.all[part.number]):
                if child.tag in BLOCKS:
                    flush()
                way.append((child, iter(child.children)))
                break
        else:
            way.pop()
            if node.tag in BLOCKS:
                flush()
    flush()
    return "\n".join(blocks)


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", url or "")
    return m[1].lower() if m else ""


HOST = r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)"


def _host(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), HOST, 1))


def subtree_counts(pages: DataFrame, enough: int = MIN_PAGES) -> DataFrame:
    """``(host, subtree, n_pages)``: different pages with each subtree, told apart by their main parts.

    A batch names at most ``enough`` pages of each subtree: counts below ``enough`` are exact, others are ``enough`` or more.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: dict[tuple[str, int], set[int]] = {}
            for host, html in zip(pdf["host"], pdf["html"], strict=True):
                nodes = parse(html or "")
                text = main_text(nodes, set()).encode("utf-8", "surrogatepass")
                page = int.from_bytes(blake2b(text, digest_size=8).digest(), "little", signed=True)
                for subtree in {h for h, _ in subtree_hashes(nodes)}:
                    if len(named := found.setdefault((host, subtree), set())) < enough:
                        named.add(page)
            rows = [(*key, page) for key, named in found.items() for page in named]
            yield pd.DataFrame(rows, columns=["host", "subtree", "page"])

    elements = pages.select(_host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInPandas(run, "host string, subtree long, page long")
    return elements.groupBy("host", "subtree").agg(F.countDistinct("page").alias("n_pages"))


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, subtree)`` of the subtrees on at least ``min_pages`` different pages of their host."""
    return subtree_counts(pages, min_pages).where(F.col("n_pages") >= min_pages).select("host", "subtree")


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``; a column of this name is replaced."""
    templates = common.written(site_templates(pages, min_pages), "templates")
    kept = common.without(pages, "text")
    if templates.count() > broadcast_rows:
        return _extract_joined(kept, templates)
    deleted: dict[str, set[int]] = {}
    for row in templates.toLocalIterator():
        deleted.setdefault(row["host"], set()).add(row["subtree"])

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for urls, htmls in batches:
            yield pd.Series([main_text(parse(h or ""), deleted.get(host_of(u), set())) for u, h in zip(urls, htmls, strict=True)], dtype=object)

    return kept.withColumn("text", run(F.col("url").cast("string"), F.col("html").cast("string")))


def _extract_joined(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """As ``extract_text``, with the deletion set joined by host and subtree to the elements of each page."""
    row = common.free_name(pages, "page_row")
    numbered = common.written(pages.withColumn(row, F.monotonically_increasing_id()), "pages")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, host, html in zip(pdf["row"], pdf["host"], pdf["html"], strict=True):
                rows += [(page, host, h) for h in {h for h, _ in subtree_hashes(parse(html or ""))}]
            yield pd.DataFrame(rows, columns=["row", "host", "subtree"])

    elements = numbered.select(F.col(row).alias("row"), _host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInPandas(run, "row long, host string, subtree long")
    found = elements.join(templates, ["host", "subtree"]).groupBy(F.col("row").alias(row)).agg(F.collect_set("subtree").alias(f"{row}_deleted"))

    @F.pandas_udf("string")
    def cut(htmls: pd.Series, deleted: pd.Series) -> pd.Series:
        return pd.Series([main_text(parse(h or ""), set() if d is None else set(d)) for h, d in zip(htmls, deleted, strict=True)], dtype=object)

    joined = numbered.join(found, row, "left")
    return joined.withColumn("text", cut(F.col("html").cast("string"), f"{row}_deleted")).drop(row, f"{row}_deleted")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = common.read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
