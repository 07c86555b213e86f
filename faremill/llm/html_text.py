"""Main text of web pages by tree scoring.

Paragraphs earn points for their length and commas and pass them to their ancestors, less with every level. A
container's points are discounted by its link density. The best container is kept, with the siblings that look like
parts of the same article; navigation, adverts, forms, comments and the like are left out wherever they stand.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.store import with_text_batches

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"<]*\"|'[^'<]*'|[^>\"'<])*+(?=>)|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMES = re.compile(r"[a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
#: Start tags that end an open paragraph.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul li dd dt tr td th tbody thead tfoot body".split()
)
#: Elements that an own start tag, or one of their group, ends.
SIBLINGS = {
    **dict.fromkeys(("li",), ("li",)),
    **dict.fromkeys(("dt", "dd"), ("dt", "dd")),
    **dict.fromkeys(("td", "th"), ("td", "th")),
    **dict.fromkeys(("tr",), ("tr", "td", "th")),
    **dict.fromkeys(("option",), ("option",)),
}
#: The elements in which the search for such an open element stops.
SCOPES = frozenset("ul ol dl table tbody thead tfoot select body html div article section main".split())

DROPPED = frozenset(
    "head script style noscript iframe template textarea title nav footer aside form button select input svg canvas object "
    "embed audio video menu dialog fieldset datalist map".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
#: Words of class and id that mark what is no part of an article.
UNLIKELY = frozenset(
    "ad ads adsbox advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promotions banner "
    "breadcrumb breadcrumbs comment comments commentlist disqus respond replies reply cookie cookies consent gdpr notice "
    "notices alert popup modal overlay footer foot header masthead menu nav navbar navigation pager pagination related "
    "recommended sidebar side share sharing social subscribe subscription newsletter signup login toolbar widget widgets "
    "skip legal copyright disclaimer".split()
)
#: Those of them that also name a layout around the text, as in "has-sidebar".
LAYOUT = frozenset("footer foot header masthead menu nav navbar navigation sidebar side toolbar widget widgets".split())
#: Words that speak for an element: they add points, but make up for no word above.
LIKELY = frozenset("article body content entry main post story text page".split())
LIKELY_POINTS = 5.0
KEPT_ALWAYS = frozenset(("html", "body", "article", "main", "#page"))

#: Points that a container begins with.
TAG_POINTS = {
    **dict.fromkeys(("article", "main"), 10.0),
    **dict.fromkeys(("div", "section"), 5.0),
    **dict.fromkeys(("pre", "td", "blockquote"), 3.0),
    **dict.fromkeys(("address", "ol", "ul", "dl", "dd", "dt", "li"), -3.0),
    **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "th"), -5.0),
}
PARAGRAPHS = frozenset(("p", "pre", "td", "blockquote", "dd", "li"))
LEAST_CHARS, CHARS_PER_POINT, MOST_LENGTH_POINTS = 25, 100, 3
SIBLING_SHARE, SIBLING_POINTS = 0.2, 10.0
#: Elements beside the best container that are kept with it unless links make up this share of them.
OWN_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 pre blockquote figure table".split())
MOST_LINKS = 0.25
#: A container among what no name speaks against, with this share of the points of the best one of all, is kept.
CLEAN_SHARE = 0.2


class Node:
    """An element: what stands in it in order (texts and nodes), and what its paragraphs have passed to it.

    ``suspect``: its names speak against it; it is dropped too, unless it holds the best container.
    """

    __slots__ = (
        "tag", "parent", "content", "dropped", "suspect", "in_article", "names",
        "points", "passed", "chars", "link_chars", "commas", "blocks",
    )

    def __init__(self, tag: str, parent: Node | None, dropped: bool, suspect: bool = False, names: str = ""):
        self.tag, self.parent, self.dropped, self.suspect, self.names = tag, parent, dropped, suspect, names
        self.in_article = tag == "article" or parent is not None and parent.in_article
        self.content: list = []
        self.points: float | None = None
        self.passed = 0.0
        self.chars = self.link_chars = self.commas = 0
        self.blocks = False


def _verdict(tag: str, attributes: str, parent: Node) -> tuple[bool, bool, str]:
    """Whether an element, and all that stands in it, is surely, and probably, no part of an article; its class and id."""
    if tag in KEPT_ALWAYS:
        return False, False, ""
    if tag in DROPPED or tag == "header" and not parent.in_article:
        return True, False, ""
    if not attributes.strip():
        return False, False, ""
    given = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    gone = (
        "hidden" in given
        or given.get("aria-hidden") == "true"
        or given.get("role") in DROPPED_ROLES
        or "display:none" in given.get("style", "").replace(" ", "")
    )
    names = f"{given.get('class', '')} {given.get('id', '')}"
    against = UNLIKELY.intersection(_NAMES.findall(names))
    return gone or not against <= LAYOUT, bool(against), names


def parse(page: str) -> Node:
    """The element tree, with the end tags that HTML lets authors leave out."""
    root = node = Node("#page", None, False)
    at = 0
    # A tag that begins before the last ">" ends; behind it only a comment may begin. So no search runs in vain.
    tagged = page.rfind(">") + 1
    last_comment = page.find("<!--", tagged)
    page = page if last_comment < 0 else page[:last_comment]
    open_tags: Counter[str] = Counter()
    while True:
        found = _TOKEN.search(page, at, tagged)
        text = page[at : found.start()] if found else page[at:]
        if text:
            node.content.append(html.unescape(text) if "&" in text else text)
        if not found:
            return root
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            if open_tags[tag]:
                while node.tag != tag:
                    open_tags[node.tag] -= 1
                    node = node.parent
                open_tags[tag] -= 1
                node = node.parent
            elif tag == "p":
                node.content.append(Node("p", node, False))
            continue
        if tag in CLOSES_P and open_tags["p"]:
            up = node
            while up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                node = _closed(node, up, open_tags)
        if tag in SIBLINGS and any(open_tags[t] for t in SIBLINGS[tag]):
            up = node
            while up.parent is not None and up.tag not in SIBLINGS[tag] and up.tag not in SCOPES:
                up = up.parent
            while up.tag in SIBLINGS[tag]:
                up = node = _closed(node, up, open_tags)
        if node.dropped:
            child = Node(tag, node, True)
        else:
            child = Node(tag, node, *_verdict(tag, found[3] or "", node))
        node.content.append(child)
        if tag in RAW:
            raw_end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if raw_end is None:  # it takes the rest of the page
                return root
            at = raw_end.end()
        elif tag not in VOID:
            node = child
            open_tags[tag] += 1


def _closed(node: Node, last: Node, open_tags: Counter[str]) -> Node:
    """The parent of ``last``, which ends with all that is open in it."""
    while True:
        open_tags[node.tag] -= 1
        if node is last:
            return node.parent
        node = node.parent


def _walk(root: Node, spared: frozenset[Node] | None) -> list[Node]:
    """All elements that are not dropped, parents first; of the suspect ones those that are ``spared`` (None: all)."""
    found, open_nodes = [], [root]
    while open_nodes:
        node = open_nodes.pop()
        found.append(node)
        for part in reversed(node.content):
            if isinstance(part, Node) and not part.dropped and (not part.suspect or spared is None or part in spared):
                open_nodes.append(part)
    return found


def _measure(nodes: list[Node]) -> None:
    """Characters, characters in links and commas below every element of a walk."""
    for node in nodes:
        node.chars = node.link_chars = node.commas = 0
        node.blocks = False
    for node in reversed(nodes):
        for part in node.content:
            if isinstance(part, str):
                node.chars += len(part.strip())
                node.commas += part.count(",") + part.count("，") + part.count("、")
        if node.tag == "a":
            node.link_chars = node.chars
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.commas += node.commas
            up.blocks |= node.blocks or node.tag not in INLINE and node.tag not in VOID


def _density(node: Node) -> float:
    return node.link_chars / node.chars if node.chars else 0.0


def _best(nodes: list[Node]) -> Node | None:
    """The container with the most points; of equal ones the first of the page.

    A paragraph's points go to the element it stands in, half of them to the next one up, and so on: one sum from the
    leaves upwards, whatever the depth.
    """
    for node in nodes:
        node.points, node.passed = None, 0.0
    for node in reversed(nodes):
        paragraph = node.tag in PARAGRAPHS or node.tag in ("div", "section", "article", "main", "body") and not node.blocks
        if paragraph and node.chars >= LEAST_CHARS and not (node.blocks and node.tag in ("td", "li", "dd")):
            own = 1 + node.commas + min(node.chars / CHARS_PER_POINT, MOST_LENGTH_POINTS)
            if node.tag in PARAGRAPHS:
                if node.parent is not None:
                    node.parent.passed += own
            else:
                node.passed += own
        if node.passed and node.tag != "#page":
            likely = LIKELY_POINTS if not LIKELY.isdisjoint(_NAMES.findall(node.names)) else 0.0
            node.points = (TAG_POINTS.get(node.tag, 0.0) + likely + node.passed) * (1 - _density(node))
            if node.parent is not None:
                node.parent.passed += node.passed / 2
    return max((n for n in nodes if n.points is not None), key=lambda n: n.points, default=None)


def _alike(part: Node, best: Node) -> bool:
    """Whether an element beside the best container is a part of the same text: of its kind, and not made of links."""
    return part.tag == best.tag and part.tag in ("div", "section") and part.names.split() == best.names.split()


def _chosen(nodes: list[Node], best: Node | None) -> list[Node]:
    if best is None:
        return [next((n for n in nodes if n.tag in ("article", "main")), next((n for n in nodes if n.tag == "body"), nodes[0]))]
    up = best
    while up is not None:  # a part of a marked article stands for all of it
        if up.tag in ("article", "main"):
            best = up
            break
        up = up.parent
    if best.parent is None or best.tag == "body":
        return [best]
    seen = set(nodes)
    least = max(SIBLING_POINTS, SIBLING_SHARE * best.points) if best.points is not None else SIBLING_POINTS
    kept = []
    for part in best.parent.content:
        if not isinstance(part, Node) or part not in seen:
            continue
        density = _density(part)
        if part is best or part.points is not None and part.points >= least:
            kept.append(part)
        elif part.chars and density < MOST_LINKS and (part.tag in OWN_BLOCKS or _alike(part, best)):
            kept.append(part)
        elif part.tag == "p" and part.chars:
            if part.chars > 80 and density < MOST_LINKS or density == 0 and _text([part], seen).endswith((".", "!", "?")):
                kept.append(part)
    return kept


def _text(nodes: list[Node], seen: set[Node]) -> str:
    """The texts below the elements, as far as they are ``seen``, blocks set apart, every run of white space one space."""
    pieces: list[str] = []
    work: list = list(reversed(nodes))
    while work:
        part = work.pop()
        if isinstance(part, str):
            pieces.append(part)
        elif part in seen:
            if part.tag in INLINE:
                work.extend(reversed(part.content))
            else:
                work.append(" ")
                work.extend(reversed(part.content))
                work.append(" ")
    return " ".join("".join(pieces).split())


def main_text(page: str | None) -> str:
    """The main text of one page; empty for a null or empty page."""
    if not page:
        return ""
    root = parse(page)
    everything = _walk(root, None)
    best_of_all = None
    if any(node.suspect for node in everything):
        _measure(everything)
        best_of_all = _best(everything)
        most = best_of_all.points if best_of_all is not None else 0.0
    nodes = _walk(root, frozenset())
    _measure(nodes)
    best = _best(nodes)
    marked = any(node.chars and node.tag in ("article", "main") for node in nodes)
    if best_of_all is not None and not marked and (best is None or best.points < CLEAN_SHARE * most):
        # The text stands in an element that names speak against: that one stays, and what holds it.
        holders, up = set(), best_of_all
        while up is not None:
            holders.add(up)
            up = up.parent
        nodes = _walk(root, frozenset(holders))
        _measure(nodes)
        best = _best(nodes)
    return _text(_chosen(nodes, best), set(nodes))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block is one space, and blocks are joined by one. A null
    or empty page, and one without text, gives an empty text. Broken markup is read as far as it can be: an unclosed
    element ends with its parent, an unclosed comment, script or style with the page. Repeated rows are extracted each;
    other columns are ignored.
    """

    def work(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    found = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    found = with_text_batches(found).mapInArrow(work, "page_id long, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
