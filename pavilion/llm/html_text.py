"""Main text of web pages by composite text density.

Every DOM node has a density: its characters per tag, adjusted for links (text within links counts against
it). The node with the largest sum of its children's densities is the body of the article; the smallest density
on the path from it to the body element is the threshold, and the subtree goes up along that path as far as
a parent's own children pass the threshold. Elements that are never part of an article go while the page is read. Nodes whose
class, role or tag only says header, advert, comment and the like are weighed first: one that holds the article stays, the others
are taken out, so that they neither weigh nor show.

Defined cases: a null or empty html, or one without text, gives an empty text; broken markup (open tags, no
body, stray ends) is read as far as it goes, and what is left out ends where an open tag's end is implied; rows repeat as they come; no page is cut.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import map_rows

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# Not part of an article, whatever they hold.
DROPPED_TAGS = frozenset("head nav footer aside form button select option input menu dialog svg math canvas object audio video".split()) | RAW
DOUBTFUL_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# Parts of a class or id between hyphens that tell what surrounds an article.
DOUBTFUL_WORDS = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|footer\w*|header\w*|masthead"
    r"|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscri\w*|signup|login|share|sharing|social|related|recommend\w*"
    r"|comments?|commentlist|disqus|respond|reply|replies|pager|pagination|widgets?|toolbar|skip|notices?|notification"
)
# A class that begins so says what state an element is in, not what it is; one of the second begins as an article's own header does.
STATES, OWN = frozenset("has no not with without is".split()), frozenset("entry post article content story page title".split())
# An opening tag of the first closes an open one of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody"}, "thead": {"tbody"}, "tfoot": {"tbody"},
}
# Open tags that end a paragraph in a part that is left out, and tags that a head may hold; any other ends it.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
) | CLOSES.keys()
IN_HEAD = frozenset("base basefont bgsound head html link meta".split()) | RAW
TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<(?P<other>[!?])[^>]*>?|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


class Node:
    __slots__ = ("tag", "parts", "parent", "doubtful", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag, parent, doubtful=False):
        self.tag, self.parent, self.parts, self.doubtful = tag, parent, [], doubtful


def named_so(tag: str, value: str) -> bool:
    """Whether a class or id names something beside the article. A paragraph may be called a notice, and is still one."""
    for token in value.lower().split():
        parts = re.split(r"[-_]+", token)
        if parts[0] in STATES:
            continue
        words = [p for p in parts if DOUBTFUL_WORDS.fullmatch(p)]
        if parts[0] in OWN:
            words = [w for w in words if not w.startswith("header")]
        if tag in ("p", "li", "td", "dd") or tag in INLINE:
            words = [w for w in words if not w.startswith("noti")]
        if words:
            return True
    return False


def judged(tag: str, attrs: str) -> tuple[bool, bool]:
    """(left out whatever it holds, doubtful): what a tag says of an element before its content is known."""
    if tag in DROPPED_TAGS:
        return True, False
    doubtful = tag == "header"
    if not attrs or tag in ("html", "body", "article", "main"):
        return False, doubtful
    for name, *values in ATTRIBUTE.findall(attrs):
        value = "".join(values)
        name = name.lower()
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True, False
        doubtful = doubtful or name in ("class", "id") and named_so(tag, value) or name == "role" and value.lower() in DOUBTFUL_ROLES
    hidden = re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs), re.I)
    return bool(hidden), doubtful


def parse(page: str) -> Node:
    """A tree of the tags and texts that may belong to an article. Ends are matched to the nearest open tag."""
    root = at = Node("#root", None)
    skip = 0  # open tags within a part that is left out
    skipped: list[str] = []
    position, end = 0, len(page)
    while position < end:
        found = TOKEN.search(page, position)
        start = found.start() if found else end
        if skipped == ["head"] and page[position:start].strip():
            skipped.clear()
        if start > position and not skipped:
            at.parts.append(html.unescape(page[position:start]))
        if not found:
            break
        position = found.end()
        tag = found["tag"]
        if not tag:
            continue
        tag, attrs = tag.lower(), found["attrs"] or ""
        if found["end"]:
            if skipped:
                if tag in skipped:
                    while skipped and skipped.pop() != tag:
                        pass
                    continue
                if tag in INLINE and any(t not in INLINE for t in skipped):
                    continue
                if tag not in ("body", "html") and tag not in _open_tags(at, root):
                    continue
                skipped.clear()  # the end of what holds the part that is left out
            node = at
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                # A block's end closes what is open within; an inline end reaches over no block.
                if tag in INLINE and any(n not in INLINE for n in _open_tags(at, node)):
                    continue
                at = node.parent
            continue
        closed = attrs.rstrip().endswith("/") or tag in VOID
        if tag in RAW and not closed:
            # What a raw element holds is no markup; an open one reaches to the end.
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, position)
            position = close.end() if close else end
            continue
        if skipped:
            _end_implied(skipped, at, tag)
        if skipped:
            if not closed:
                skipped.append(tag)
            continue
        out, doubtful = judged(tag, attrs)
        if not closed and out:
            at = _close_paragraph(at, tag)
            skipped.append(tag)
            continue
        if tag not in INLINE:
            at = _close_paragraph(at, tag)
        node = Node(tag, at, doubtful)
        at.parts.append(node)
        if not closed:
            at = node
    return root


def _open_tags(at: Node, until: Node):
    while at is not until:
        yield at.tag
        at = at.parent


def _end_implied(skipped: list[str], at: Node, tag: str) -> None:
    """Take what an opening tag ends from the open tags of a part that is left out; none is left where the part itself ends."""
    if tag == "body" and "head" in skipped or skipped == ["head"] and tag not in IN_HEAD:
        skipped.clear()
    ends = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_PARAGRAPH else set())
    while skipped and ends:
        open_inline = 0
        while open_inline < len(skipped) and skipped[-1 - open_inline] in INLINE:
            open_inline += 1
        if open_inline == len(skipped):
            # Inline tags alone: they end with the paragraph or item around them.
            while at.tag in INLINE:
                at = at.parent
            if at.tag in ends:
                skipped.clear()
            return
        if skipped[-1 - open_inline] not in ends:
            return
        del skipped[-1 - open_inline :]


def _close_paragraph(at: Node, tag: str) -> Node:
    """A block ends an open paragraph with the inline tags in it, an item the item before it."""
    if tag in INLINE:
        return at
    ends = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_PARAGRAPH else set())
    node = at
    while node.parent is not None and (node.tag in INLINE or node.tag in ends):
        if node.tag in ends:
            return _close_paragraph(node.parent, tag)
        node = node.parent
    return at


def weigh(root: Node) -> list[Node]:
    """Counts of characters and tags, in and out of links, and from them the densities; children come first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Node))
    order.reverse()
    for node in order:
        children = [p for p in node.parts if isinstance(p, Node)]
        own = sum(len(" ".join(p.split())) for p in node.parts if isinstance(p, str))
        node.chars = own + sum(c.chars for c in children)
        node.tags = len(children) + sum(c.tags for c in children)
        in_link = node.tag in ("a", "button", "select")
        node.link_chars = node.chars if in_link else sum(c.link_chars for c in children)
        node.link_tags = sum(c.link_tags + (c.tag in ("a", "button", "select")) for c in children)
    body = max(order[-1].chars, 1)
    link_share = order[-1].link_chars / body
    for node in order:
        node.density = composite_density(node, link_share)
        node.total = sum(p.density for p in node.parts if isinstance(p, Node))
    return order


def take_out(root: Node) -> None:
    """Removes the doubtful nodes that do not hold the article.

    One stays that holds an article or main element, or the main heading within such an element, or, where a page has no such
    element, more than half of the text outside links.
    """
    order = weigh(root)
    core = {id(n) for n in order if n.tag in ("article", "main")}
    marked, heading = set(core), {id(n) for n in order if n.tag == "h1"}
    for node in order:  # children first
        for found in (marked, heading):
            if id(node) in found and node.parent is not None:
                found.add(id(node.parent))
    plain = order[-1].chars - order[-1].link_chars
    within: set[int] = set()
    for node in reversed(order):  # parents first
        if node.parent is not None and (id(node.parent) in within or id(node.parent) in core):
            within.add(id(node))
        if not node.doubtful:
            continue
        most = not core and 2 * (node.chars - node.link_chars) > plain
        if id(node) not in marked and not (id(node) in within and id(node) in heading) and not most:
            node.parent.parts = [p for p in node.parent.parts if p is not node]


def composite_density(node: Node, link_share: float) -> float:
    """Characters per tag, times a logarithm that shrinks with links and grows with plain text."""
    if not node.chars:
        return 0.0
    chars, tags = node.chars, max(node.tags, 1)
    linked, plain = max(node.link_chars, 1), max(node.chars - node.link_chars, 1)
    link_tags = max(node.link_tags, 1)
    base = math.log(chars / plain * linked + link_share * chars + math.e)
    inner = (chars / linked) * (tags / link_tags)
    return max(chars / tags * math.log(max(inner, 1.0) + 1e-9, max(base, 1.0001)), chars / tags * 1e-6)


def best(root: Node) -> Node | None:
    """The root of the article's subtree."""
    order = weigh(root)
    top = max(reversed(order), key=lambda n: n.total, default=None)
    if top is None or not root.chars:
        return None
    if not top.total:  # text without any tag inside
        return root
    path, node = [], top
    while node is not None:
        path.append(node)
        if node.tag == "body":
            break
        node = node.parent
    threshold = min(n.density for n in path)
    # Up the path while the parent's other parts are as dense as the path allows: they belong to the article too.
    chosen = top
    for parent in path[1:]:
        if parent.tag in ("body", "html", "#root") and any(n.tag in ("article", "main") for n in path[:-1]):
            break
        others = [p for p in parent.parts if isinstance(p, Node) and p is not chosen and p.chars]
        texts = any(isinstance(p, str) and p.strip() for p in parent.parts)
        if texts or any(p.density >= threshold and p.link_chars * 2 < p.chars for p in others):
            chosen = parent
        elif parent.tag in ("article", "main"):
            chosen = parent
    return chosen


def blocks(node: Node) -> list[str]:
    """Texts of blocks in page order, white space inside turned into one space."""
    out, run, stack = [], [], [iter(node.parts)]
    nodes = [node]

    def flush():
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if nodes.pop().tag not in INLINE:
                flush()
        elif isinstance(part, str):
            run.append(part)
        else:
            if part.tag not in INLINE:
                flush()
            elif part.tag == "br":
                run.append(" ")
            stack.append(iter(part.parts))
            nodes.append(part)
    flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    take_out(root)
    chosen = best(root)
    return "\n".join(blocks(chosen)) if chosen is not None else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; map-only."""

    def factory():
        def made(page_id, url, page):
            text = main_text(page)
            return page_id, url, text, len(text)

        return made

    return map_rows(
        pages.select(F.col("page_id"), "url", "html"), factory, "page_id long, url string, text string, n_chars long"
    )
