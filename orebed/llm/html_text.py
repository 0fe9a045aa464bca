"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, each step up worth
less, and links discount what an element gets. The element with the most points is the
container of the article; if it lies in an article or main element that one is taken. Siblings of the container, or
other articles beside its article, that hold text of the same kind are kept. Navigation, headers, footers, sidebars,
notices, adverts, forms, comments, scripts and styles go.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame

from orebed.llm.common import per_text

# Elements whose content is never article text.
_SKIPPED = frozenset(
    "script style noscript template head nav footer aside form button input select option textarea iframe object embed"
    " svg canvas audio video map menu dialog title meta link".split()
)
_RAW = frozenset("script style textarea title noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img".split()
)
_PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
# Start tags that end an open element of a kind, but not beyond the bounds.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_BOUNDS = frozenset("table td th button object body html article section div main aside nav form blockquote ul ol li".split())

#: Words of a class or id that mark what may hold the article, whatever else the name says.
_CONTENT = frozenset("article body content entry main page post site story text wrapper".split())

#: Words of a class or id that mark what is no article text.
_UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar nav navbar"
    " navigation menu breadcrumb breadcrumbs footer masthead comment comments commentlist respond reply replies disqus"
    " discussion notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription"
    " signup login share sharing social related recommended widget toolbar pagination pager skip byline-social".split()
)
_PAGE_HEADER = frozenset({"header"})
#: Words that name a picture's box or caption, whatever size or place its name adds.
_PICTURE = frozenset("caption figure image photo picture".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An element: its children are elements and strings."""

    __slots__ = ("tag", "parent", "children", "drop", "words", "points", "text", "linked", "commas", "links", "paragraph", "in_article")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.points, self.text, self.linked, self.commas, self.links = 0.0, 0, 0, 0, 0
        #: The open paragraph that a block would end, if any.
        self.paragraph = self if tag == "p" else None if parent is None or tag in _BOUNDS else parent.paragraph
        self.in_article = parent is not None and (parent.in_article or parent.tag == "article")
        self.words, self.drop = frozenset(), tag in _SKIPPED
        if attributes:
            self._read(attributes)

    def _read(self, attributes: str) -> None:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                self.words |= frozenset(_NAME.findall(_CAMEL.sub("-", value).lower()))
            elif name == "role":
                self.drop |= value.lower() in _ROLES
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                self.drop = True
            elif name == "style":
                self.drop |= "display:none" in value.replace(" ", "").lower()


def parse(source: str) -> Node:
    """The tree of a page; unclosed and stray tags are put up with, no page is refused."""
    root = node = Node("html", None)
    at, n = 0, len(source)
    no_comment_end = False
    open_tags = Counter([root.tag])

    def leave(inner: Node, outer: Node) -> None:
        while inner is not outer:
            open_tags[inner.tag] -= 1
            inner = inner.parent

    while at < n:
        start = source.find("<", at)
        if start < 0:
            start = n
        if start > at:
            node.children.append(source[at:start])
        if start == n:
            break
        if source.startswith("<!--", start) and not no_comment_end:
            end = source.find("-->", start + 4)
            no_comment_end = end < 0
            at = n if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), start):
            end = source.find(">", start)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(source, start) or _LOOSE_TAG.match(source, start)
        if not m:
            # A tag that the page's end cuts off is markup; any other sign is text.
            if re.match(r"</?[a-zA-Z]", source[start : start + 3]) and source.find(">", start) < 0:
                break
            node.children.append("<")
            at = start + 1
            continue
        at, tag = m.end(), m[2].lower()
        before = node
        if m[1]:
            node = _close(node, tag, open_tags)
            leave(before, node)
        else:
            node, child = _open(node, tag, m[3], open_tags)
            leave(before, node)
            if child is not None:
                node = child
                open_tags[tag] += 1
        if not m[1] and tag in _RAW and node.tag == tag:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            if end is None:
                break
            close = source.find(">", end.end())
            leave(node, node.parent)
            node, at = node.parent, n if close < 0 else close + 1
    return root


def _close(node: Node, tag: str, open_tags: Counter) -> Node:
    """The open element after an end tag: the parent of the nearest of its kind, if any."""
    if tag == "br":
        node.children.append(" ")
    if not open_tags[tag]:
        return node
    at = node
    while at is not None and at.tag != tag:
        if at.tag in ("td", "th", "table") and tag in ("p", "div", "span", "a", "b", "i"):
            return node
        at = at.parent
    return node if at is None or at.parent is None else at.parent


def _open(node: Node, tag: str, attributes: str, open_tags: Counter) -> tuple[Node, Node | None]:
    """The element that a start tag is in, having closed those that it ends, and the one it opens, if any."""
    if tag in ("html", "body") and node.parent is None and tag == "html":
        return node, None
    if (tag not in _INLINE and tag not in _VOID or tag == "hr") and node.paragraph is not None:
        node = node.paragraph.parent
    if tag in _ENDS:
        kinds, bounds = _ENDS[tag]
        at = node if any(open_tags[k] for k in kinds) else None
        while at is not None and at.tag not in bounds:
            if at.tag in kinds:
                node = at.parent
                if tag != "tr":
                    break
            at = at.parent
    if tag in _VOID:
        if tag in ("br", "hr"):
            node.children.append(Node(tag, node))
        return node, None
    child = Node(tag, node, attributes)
    node.children.append(child)
    return node, child if not attributes.endswith("/") or tag not in ("svg", "path") else None


def _postorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    return out[::-1]


def _mark(nodes: list[Node]) -> None:
    """Drop elements by their names and page headers, but none that holds an article, and none named as content
    that holds most of the page's paragraph text."""
    spared, holds = _most_of_text(nodes), set()
    for node in nodes:
        if node.tag in ("article", "main") and not node.words & _UNLIKELY:
            at = node.parent
            while at is not None and at not in holds:
                holds.add(at)
                at = at.parent
    within = set()  # an article or main element
    for node in nodes[::-1]:  # parents first
        if node.parent is not None and (node.parent.tag in ("article", "main") or node.parent in within):
            within.add(node)
    for node in nodes:
        unlikely = node.words & _UNLIKELY or node.words & _PAGE_HEADER and node.tag != "h1"
        if node in within and node.tag in ("figure", "figcaption") and node.words & _PICTURE:
            unlikely = False
        if unlikely and node not in holds and node not in spared and node.tag not in ("html", "body", "main"):
            node.drop = True
        if node.tag == "header" and node not in within:
            node.drop = node.drop or node not in holds and node not in spared
        if node.drop and node.tag not in _SKIPPED and node in holds:
            node.drop = False
    for node in nodes[::-1]:  # parents first
        node.drop = node.drop or node.parent is not None and node.parent.drop


def _most_of_text(nodes: list[Node]) -> set[Node]:
    """Elements named as content, among other things, with more than half of the characters of all paragraphs."""
    below: dict[Node, int] = Counter()
    total = 0
    for node in nodes:
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        inner = below[node] + (own if not node.drop else 0)
        total += own if not node.drop else 0
        if node.parent is not None and not node.drop:
            below[node.parent] += inner
        below[node] = inner
    named = [n for n in nodes if n.words & _UNLIKELY | n.words & _PAGE_HEADER and n.words & _CONTENT]
    return {n for n in named if 2 * below[n] > total and not n.drop}


def _measure(nodes: list[Node]) -> None:
    """Characters of text and of linked text below each element, and the points paragraphs pass on."""
    for node in nodes:
        if node.drop:
            node.text = node.linked = node.commas = node.links = 0
            continue
        own_block = True
        for child in node.children:
            if isinstance(child, str):
                node.text += len(child.strip())
                node.commas += child.count(",")
            else:
                node.text += child.text
                node.commas += child.commas
                node.links += child.links + (child.tag == "a" and not child.drop)
                node.linked += child.text if child.tag == "a" else child.linked
                own_block = own_block and child.tag in _INLINE | _VOID
        if node.tag in _PARAGRAPHS or node.tag in ("div", "section") and own_block:
            if node.text >= 25:
                points = 1 + node.commas + min(node.text / 100, 3)
                points *= 1 - node.linked / node.text
                at, share = node.parent, 1.0
                for _ in range(3):
                    if at is None:
                        break
                    at.points += points * share
                    at, share = at.parent, share / (2 if share == 1 else 1.5)


def _heading(node: Node) -> bool:
    """A heading, or a box that holds nothing else."""
    inner = [c for c in node.children if isinstance(c, Node) or c.strip()]
    return node.tag in ("h1", "h2", "h3") or bool(inner) and all(isinstance(c, Node) and c.tag in ("h1", "h2", "h3") for c in inner)


def _articles(nodes: list[Node], outer: Node, score) -> list[Node]:
    """An article and those beside it whose best part has a fair share of the points of its own best part."""
    if outer.parent is None or outer.tag != "article":
        return [outer]
    peak: dict[Node, float] = {}
    for node in nodes:  # children first
        peak[node] = max(peak.get(node, 0.0), 0.0 if node.drop else score(node))
        if node.parent is not None:
            peak[node.parent] = max(peak.get(node.parent, 0.0), peak[node])
    least = max(3.0, 0.2 * peak[outer])
    beside = [c for c in outer.parent.children if isinstance(c, Node) and c.tag == "article" and not c.drop]
    return [c for c in beside if c is outer or peak[c] >= least]


def _container(nodes: list[Node], root: Node) -> list[Node]:
    """The best container, or the article that it lies in, and the siblings to keep."""
    live = [n for n in nodes if not n.drop]
    score = lambda n: n.points * (1 - n.linked / n.text if n.text else 0)
    best = max(live, key=score, default=root)
    if not score(best) > 0:
        named = [n for n in live if n.tag in ("article", "main") and n.text]
        best = max(named, key=lambda n: n.text) if named else root
        return [best]
    outer, at = None, best
    while at is not None:
        if at.tag == "article" or outer is None and at.tag == "main":
            outer = at
        at = at.parent
    if outer is not None:
        return _articles(nodes, outer, score)
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    least, kept = max(3.0, 0.2 * score(best)), []
    for child in best.parent.children:
        if not isinstance(child, Node) or child.drop:
            continue
        density = child.linked / child.text if child.text else 0
        bonus = 0.2 * score(best) if child.words and child.words == best.words else 0
        paragraph = child.tag == "p" and density < 0.25
        if child is best or _heading(child) or paragraph or score(child) + bonus >= least:
            kept.append(child)
    return kept


def _menu(node: Node) -> bool:
    """A list or box that is mostly links, but no list within an article."""
    lists = node.tag in ("ul", "ol", "dl", "div", "table", "section")
    lists = lists and not (node.in_article and node.tag in ("ul", "ol", "dl"))
    return lists and node.text > 0 and node.linked > 0.6 * node.text and node.links > 1


def _blocks(kept: list[Node]) -> list[str]:
    """The text of each block in page order: character references decoded, white space as one space."""
    out, run = [], []
    whole = set(kept)

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = kept[::-1]
    while stack:
        at = stack.pop()
        if at is None:
            flush()
        elif isinstance(at, str):
            run.append(at)
        elif at.tag == "br":
            run.append("\n")
        elif at.drop or at not in whole and _menu(at):
            if at.tag not in _INLINE:
                flush()
        elif at.tag in _INLINE:
            stack += at.children[::-1]
        else:
            flush()
            stack.append(None)
            stack += at.children[::-1]
    flush()
    return out


def main_text(source: str | None) -> str:
    """The article of a page as one line: empty for a null, empty or textless page."""
    if not source:
        return ""
    root = parse(source)
    nodes = _postorder(root)
    _mark(nodes)
    _measure(nodes)
    return " ".join(_blocks(_container(nodes, root)))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, the columns to ``keep``, ``text`` and ``n_chars``.

    Null and empty pages have an empty text. Pages are read whole and on their own, so very long ones,
    repeated rows and null ids need no care; other columns are not read.
    """

    def make():
        def score(sources):
            texts = [main_text(s.decode(errors="replace") if s else None) for s in sources]
            return texts, [len(t) for t in texts]

        return score

    return per_text(pages, [id_col, *keep], html_col, ["text string", "n_chars long"], make)
