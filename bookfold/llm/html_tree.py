"""HTML pages as trees of elements and text blocks, with indicator features for each node.

Any text parses: markup declarations other than comments end at the next ``>``, and a comment, declaration or tag that the
page leaves open takes the rest of the page, as in browsers. Left out are only the elements that are no text of the page
(scripts, styles, head, frames) and the values of form controls; formulas, drawings and embedded objects are inline text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

#: The classes of HTML elements by what they do to text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr label "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded mphantom merror menclose msub msup msubsup munder mover munderover mmultiscripts semantics "
    "annotation annotation-xml svg g text tspan textpath object map audio video canvas picture".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template iframe select option textarea datalist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("form fieldset legend input select textarea button label".split())
NAVIGATION = frozenset("nav menu header footer aside dialog".split())
#: Elements that a new start tag of the same group closes, up to the nearest container of that group.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
CONTAINERS = {"p": ("div", "article", "section", "body", "td", "li", "blockquote"), "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead"), "td": ("tr", "table"), "th": ("tr", "table")}
#: Words of class, id and role attributes that tell of page furniture, and of articles.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus feedback "
    "footer form gdpr header hidden legal links login masthead menu menus meta modal nav navbar navigation newsletter notice notices outbrain overlay pagination pager popup promo promoted "
    "promotion recommended related replies reply respond rss search share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored subscribe subscription taboola tags toc "
    "toolbar tracking widget widgets".split()
)
ARTICLE = frozenset("article articlebody body content entry hentry main post story text".split())
_OPEN_MARKUP = re.compile(r"<[A-Za-z/!?]")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@dataclass
class Node:
    """An element, or (``text`` not None) a block of text below one."""

    parent: int
    tag: str
    names: frozenset[str] = frozenset()
    text: str | None = None
    n_chars: int = 0
    n_link_chars: int = 0
    n_stops: int = 0
    hidden: bool = False
    marks: list[str] = field(default_factory=list)


class _Builder(HTMLParser):
    """Builds the node list in document order, parents first. Inline elements are not nodes; their text joins the block's."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node(-1, "#root")]
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.open: Counter[str] = Counter()
        self.unseen = 0
        self.links = 0
        self.piece: list[str] = []
        self.piece_links = 0

    def flush(self) -> None:
        if self.piece:
            text = " ".join("".join(self.piece).split())
            if text:
                owner = self.stack_block()
                self.nodes.append(Node(owner, "#text", text=text, n_chars=len(text), n_link_chars=min(self.piece_links, len(text)), n_stops=sum(map(text.count, ".,;:!?"))))
            self.piece, self.piece_links = [], 0

    def stack_block(self) -> int:
        return self.stack[-1][1]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag in ("br", "wbr") and self.unseen == 0:
                self.piece.append("\n" if tag == "br" else "")
            return
        if tag in INLINE:
            if tag == "a":
                self.links += 1
            self._push(tag, self.stack[-1][1])
            return
        if tag in UNSEEN:
            # No node, and no end of the block around it.
            self._push(tag, self.stack[-1][1])
            self.unseen += 1
            return
        self.flush()
        if tag in CLOSES:
            self._close_open(CLOSES[tag], CONTAINERS[tag])
        elif self.open["p"]:
            self._close_open(("p",), CONTAINERS["p"])
        names: set[str] = set()
        hidden = False
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop") and value:
                names.update(w.lower() for w in _WORD.findall(value))
            hidden |= name == "hidden" or (name == "style" and bool(value) and "display:none" in value.replace(" ", "").lower())
        self.nodes.append(Node(self.stack_block(), tag, frozenset(names), hidden=hidden))
        self._push(tag, len(self.nodes) - 1)

    def _push(self, tag: str, node: int) -> None:
        self.stack.append((tag, node))
        self.open[tag] += 1

    def _close_open(self, tags: tuple[str, ...], containers: tuple[str, ...]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth][0]
            if tag in tags:
                self._pop_to(depth)
                return
            if tag in containers:
                return

    def _pop_to(self, depth: int) -> None:
        for tag, _ in self.stack[depth:]:
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"
            self.open[tag] -= 1
        del self.stack[depth:]

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or not self.open[tag]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == tag:
                if any(t not in INLINE and t not in UNSEEN for t, _ in self.stack[depth:]):
                    self.flush()
                self._pop_to(depth)
                return

    def handle_data(self, data: str) -> None:
        if self.unseen == 0:
            self.piece.append(data)
            if self.links:
                self.piece_links += len(data)

    def parse_html_declaration(self, i: int) -> int:
        """Comments as the library reads them; text in ``<![CDATA[`` of a formula or drawing; any other declaration is
        nothing up to the next ``>``. -1: not ended."""
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        if self.rawdata.startswith("<![CDATA[", i) and (self.open["math"] or self.open["svg"]):
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                self.handle_data(self.rawdata[i + 9 : end])
            return end + 3 if end >= 0 else -1
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def finish(self) -> None:
        """Text that the library held back at the end of the page is text, an open tag, comment or declaration is not."""
        if not _OPEN_MARKUP.match(self.rawdata):
            self.close()
        self.flush()


def parse_page(html: str | None) -> list[Node]:
    """Nodes of a page in document order, parents before children; the root alone for null or empty pages."""
    builder = _Builder()
    if html:
        builder.feed(html)
        builder.finish()
    nodes = builder.nodes
    for i in range(len(nodes) - 1, 0, -1):
        node, parent = nodes[i], nodes[nodes[i].parent]
        parent.n_chars += node.n_chars
        parent.n_link_chars += node.n_link_chars
        parent.n_stops += node.n_stops
    return nodes


def _step(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= s for s in steps)


def node_features(node: Node) -> list[str]:
    """Names of the node's indicator features."""
    share = node.n_link_chars / node.n_chars if node.n_chars else 0.0
    marks = ["text" if node.text is not None else "element", f"links{_step(share, (0.05, 0.3, 0.7))}"]
    if node.text is not None:
        marks.append(f"chars{_step(node.n_chars, (25, 240))}")
        marks.append(f"stops{_step(node.n_stops, (1, 2))}")
    tag = node.tag
    if tag in HEADINGS:
        marks.append("tag:heading")
    elif tag in CONTROLS:
        marks.append("tag:control")
    elif tag in NAVIGATION:
        marks.append("tag:navigation")
    elif tag in ("article", "main"):
        marks.append("tag:article")
    elif tag in ("p", "blockquote", "pre"):
        marks.append("tag:paragraph")
    elif tag in ("ul", "ol", "li", "dl", "dt", "dd"):
        marks.append("tag:list")
    elif tag in ("html", "body", "#root"):
        marks.append("tag:page")
    if node.names & FURNITURE:
        marks.append("name:furniture")
    elif node.names & ARTICLE:
        marks.append("name:article")
    if node.hidden:
        marks.append("hidden")
    return marks
