"""From HTML to a tree of block elements with their text blocks, in one pass."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import xxhash

# Elements deeper than this count as part of the one at this depth.
MAX_DEPTH = 64

# Element groups as HTML defines them, at most MAX_DEPTH of them inside one another.
SKIPPED = {
    "button", "canvas", "iframe", "noscript", "object", "script", "select", "style", "svg",
    "template", "textarea", "title",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog",
    "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# An open element on the left ends when one on the right starts inside its container.
ENDED_BY = {
    "dd": {"dd", "dt"},
    "dt": {"dd", "dt"},
    "li": {"li"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "head": {"body"},
}
CONTAINERS = {"article", "body", "div", "dl", "menu", "ol", "section", "table", "ul"}
# A choice of this module: the markup and the names that are taken as evidence of furniture.
ARTICLE_TAGS = {"article", "main"}
FURNITURE_TAGS = {"aside", "dialog", "footer", "form", "head", "menu", "nav"}
FURNITURE_ROLES = {
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar",
    "navigation", "search", "toolbar",
}
FURNITURE_WORDS = {
    "ad", "adbox", "ads", "adslot", "adsense", "advert", "advertisement", "advertising", "adverts", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus",
    "footer", "form", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notices", "notification", "pager", "pagination", "popup", "promo", "promoted", "related",
    "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
# Inside a line only these are taken out: other words name parts of a sentence there.
ADVERT_WORDS = {
    "ad", "adbox", "ads", "adslot", "adsense", "advert", "advertisement", "advertising", "adverts", "promo",
    "promoted", "sponsor", "sponsored",
}
HEADER_WORDS = {"container", "global", "header", "main", "page", "site", "top", "wrap", "wrapper"}

_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?])")
_REST = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""\shidden(?=[\s/>=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Names that say what a layout has or lacks, not what the element is.
_MODIFIER = re.compile(r"(?<!\S)(?:has|no|with|without)[-_]\S*", re.IGNORECASE)
_DIGITS = re.compile(r"\d{3,}")  # numbers of single posts, not of kinds of boxes


def _hash(parent: int, key: str) -> int:
    return xxhash.xxh64_intdigest(key, parent) & (2**63 - 1)


@dataclass
class Node:
    """One element path of a page; elements with the same path are merged."""

    path: int
    above: tuple[int, ...]
    protected: bool
    styles: Counter = field(default_factory=Counter)
    texts: Counter = field(default_factory=Counter)
    share: float = 0.0
    times: int = 0


@dataclass
class _Open:
    tag: str
    node: Node
    furniture: bool
    article: bool
    block: bool
    worded: int = -1  # the branch that only a class or id names as furniture
    children: list[int] = field(default_factory=list)


@dataclass
class Page:
    """``blocks``: (path, furniture, text) in page order; ``nodes``: by path."""

    blocks: list[tuple[int, bool, str]]
    nodes: dict[int, Node]


def _is_furniture(tag: str, words: set[str], role: str, in_article: bool) -> bool:
    if tag in FURNITURE_TAGS or role in FURNITURE_ROLES:
        return tag not in ARTICLE_TAGS and tag not in ("html", "body")
    is_header = tag == "header" or ("header" in words and words <= HEADER_WORDS)
    return is_header and not in_article


def _is_worded(tag: str, words: set[str]) -> bool:
    named = words & (FURNITURE_WORDS if tag in BLOCKS else ADVERT_WORDS)
    return bool(named) and tag not in ARTICLE_TAGS and tag not in ("html", "body")


class _Builder:
    def __init__(self):
        root = Node(_hash(0, "#page"), (), False)
        self.nodes = {root.path: root}
        self.stack = [_Open("#page", root, False, False, True)]
        self.blocks: list[tuple[int, bool, str]] = []
        self.branches: list[int] = []  # of each block
        self.worded = 0
        self.held: set[int] = set()  # articles in such branches
        self.inside: set[int] = set()  # such branches in articles
        self.plain = False  # an article outside them
        self.pieces: list[str] = []

    def flush(self) -> None:
        if not self.pieces:
            return
        text = "".join(self.pieces)
        self.pieces = []
        if "&" in text:
            text = html.unescape(text)
        text = " ".join(text.split())
        if not text:
            return
        top = self.stack[-1]
        self.blocks.append((top.node.path, top.furniture, text))
        self.branches.append(top.worded)
        top.node.texts[xxhash.xxh64_intdigest(text) & (2**63 - 1)] += 1
        top.children.append(0)

    def open(self, tag: str, attributes: str) -> None:
        found = {}
        for name, *values in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), next((v for v in values if v), ""))
        top = self.stack[-1]
        names = f"{found.get('class', '')} {found.get('id', '')}"
        words = {w.lower() for w in _WORD.findall(_MODIFIER.sub("", names))} if names != " " else set()
        furniture = _is_furniture(tag, words, found.get("role", "").lower(), top.article)
        furniture = furniture or (bool(attributes) and bool(_HIDDEN.search(attributes)))
        block = tag in BLOCKS
        worded = _is_worded(tag, words)
        if not block and not furniture and not worded:
            return
        if block:
            self.end_implied(tag)
            top = self.stack[-1]
        self.flush()
        is_article = tag in ARTICLE_TAGS or found.get("role", "").lower() in ("main", "article")
        article = top.article or is_article
        # Inside a line an advert always goes; other branches are judged when the page is read.
        furniture = furniture or (worded and not block)
        branch = top.worded
        if is_article and not top.article and branch < 0:
            self.plain = self.plain or not (furniture or top.furniture)
        elif (is_article and not top.article) or (worded and block and branch < 0):
            branch, self.worded = self.worded, self.worded + 1
            if is_article:
                self.held.add(branch)
            elif top.article:
                self.inside.add(branch)
        if len(self.stack) > MAX_DEPTH:
            node = top.node
        else:
            key = f"{tag}.{'.'.join(sorted(_DIGITS.sub('', found.get('class', '')).split()))}"
            path = _hash(top.node.path, key)
            top.children.append(path)
            node = self.nodes.get(path)
            if node is None:
                node = self.nodes[path] = Node(path, (*top.node.above, top.node.path), article)
        self.stack.append(_Open(tag, node, furniture or top.furniture, article, block, branch))

    def end_implied(self, tag: str) -> None:
        """Close the elements that the start of ``tag`` ends."""
        for depth in range(len(self.stack) - 1, 0, -1):
            element = self.stack[depth]
            if element.tag == "p" or tag in ENDED_BY.get(element.tag, ()):
                self.close_to(depth)
                if element.tag == "p" and tag not in ("dd", "dt", "li", "td", "th", "tr", "body"):
                    return
            elif element.tag in CONTAINERS:
                return

    def close(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                self.close_to(depth)
                return

    def close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.flush()
            self._done(self.stack.pop())

    def _done(self, element: _Open) -> None:
        """Count the element's presentation: the order of its children (0: a text block)."""
        node, children = element.node, element.children
        node.styles[xxhash.xxh64_intdigest(repr(children)) & (2**63 - 1)] += 1
        node.times += 1
        for child, n in Counter(children).items():
            if child:
                self.nodes[child].share += n / len(children)

    def finish(self) -> Page:
        self.close_to(0)
        # A class or id does not take away most of a page's text, nor its only articles.
        sizes = Counter()
        for (_, furniture, text), branch in zip(self.blocks, self.branches, strict=True):
            sizes[branch] += 0 if furniture else len(text)
        whole = sum(sizes.values())
        # An article outside such branches is the text, however long its comments are.
        most = {b for b, n in sizes.items() if 2 * n > whole}
        kept = {-1} | (most & self.inside if self.plain else most | self.held)
        blocks = [
            (path, furniture or branch not in kept, text)
            for (path, furniture, text), branch in zip(self.blocks, self.branches, strict=True)
        ]
        return Page(blocks, self.nodes)


def parse(text: str) -> Page:
    """Read a page.  Any text is accepted: unclosed and stray tags are mended."""
    builder, at, lower = _Builder(), 0, None
    while True:
        tag = _TAG.search(text, at)
        if tag is None:
            builder.pieces.append(text[at:])
            return builder.finish()
        if tag.start() > at:
            builder.pieces.append(text[at : tag.start()])
        closing, name = tag.group(1), tag.group(2)
        if name is None:
            end = "-->" if tag.group() == "<!--" else ">"
            stop = text.find(end, tag.end())
            at = len(text) if stop < 0 else stop + len(end)
            continue
        rest = _REST.match(text, tag.end())
        if rest is None:
            # A quote is never closed: the tag ends at the next sign that can end it.
            stop = text.find(">", tag.end())
            if stop < 0:
                at = len(text)
                continue
            at = stop + 1
        else:
            at = rest.end()
        name = name.lower()
        if closing:
            if name in BLOCKS:
                builder.flush()
            builder.close(name)
        elif name == "br":
            builder.pieces.append(" ")
        elif name in SKIPPED:
            lower = text.lower() if lower is None else lower
            stop = lower.find(f"</{name}", at) if len(lower) == len(text) else _find(text, name, at)
            if stop >= 0:
                at = stop
            elif name in ("script", "style"):
                at = len(text)
        elif name in VOID:
            if name == "hr":
                builder.flush()
        else:
            builder.open(name, text[tag.end() : at - 1])


def _find(text: str, name: str, at: int) -> int:
    found = re.compile(f"</{name}", re.IGNORECASE).search(text, at)
    return found.start() if found else -1
