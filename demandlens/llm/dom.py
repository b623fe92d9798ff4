"""A lenient DOM of block elements and the text blocks in them."""

from __future__ import annotations

import html as entities
import re

#: Elements that do not begin a new text block (fixed by the HTML standard).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements without content, and elements whose text is never page text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style noscript noframes template iframe object svg math canvas title textarea select "
    "audio video".split()
)
#: Tags that make no block: what a head holds is unseen or without content, and
#: text or a block in a head whose end is left out belongs to the page.
SKIPPED = frozenset("head basefont bgsound".split())
#: Start tags that end an unseen element whose own end never comes.
BREAKS = frozenset(
    "article section main p h1 h2 h3 h4 h5 h6 div blockquote pre ul ol dl table".split()
)
#: Elements that a start tag of the same group closes.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = frozenset("html body div article section main table ul ol dl td th form aside".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|noscript|noframes|iframe|template)\b"
    r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_UNENDED = re.compile(r"<[!?/]")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """A block element, or with tag ``#text`` a block of text."""

    __slots__ = ("tag", "names", "parent", "text", "link_chars", "own_chars", "links", "blocks")

    def __init__(self, tag: str, names: tuple[str, ...], parent: int):
        self.tag, self.names, self.parent = tag, names, parent
        self.text = ""
        self.link_chars = self.own_chars = self.links = self.blocks = 0


def _names(rest: str) -> tuple[str, ...]:
    """Words of the class, id and role attributes."""
    words: dict[str, None] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = _CAMEL.sub(" ", m[2] or m[3] or m[4] or "")
        words.update(dict.fromkeys(_TOKEN.findall(value.lower())))
    return tuple(words)


def _unended(tokens: list[re.Match]) -> set[int]:
    """Where unseen elements start whose end tags never come."""
    open_at: dict[str, list[int]] = {}
    for m in tokens:
        tag = (m["tag"] or "").lower()
        if tag in UNSEEN:
            if m["end"]:
                if open_at.get(tag):
                    open_at[tag].pop()
            elif not m["rest"].endswith("/"):
                open_at.setdefault(tag, []).append(m.start())
    return {at for own in open_at.values() for at in own}


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents before children; the first is the root.
    White space in a text block is one blank; empty blocks are left out."""
    nodes = [Node("html", (), -1)]
    stack = [("html", 0)]  # open elements and their block node
    opened: dict[str, int] = {}  # how many of each are open, but for the root
    hidden: str | None = None
    depth_hidden = in_link = 0
    lost: set[int] | None = None
    inner: dict[str, int] = {}  # elements opened in the hidden one
    breaks: frozenset[str] = frozenset()
    pieces: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked, links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                leaf = Node("#text", (), stack[-1][1])
                leaf.text, leaf.own_chars = text, len(text)
                leaf.link_chars, leaf.links = min(linked, len(text)), links
                nodes.append(leaf)
            pieces.clear()
            linked = links = 0

    def take(raw: str) -> None:
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if in_link:
            linked += len(text)

    def close(k: int) -> None:
        """Ends the open elements from the k-th on."""
        for t, _ in stack[k:]:
            opened[t] -= 1
        del stack[k:]

    at = 0
    # behind the last ">" there is no whole tag, so none is looked for there;
    # what is open at that place, or begins behind it, may last to the end
    end = page.rfind(">") + 1
    tokens = list(_MARKUP.finditer(page, 0, end))
    if tokens and tokens[-1].end() == end:
        tokens[-1] = _MARKUP.match(page, tokens[-1].start())
        end = tokens[-1].end()
    if last := _UNENDED.search(page, end):
        tokens.append(_MARKUP.match(page, last.start()))
    for m in tokens:
        if m.start() > at and hidden is None:
            take(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if hidden is not None:
            if tag == hidden:
                if not m["rest"].endswith("/"):
                    depth_hidden += -1 if m["end"] else 1
                    if not depth_hidden:
                        hidden = None
                continue
            if m["end"]:
                if inner.get(tag):
                    inner[tag] -= 1
                    continue
                if tag in INLINE or not opened.get(tag):
                    continue
            elif tag != "body" and tag not in breaks:
                if tag not in VOID and not m["rest"].endswith("/"):
                    inner[tag] = inner.get(tag, 0) + 1
                continue
            hidden = None  # an enclosing block ends, or its own end never comes
        if m["end"]:
            if tag == "a":
                in_link = 0
            if tag in INLINE or not opened.get(tag):
                if tag == "p":
                    flush()
                continue
            flush()
            k = len(stack) - 1
            while stack[k][0] != tag:
                k -= 1
            close(k)
            continue
        if tag in UNSEEN:
            if not m["rest"].endswith("/"):
                flush()
                hidden, depth_hidden, inner = tag, 1, {}
                lost = _unended(tokens) if lost is None else lost
                breaks = BREAKS if m.start() in lost else frozenset()
            continue
        if tag in SKIPPED:
            flush()
            continue
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                in_link = 1
                links += 1
            continue
        flush()
        in_link = 0
        closes = CLOSES.get(tag, frozenset())
        while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in closes):
            close(len(stack) - 1)
        if any(opened.get(t) for t in closes) and tag not in ("tr", "td", "th"):
            for k in range(len(stack) - 1, 0, -1):  # an open sibling below other blocks
                if stack[k][0] in closes:
                    close(k)
                    break
                if stack[k][0] in _SCOPE:
                    break
        if tag == "html" or tag == "body" and opened.get(tag):
            continue
        if tag in VOID:
            continue
        nodes.append(Node(tag, _names(m["rest"]), stack[-1][1]))
        stack.append((tag, len(nodes) - 1))
        opened[tag] = opened.get(tag, 0) + 1
    if at < len(page) and hidden is None:
        rest = page[at:]
        cut = rest.rfind("<")  # a tag that the end of the page cuts off
        take(rest[:cut] if cut >= 0 and re.match(r"</?[a-zA-Z!]", rest[cut:]) else rest)
    flush()
    for node in reversed(nodes):  # totals of the subtrees
        if node.parent >= 0:
            up = nodes[node.parent]
            up.own_chars += node.own_chars
            up.link_chars += node.link_chars
            up.links += node.links
            up.blocks += node.blocks + (node.tag == "#text")
    return nodes
