"""A forgiving HTML tree on the standard library's tokenizer, with the CSS selectors that the portals need.

Selectors: tag, ``.class``, ``#id``, ``[a]``, ``[a='v']`` with ``*= ^= $= ~=``, compounds, descendants, commas.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
#: Elements that an opening tag of the same group ends (fixed values of HTML).
CLOSES = {"li": {"li"}, "p": {"p"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BARRIERS = frozenset("ul ol table div section article body html dl select".split())
BLOCKS = frozenset("p div section article ul ol table tr h1 h2 h3 h4 h5 h6 header footer main nav form aside".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Node | str] = []

    def get(self, name: str) -> str | None:
        return self.attrs.get(name)

    def walk(self) -> Iterator[Node]:
        """The elements below this one in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in SILENT:
                stack.extend(reversed(x.children))

    def text(self) -> str:
        """The stripped pieces of text below, joined by spaces."""
        return " ".join(s for s in (x.strip() for x in self.strings()) if s)

    def select(self, selector: str) -> list[Node]:
        groups = compiled(selector)
        return [n for n in self.walk() if any(_matches(n, g) for g in groups)]

    def first(self, selector: str) -> Node | None:
        groups = compiled(selector)
        return next((n for n in self.walk() if any(_matches(n, g) for g in groups)), None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends = CLOSES.get(tag)
        if ends:
            node = self.at
            while node.parent is not None and node.tag not in BARRIERS:
                if node.tag in ends:
                    self.at = node.parent
                    break
                node = node.parent
        elif tag in BLOCKS and self.at.tag == "p":
            self.at = self.at.parent or self.at
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.parent is not None:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"""\s*(?:(?P<tag>[a-zA-Z][\w-]*|\*)|\.(?P<class>[\w-]+)|\#(?P<id>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~]?=)\s*(?:"(?P<v1>[^"]*)"|'(?P<v2>[^']*)'|(?P<v3>[^\]\s]+))\s*)?\])""")


@lru_cache(maxsize=512)
def compiled(selector: str) -> tuple:
    """Comma groups of descendant chains of compounds of (kind, name, op, value)."""
    groups = []
    for part in re.split(r",(?![^\[]*\])", selector):
        chain = []
        for compound in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", part.strip()):
            tests, at = [], 0
            while at < len(compound):
                m = _SIMPLE.match(compound, at)
                if not m:
                    raise ValueError(f"selector {selector!r}")
                kind = next(k for k in ("tag", "class", "id", "attr") if m[k])
                tests.append((kind, m[kind], m["op"], next((m[v] for v in ("v1", "v2", "v3") if m[v] is not None), None)))
                at = m.end()
            chain.append(tuple(tests))
        groups.append(tuple(chain))
    return tuple(groups)


def _passes(node: Node, tests: tuple) -> bool:
    for kind, name, op, value in tests:
        if kind == "tag":
            ok = name == "*" or node.tag == name.lower()
        elif kind == "class":
            ok = name in (node.get("class") or "").split()
        elif kind == "id":
            ok = node.get("id") == name
        else:
            own = node.get(name.lower())
            ok = own is not None and (op is None or (op == "=" and own == value) or bool(value) and ((op == "*=" and value in own) or (op == "^=" and own.startswith(value)) or (op == "$=" and own.endswith(value)) or (op == "~=" and value in own.split())))
        if not ok:
            return False
    return True


def _matches(node: Node, chain: tuple) -> bool:
    if not _passes(node, chain[-1]):
        return False
    left = list(chain[:-1])
    for up in node.ancestors():
        if not left:
            return True
        if _passes(up, left[-1]):
            left.pop()
    return not left


def _wrapped(node: Node, text: str) -> str:
    """The Markdown of a node from that of what is in it."""
    if node.tag == "a" and node.get("href"):
        return f"[{text.strip()}]({node.get('href')})"
    if node.tag in ("b", "strong"):
        return f"**{text.strip()}**"
    if re.fullmatch("h[1-6]", node.tag):
        return f"\n\n{'#' * int(node.tag[1])} {text.strip()}\n\n"
    if node.tag == "li":
        return f"\n* {text.strip()}\n"
    return f"\n\n{text.strip()}\n\n" if node.tag in BLOCKS else text


def markdown(html: str) -> str:
    """Headings, paragraphs, list items, links and emphasis as Markdown; images, scripts and styles are left out. Tags may
    be nested to any depth."""
    root = parse(html)
    open_: list[tuple[Node, Iterator, list[str]]] = [(root, iter(root.children), [])]
    while True:
        node, rest, out = open_[-1]
        for x in rest:
            if isinstance(x, str):
                out.append(re.sub(r"\s+", " ", x))
            elif x.tag == "br":
                out.append("\n")
            elif x.tag not in SILENT and x.tag not in ("img", "noscript"):
                open_.append((x, iter(x.children), []))
                break
        else:
            open_.pop()
            if not open_:
                return re.sub(r"\n\s*\n+", "\n\n", "".join(out)).strip()
            open_[-1][2].append(_wrapped(node, "".join(out)))
