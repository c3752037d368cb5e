"""Pages as trees: the first match of a chain of selectors, and the body by layers of containers. Standard library, Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexaudit.functions.htmlx import VOID

# Containers of a page's text, the first that is there is taken; what is cut out of it; the title of pages without one.
LAYERS = ["div.read__content", "div.detail__body", "div.post-content", "article"]
CUT = {"script", "style", "iframe", "ins", "a"}
NO_TITLE = "Tanpa Judul"


class Node:
    """An element: tag, attributes, and its children, which are elements and texts."""

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self):
        """The elements below this one in document order; no recursion, as pages nest deeply."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def texts(self, cut: frozenset[str] = frozenset()) -> list[str]:
        """The stripped texts inside, but for those in elements to cut."""
        out, stack = [], [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, str):
                    if c.strip():
                        out.append(c.strip())
                elif c.tag not in cut:
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()
        return out


class _Tree(HTMLParser):
    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self._open = [self.root]
        try:
            self.feed(html)
            self.close()
        except (AssertionError, ValueError):
            pass

    def handle_starttag(self, tag, attrs) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        self._open[-1].children.append(node)
        if tag not in VOID:
            self._open.append(node)

    def handle_endtag(self, tag) -> None:
        at = next((k for k in range(len(self._open) - 1, 0, -1) if self._open[k].tag == tag), None)
        if at:
            del self._open[at:]

    def handle_data(self, data) -> None:
        self._open[-1].children.append(data)


_PART = re.compile(r"\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:([*^$]?)=[\"']?([^\"'\]]*)[\"']?)?\]")


def _simple(selector: str):
    """A test of an element for tag, .class, #id, [name], [name=value] and its *=, ^=, $= forms."""
    tag = re.match(r"^[\w-]*", selector).group()
    parts, at = [], len(tag)
    for m in _PART.finditer(selector, at):
        if m.start() != at:
            break
        parts.append(m.groups())
        at = m.end()
    if at != len(selector) or not selector:
        raise ValueError(f"not a selector: {selector!r}")

    def holds(n: Node) -> bool:
        if tag and n.tag != tag:
            return False
        for cls, ident, name, how, value in parts:
            if cls and cls not in n.attrs.get("class", "").split() or ident and n.attrs.get("id") != ident:
                return False
            if name:
                have = n.attrs.get(name)
                if have is None or value is not None and not {"": have == value, "*": value in have, "^": have.startswith(value), "$": have.endswith(value)}[how]:
                    return False
        return True

    return holds


def select_one(root: Node, selector: str) -> Node | None:
    """The first element that fits a selector: alternatives by comma, descendants by space."""
    chains = [[_simple(p) for p in one.split()] for one in selector.split(",")]

    def fits(path: list[Node], chain) -> bool:
        if not chain[-1](path[-1]):
            return False
        k = len(chain) - 2
        for n in reversed(path[:-1]):
            if k < 0:
                break
            k -= chain[k](n)
        return k < 0

    stack, path = [iter(root.children)], []
    while stack:
        for c in stack[-1]:
            if isinstance(c, Node):
                path.append(c)
                if any(fits(path, chain) for chain in chains):
                    return c
                stack.append(iter(c.children))
                break
        else:
            stack.pop()
            if path:
                path.pop()
    return None


def first_match(html: str, selectors: list[str], attr: str | None = None) -> str:
    """The text of the first selector of a chain that fits anything, or its attribute; of meta elements the content.

    A fit that is empty ends the search; faulty selectors are passed over; nothing that fits gives an empty text.
    """
    root = _Tree(html or "").root
    for s in selectors:
        try:
            n = select_one(root, s)
        except ValueError:
            continue
        if n is not None:
            name = "content" if s.startswith("meta[") else attr
            return n.attrs.get(name, "").strip() if name else "".join(n.texts())
    return ""


def layered(html: str) -> tuple[str, str]:
    """(title, text): the first heading, else a stated title; the first container of LAYERS without what is cut out of it."""
    root = _Tree(html or "").root
    h = select_one(root, "h1")
    box = next((n for n in (select_one(root, s) for s in LAYERS) if n is not None), None)
    return ("".join(h.texts()) if h is not None else NO_TITLE), (" ".join(" ".join(box.texts(frozenset(CUT))).split()) if box is not None else "")


def select_text(html: Column, selectors: list[str], attr: str | None = None) -> Column:
    """first_match() of each page; NULL is an empty page."""

    @F.pandas_udf(T.StringType())
    def f(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: first_match(p if isinstance(p, str) else "", selectors, attr))

    return f(html)


@F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType())]))
def layered_text(html: pd.Series) -> pd.DataFrame:
    """layered() of each page; NULL is an empty page."""
    return pd.DataFrame([layered(p if isinstance(p, str) else "") for p in html], columns=["title", "text"])


@F.pandas_udf(T.StringType())
def visible_text(html: pd.Series) -> pd.Series:
    """Texts of p, li, span and div elements in lower case, joined by spaces; what is nested in several stands once for each."""

    def one(page) -> str:
        root = _Tree(page if isinstance(page, str) else "").root
        return " ".join(t for n in root.walk() if n.tag in ("p", "li", "span", "div") for t in n.texts()).lower()

    return html.map(one)


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_scripts(html: pd.Series) -> pd.Series:
    """What stands in script elements of the type application/json, in order."""
    tree = lambda p: _Tree(p if isinstance(p, str) else "").root
    return html.map(lambda p: ["".join(c for c in n.children if isinstance(c, str)) for n in tree(p).walk() if n.tag == "script" and n.attrs.get("type") == "application/json"])
