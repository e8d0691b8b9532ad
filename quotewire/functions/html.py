"""HTML text to an array of nodes, and lookups in that array.

The parser is the only Python here: it lists the nodes of a page in document
order. Finding rows, cells and links is then done with array functions.
"""

import re
from collections.abc import Callable
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewire.functions.common import let
from quotewire.functions.text import squeeze

TEXT = "#text"
Test = Callable[[Column], Column]

# tag, attributes, text (text nodes only), position, position of the last descendant
NODES = T.ArrayType(
    T.StructType(
        [
            T.StructField("tag", T.StringType()),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("text", T.StringType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("last", T.IntegerType()),
        ]
    )
)

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

# A comment, a declaration, a script or style with its content, or a tag. Quotes matter only
# as the first character of an attribute's value. What the page cuts short reaches to its
# end, so no character is looked at again for each tag that does not close.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)
    | <[!?][^>]*+(?:>|\Z)
    | <(?P<raw>script|style)\b[^>]*+(?:>.*?(?:</(?P=raw)\b[^>]*+(?:>|\Z)|\Z)|\Z)
    | <(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)
        (?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)*+)(?P<closed>>?)""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
_ATTR = re.compile(r"""([^\s>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")


class _NodeTable:
    """Nodes of pages, gathered column by column as Arrow wants them."""

    def __init__(self) -> None:
        self.tag: list[str] = []
        self.text: list[str | None] = []
        self.pos: list[int] = []
        self.last: list[int] = []
        self.keys: list[str] = []
        self.values: list[str] = []
        self.attr_ends = [0]
        self.page_ends = [0]

    def add_node(self, tag: str, attrs: dict[str, str], text: str | None, pos: int) -> None:
        self.tag.append(tag)
        self.text.append(text)
        self.pos.append(pos)
        self.last.append(pos)
        self.keys += attrs.keys()
        self.values += attrs.values()
        self.attr_ends.append(len(self.keys))

    def add_page(self, html: str) -> None:
        base, done = len(self.tag), 0
        open_tags: list[tuple[str, int]] = []  # with the place of the node

        def close(tag: str) -> None:
            if any(tag == t for t, _ in open_tags):
                ended, last = None, len(self.tag) - 1 - base
                while ended != tag:
                    ended, place = open_tags.pop()
                    self.last[place] = last

        def add_text(end: int) -> None:
            if end > done:
                self.add_node(TEXT, {}, unescape(html[done:end]), len(self.tag) - base)

        for match in _MARKUP.finditer(html):
            add_text(match.start())
            done = match.end()
            if not match["closed"]:  # no tag, or one that the page's end cuts off
                continue
            tag = match["tag"].lower()
            if match["end"]:
                close(tag)
                continue
            if tag == "p":  # a new paragraph ends an unclosed one
                close("p")
            attrs = {
                name.lower(): unescape(a or b or c) for name, a, b, c in _ATTR.findall(match["attrs"])
            }
            self.add_node(tag, attrs, None, len(self.tag) - base)
            if tag not in _VOID and not match["attrs"].endswith("/"):
                open_tags.append((tag, len(self.tag) - 1))
        add_text(len(html))
        for _, place in open_tags:
            self.last[place] = len(self.tag) - 1 - base

    def end_page(self) -> None:
        self.page_ends.append(len(self.tag))

    def array(self) -> pa.Array:
        attrs = pa.MapArray.from_arrays(
            pa.array(self.attr_ends, pa.int32()),
            pa.array(self.keys, pa.string()), pa.array(self.values, pa.string()),
        )
        nodes = pa.StructArray.from_arrays(
            [
                pa.array(self.tag, pa.string()), attrs, pa.array(self.text, pa.string()),
                pa.array(self.pos, pa.int32()), pa.array(self.last, pa.int32()),
            ],
            names=["tag", "attrs", "text", "pos", "last"],
        )
        return pa.ListArray.from_arrays(pa.array(self.page_ends, pa.int32()), nodes)


def _list_nodes(pages: pa.Array) -> pa.Array:
    table = _NodeTable()
    for html in pages.to_pylist():
        if html:
            table.add_page(html)
        table.end_page()
    return table.array()


def html_nodes(html: Column) -> Column:
    """Nodes of a page in document order; NULL gives none."""
    return F.arrow_udf(_list_nodes, NODES)(html)


def has_class(node: Column, part: str) -> Column:
    """Whether the class attribute contains ``part``."""
    return F.coalesce(node["attrs"]["class"].contains(part), F.lit(False))


def has_attr(node: Column, name: str, value: str | None = None) -> Column:
    found = node["attrs"][name]
    return found.isNotNull() if value is None else F.coalesce(found == value, F.lit(False))


def first(nodes: Column, test: Test) -> Column:
    """First node that passes ``test``, or NULL."""
    return F.try_element_at(F.filter(nodes, test), F.lit(1))


def subtree(nodes: Column, node: Column) -> Column:
    """Descendants of ``node`` within ``nodes``, itself a whole page or a subtree.

    Both arguments must be columns or lambda variables, see :func:`let`.
    """
    start = F.try_element_at(nodes, F.lit(1))["pos"]
    return F.slice(nodes, node["pos"] - start + 2, node["last"] - node["pos"])


def descend(nodes: Column, test: Test) -> Column:
    """Descendants of the first node that passes ``test``, or NULL."""
    return let(nodes, lambda ns: let(first(ns, test), lambda node: subtree(ns, node)))


def each(nodes: Column, test: Test, use: Callable[[Column], Column]) -> Column:
    """``use(descendants)`` for every node that passes ``test``."""
    return let(
        nodes, lambda ns: F.transform(F.filter(ns, test), lambda node: use(subtree(ns, node)))
    )


def text_of(nodes: Column) -> Column:
    """Clean text of a list of nodes; NULL stays NULL."""
    texts = F.transform(F.filter(nodes, lambda n: n["tag"] == TEXT), lambda n: n["text"])
    return squeeze(F.array_join(texts, ""))
