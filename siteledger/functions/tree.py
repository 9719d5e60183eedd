"""Element tree of a page as one column expression.

A fold over the tags and texts of a page keeps the path of open elements. Each element becomes a
struct with its place in the tree when it closes; nothing leaves the row and no UDF runs. Tags are
taken in chunks, whose results are put together in the end, so that the work is linear in the page.

Closing follows the common cases of the HTML standard: void elements hold nothing, an end tag that
was left out is implied by what may not stand inside (a list item by the next one, a paragraph by a
block, a cell by the next cell or row), end tags without a start are skipped and do not reach out of a
table cell, and the end of the page closes everything. Elements that a browser would add by itself
(``html``, ``body``, ``tbody``) are not added.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from siteledger.functions.html import TAG_REST, attribute, decode_entities, has_text
from siteledger.functions.text import strip
from siteledger.functions.urls import let

#: Tags folded in one go.
CHUNK = 128

# Elements without content.
VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
)

# Elements that close an open paragraph.
BLOCKS = (
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu",
    "nav", "ol", "p", "pre", "section", "table", "ul",
)

_ROWS, _CELLS = ("tr",), ("td", "th")
_SECTIONS = ("thead", "tbody", "tfoot")

# Fixed values: (start tags, innermost open elements that they close).
IMPLIED_ENDS = (
    (("li",), ("li", "p")),
    (("dt", "dd"), ("dt", "dd", "p")),
    (("option",), ("option",)),
    (("optgroup",), ("option", "optgroup")),
    (_CELLS, (*_CELLS, "p")),
    (_ROWS, (*_CELLS, *_ROWS, "p", "caption")),
    (_SECTIONS, (*_CELLS, *_ROWS, *_SECTIONS, "p", "caption")),
    (("body",), ("head", "title")),
    (BLOCKS, ("p",)),
)

#: Elements of a table, whose end tags do reach out of a cell.
TABLE_PARTS = ("table", *_SECTIONS, *_ROWS, *_CELLS, "html", "body")

#: Position from 0 in page order, of the parent too (-1 at the top); ``nth`` among its parent's children from 1;
#: ``attrs`` is the start tag's text after the name. ``text``: has text, or an image with one; ``submit``: holds a
#: submit button; ``label``: stands inside a label; ``table``: position of the table around it, or -1.
NODE = (
    "struct<pos: int, name: string, attrs: string, parent: int, depth: int, nth: int, selector: string, "
    "children: int, text: boolean, submit: boolean, label: boolean, table: int>"
)
_FIELDS = [part.split(":")[0].strip() for part in NODE[len("struct<") : -1].split(",")]
_NAME = r"^</?([A-Za-z][A-Za-z0-9:-]*+)"
_TOKEN = rf"(?s)<[!?][^>]*+>?+|</?+[A-Za-z][A-Za-z0-9:-]*+{TAG_REST}|[^<]++|<"


def _struct(**fields: Column) -> Column:
    return F.struct(*[fields[name].alias(name) for name in _FIELDS])


def _changed(node: Column, **fields: Column) -> Column:
    return _struct(**{name: fields.get(name, node[name]) for name in _FIELDS})


def _nodes(*nodes: Column) -> Column:
    return (F.array(*nodes) if nodes else F.array()).cast(f"array<{NODE}>")


def _all_but(array: Column, last: Column) -> Column:
    return F.slice(array, 1, F.size(array) - last)


def _state(next_: Column, top: Column, stack: Column, done: Column) -> Column:
    return F.struct(next_.alias("next"), top.alias("top"), stack.alias("stack"), done.alias("done"))


_STATE = f"struct<next: int, top: int, stack: array<{NODE}>, done: array<{NODE}>>"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` for states, with ``value`` evaluated once. A fold hands a value on as it is,
    where ``let`` would copy it with all its strings."""
    return F.aggregate(F.array(value), F.lit(None).cast(_STATE), lambda _, v: body(v))


def _with_int(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, a state, for a number that is evaluated once."""
    return F.aggregate(F.array(value), F.lit(None).cast(_STATE), lambda _, v: body(v))


def _tokens(markup: Column) -> Column:
    """(kind, name, attrs) of each tag and text that is not blank; kind is ``open``, ``close`` or ``text``."""

    def read(piece: Column) -> Column:
        is_tag = piece.rlike(r"^</?[A-Za-z]")
        blank = F.when(piece.contains("&"), strip(decode_entities(piece))).otherwise(strip(piece)) == ""
        kind = (
            F.when(is_tag & piece.startswith("</"), "close")
            .when(is_tag & piece.endswith(">"), "open")
            .when(is_tag | piece.rlike("^<[!?]") | blank, "none")
            .otherwise("text")
        )
        return F.struct(
            kind.alias("kind"),
            F.lower(F.regexp_extract(piece, _NAME, 1)).alias("name"),
            F.when(is_tag, F.regexp_replace(piece, _NAME, "")).otherwise("").alias("attrs"),
        )

    pieces = F.regexp_extract_all(markup, F.lit(_TOKEN), F.lit(0))
    return F.filter(F.transform(pieces, read), lambda t: t["kind"] != "none")


def _closed(s: Column, n: Column) -> Column:
    """The state with its ``n`` innermost open elements closed; what they hold, those around them hold too."""
    popped, left = F.slice(s["stack"], F.size(s["stack"]) - n + 1, n), _all_but(s["stack"], n)

    def holds(field: str, start: Column | int) -> Column:
        return F.exists(F.slice(popped, start, n), lambda e: e[field])

    ended = F.transform(popped, lambda e, i: _changed(e, text=holds("text", i + 1), submit=holds("submit", i + 1)))
    top = F.get(s["stack"], F.size(s["stack"]) - n - 1)
    around = _changed(top, text=top["text"] | holds("text", 1), submit=top["submit"] | holds("submit", 1))
    stack = F.when(F.size(s["stack"]) == n, left).otherwise(F.concat(_all_but(left, F.lit(1)), _nodes(around)))
    return F.when(n <= 0, s).otherwise(_state(s["next"], s["top"], stack, F.concat(s["done"], ended)))


def _last(stack: Column, test) -> Column:
    """How many open elements from the inside lead to the innermost one that passes; 0 when none does."""
    return F.array_position(F.transform(F.reverse(stack), test), True).cast("int")


def _on_text(s: Column) -> Column:
    top = F.element_at(s["stack"], -1)
    marked = F.concat(_all_but(s["stack"], F.lit(1)), _nodes(_changed(top, text=F.lit(True))))
    return F.when(F.size(s["stack"]) == 0, s).otherwise(_state(s["next"], s["top"], marked, s["done"]))


def _on_close(s: Column, name: Column) -> Column:
    def found(n: Column) -> Column:
        cell = _last(s["stack"], lambda e: e["name"].isin("td", "th", "table"))
        inside = name.isin(*TABLE_PARTS) | let(cell, lambda c: (c == 0) | (n <= c))
        return F.when(n == 0, s).otherwise(F.when(inside, _closed(s, n)).otherwise(s))

    return _with_int(_last(s["stack"], lambda e: e["name"] == name), found)


def _implied(s: Column, name: Column) -> Column:
    """How many of the innermost open elements end because ``name`` starts."""

    def run(*names: str) -> Column:
        first_other = _last(s["stack"], lambda e: ~e["name"].isin(*names))
        return let(first_other, lambda k: F.when(k == 0, F.size(s["stack"])).otherwise(k - 1))

    n = F.lit(0)
    for starts, ends in reversed(IMPLIED_ENDS):
        n = F.when(name.isin(*starts), run(*ends)).otherwise(n)
    return n


def _on_open(s: Column, name: Column, attrs: Column) -> Column:
    def opened(s: Column) -> Column:
        stack, is_void = s["stack"], name.isin(*VOID)
        outer = F.get(stack, F.size(stack) - 1)
        nth = F.coalesce(outer["children"], s["top"]) + 1
        given = F.when(attrs.contains("id"), strip(attribute(attrs, "id")))
        step = F.concat(name, F.when(name.isin("html", "head", "body"), "").otherwise(F.concat(F.lit(":nth-child("), nth.cast("string"), F.lit(")"))))
        path = F.when(F.coalesce(given, F.lit("")) != "", F.concat(F.lit("#"), given)).otherwise(F.concat_ws(" > ", outer["selector"], step))
        kind = F.lower(attribute(attrs, "type"))
        submits = ((name == "input") & F.coalesce(kind.isin("submit", "image"), F.lit(False))) | (
            (name == "button") & (F.coalesce(kind, F.lit("submit")) == "submit")
        )
        node = _struct(
            pos=s["next"], name=name, attrs=attrs, parent=F.coalesce(outer["pos"], F.lit(-1)), depth=F.size(stack), nth=nth,
            selector=path, children=F.lit(0), text=(name == "img") & has_text(attrs, "alt"), submit=submits,
            label=F.coalesce(outer["label"] | (outer["name"] == "label"), F.lit(False)),
            table=F.coalesce(F.when(outer["name"] == "table", outer["pos"]).otherwise(outer["table"]), F.lit(-1)),
        )

        def pushed(node: Column) -> Column:
            counted = _changed(outer, children=outer["children"] + 1, text=outer["text"] | (is_void & node["text"]), submit=outer["submit"] | (is_void & node["submit"]))
            below = F.when(F.size(stack) == 0, stack).otherwise(F.concat(_all_but(stack, F.lit(1)), _nodes(counted)))
            return _state(
                s["next"] + 1,
                s["top"] + (F.size(stack) == 0).cast("int"),
                F.when(is_void, below).otherwise(F.concat(below, _nodes(node))),
                F.when(is_void, F.concat(s["done"], _nodes(node))).otherwise(s["done"]),
            )

        return _bind(_state(F.lit(0), F.lit(0), _nodes(), _nodes(node)), lambda v: pushed(F.get(v["done"], F.lit(0))))

    return _bind(_with_int(_implied(s, name), lambda n: _closed(s, n)), opened)


def _step(s: Column, token: Column) -> Column:
    """One token. What is done already is left aside, so that it is not carried through each expression."""
    open_ = _state(s["next"], s["top"], s["stack"], _nodes())

    def stepped(v: Column) -> Column:
        return (
            F.when(token["kind"] == "text", _on_text(v))
            .when(token["kind"] == "close", _on_close(v, token["name"]))
            .otherwise(_on_open(v, token["name"], token["attrs"]))
        )

    return _bind(_bind(open_, stepped), lambda v: _state(v["next"], v["top"], v["stack"], F.concat(s["done"], v["done"])))


def element_tree(markup: Column) -> Column:
    """Every element of ``visible_markup`` in page order, as array<struct> (``NODE``); NULL for NULL."""
    start = _state(F.lit(0), F.lit(0), _nodes(), _nodes())

    def fold(tokens: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / CHUNK).cast("int")), lambda k: F.slice(tokens, k * CHUNK + 1, CHUNK))
        empty = F.array().cast(f"array<array<{NODE}>>")
        whole = F.aggregate(
            chunks,
            F.struct(start.alias("at"), empty.alias("parts")),
            lambda s, chunk: let(
                F.aggregate(chunk, s["at"], _step),
                lambda after: F.struct(
                    _state(after["next"], after["top"], after["stack"], _nodes()).alias("at"),
                    F.concat(s["parts"], F.array(after["done"])).alias("parts"),
                ),
            ),
            lambda s: F.concat(F.flatten(s["parts"]), _closed(s["at"], F.size(s["at"]["stack"]))["done"]),
        )
        return F.when(F.size(tokens) == 0, _nodes()).otherwise(F.sort_array(whole))

    return F.when(markup.isNotNull(), let(_tokens(markup), fold))


def named(nodes: Column, names: Sequence[str] | str) -> Column:
    """The nodes with one of the names."""
    wanted = [names] if isinstance(names, str) else list(names)
    return F.filter(nodes, lambda n: n["name"].isin(*wanted))
