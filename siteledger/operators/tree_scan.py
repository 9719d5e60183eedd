"""Static accessibility rules over the element tree, with the path of every element.

``scan.scan_pages`` reads tags where they stand in the text and is several times cheaper; this scan also knows
what stands inside what: a field inside a label, a fieldset's legend, the table of a cell, a heading
without any text in it. Issues carry a selector that finds the element. The output has the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from siteledger import schemas
from siteledger.functions.html import attribute, has_attribute, has_text, visible_markup
from siteledger.functions.text import strip
from siteledger.functions.tree import NODE, element_tree, named
from siteledger.functions.urls import let
from siteledger.operators.explode import with_fields
from siteledger.operators.scan import ERROR, RULES, TYPE_CODES, UNLABELLED_INPUTS, WARNING, document_title

_GUIDELINE = "WCAG2A.Principle{}.Guideline{}_{}.{}_{}_{}."
_MESSAGES = {rule.code: rule.message for rule in RULES}

Nodes = Callable[[Column], Column]


@dataclass(frozen=True)
class TreeRule:
    """``find`` gives, from the nodes of a page, those that break the rule. ``tags`` are the elements it looks
    at; a page without any of them skips it. None runs it on every page."""

    code: str
    message: str
    find: Nodes
    tags: tuple[str, ...] | None
    type: str = ERROR


def _where(tags: Sequence[str], test: Nodes) -> Nodes:
    return lambda nodes: F.filter(nodes, lambda n: n["name"].isin(*tags) & test(n))


def _page(test: Nodes, name: str) -> Nodes:
    """A rule about the page: the first node ``name``, or one that stands for it where there is none."""
    fields = [part.split(":")[0].strip() for part in NODE[len("struct<") : -1].split(",")]

    def find(nodes: Column) -> Column:
        absent = F.struct(*[(F.lit(name) if f in ("name", "selector") else F.lit(">") if f == "attrs" else F.lit(None)).alias(f) for f in fields]).cast(NODE)
        first = F.slice(named(nodes, name), 1, 1)
        return F.when(test(nodes), F.when(F.exists(nodes, lambda n: n["name"] == name), first).otherwise(F.array(absent))).otherwise(
            F.array().cast(f"array<{NODE}>")
        )

    return find


def _exists(nodes: Column, test: Nodes) -> Column:
    return F.coalesce(F.exists(nodes, test), F.lit(False))


def _no_lang(nodes: Column) -> Column:
    return ~_exists(nodes, lambda n: (n["name"] == "html") & (has_text(n["attrs"], "lang") | has_text(n["attrs"], "xml:lang")))


def _names_itself(attrs: Column) -> Column:
    return has_text(attrs, "aria-label") | has_text(attrs, "aria-labelledby") | has_text(attrs, "title")


def _silent_link(n: Column) -> Column:
    return ~n["text"] & has_attribute(n["attrs"], "href") & ~_names_itself(n["attrs"])


def _unlabelled(nodes: Column) -> Column:
    targets = F.transform(named(nodes, "label"), lambda n: attribute(n["attrs"], "for"))

    def find(targets: Column) -> Column:
        def nameless(n: Column) -> Column:
            kind = F.lower(F.coalesce(attribute(n["attrs"], "type"), F.lit("text")))
            needs = (n["name"] != "input") | ~kind.isin(*UNLABELLED_INPUTS)
            pointed = F.coalesce(F.array_contains(targets, attribute(n["attrs"], "id")), F.lit(False))
            return needs & ~n["label"] & ~_names_itself(n["attrs"]) & ~pointed

        return _where(("input", "select", "textarea"), nameless)(nodes)

    return let(targets, find)


def _repeated_ids(nodes: Column) -> Column:
    """Every node whose id an earlier one has."""
    given = F.transform(
        F.filter(nodes, lambda n: n["attrs"].contains("id") | n["attrs"].contains("ID")),
        lambda n: F.struct(attribute(n["attrs"], "id").alias("id"), n["pos"].alias("pos"), n.alias("node")),
    )
    ordered = F.sort_array(F.filter(given, lambda g: F.coalesce(g["id"], F.lit("")) != ""))
    return let(
        ordered,
        lambda found: F.transform(
            F.filter(found, lambda g, i: (i > 0) & (g["id"] == F.get(found, F.greatest(i - 1, F.lit(0)))["id"])), lambda g: g["node"]
        ),
    )


def _timed(n: Column) -> Column:
    delay = F.regexp_extract(attribute(n["attrs"], "content"), r"^\s*([0-9]+)", 1)
    refreshes = F.lower(strip(attribute(n["attrs"], "http-equiv"))) == "refresh"
    return F.coalesce(refreshes & delay.rlike("[1-9]"), F.lit(False))


def _no_legend(nodes: Column) -> Column:
    """Fieldsets with no legend as a child; one set difference, whatever their number."""
    sets = F.transform(named(nodes, "fieldset"), lambda n: n["pos"])
    with_legend = F.transform(F.filter(nodes, lambda n: (n["name"] == "legend") & n["text"]), lambda n: n["parent"])
    return let(F.array_except(sets, with_legend), lambda bare: F.filter(nodes, lambda n: (n["name"] == "fieldset") & F.array_contains(bare, n["pos"])))


def _wrong_headers(nodes: Column) -> Column:
    """Cells whose ``headers`` name an id that no header or data cell of their table has."""

    def key(n: Column, name: Column) -> Column:
        return F.concat_ws(" ", n["table"].cast("string"), name)

    def asked(n: Column) -> Column:
        names = F.filter(F.split(F.coalesce(attribute(n["attrs"], "headers"), F.lit("")), r"\s+"), lambda h: h != "")
        return F.transform(names, lambda h: key(n, h))

    cells = F.filter(named(nodes, ("td", "th")), lambda n: n["attrs"].contains("=") & (n["table"] >= 0))
    with_headers = F.filter(cells, lambda n: has_attribute(n["attrs"], "headers"))

    def find(found: Column) -> Column:
        ids = F.transform(F.filter(cells, lambda n: has_text(n["attrs"], "id")), lambda n: key(n, attribute(n["attrs"], "id")))
        wanted = F.flatten(F.transform(found, asked))
        return let(F.array_except(wanted, ids), lambda missing: F.filter(found, lambda n: (F.size(missing) > 0) & F.arrays_overlap(asked(n), missing)))

    return let(with_headers, lambda found: F.when(F.size(found) > 0, find(found)).otherwise(found))


def _code(*parts: int, technique: str) -> str:
    """Rule codes in the naming public WCAG checkers use: principle, guideline, criterion, technique."""
    a, b, c = parts
    return _GUIDELINE.format(a, a, b, a, b, c) + technique


def _known(code: str, find: Nodes, tags: tuple[str, ...] | None, type: str = ERROR) -> TreeRule:
    return TreeRule(code, _MESSAGES[code], find, tags, type)


TREE_RULES: tuple[TreeRule, ...] = (
    _known(_code(3, 1, 1, technique="H57.2"), _page(_no_lang, "html"), None),
    _known(_code(2, 4, 2, technique="H25.1.NoTitleEl"), _page(lambda nodes: ~_exists(nodes, lambda n: n["name"] == "title"), "html"), None),
    _known(_code(2, 4, 2, technique="H25.1.EmptyTitle"), lambda nodes: F.filter(F.slice(named(nodes, "title"), 1, 1), lambda n: ~n["text"]), ("title",)),
    _known(_code(1, 1, 1, technique="H37"), _where(("img",), lambda n: ~has_attribute(n["attrs"], "alt")), ("img",)),
    _known(_code(4, 1, 2, technique="H91.A.NoContent"), _where(("a",), _silent_link), ("a",)),
    _known(_code(2, 4, 1, technique="H64.1"), _where(("iframe",), lambda n: ~has_text(n["attrs"], "title")), ("iframe",)),
    _known(_code(1, 3, 1, technique="H44"), _unlabelled, ("input", "select", "textarea")),
    _known(_code(4, 1, 1, technique="F77"), _repeated_ids, None),
    _known(_code(2, 2, 1, technique="F41.2"), _where(("meta",), _timed), ("meta",)),
    _known(_code(3, 2, 2, technique="H32.2"), _where(("form",), lambda n: ~n["submit"]), ("form",)),
    TreeRule(_code(1, 3, 1, technique="H71.NoLegend"), "The fieldset has no legend that says what its fields have in common.", _no_legend, ("fieldset",)),
    TreeRule(_code(1, 3, 1, technique="H43.IncorrectAttr"), "The cell's headers attribute names a cell that its table does not have.", _wrong_headers, ("td", "th")),
    TreeRule(_code(1, 3, 1, technique="H42.2"), "The heading has no content.", _where(tuple(f"h{k}" for k in range(1, 7)), lambda n: ~n["text"]), tuple(f"h{k}" for k in range(1, 7))),
    _known(_code(1, 3, 1, technique="H49.B"), lambda nodes: named(nodes, "b"), ("b",), WARNING),
    _known(_code(1, 3, 1, technique="H49.I"), lambda nodes: named(nodes, "i"), ("i",), WARNING),
    _known(_code(1, 3, 1, technique="H49.Font"), lambda nodes: named(nodes, "font"), ("font",), WARNING),
)


def _issues(rule: TreeRule, nodes: Column, names: Column) -> Column:
    issue = F.transform(
        rule.find(nodes),
        lambda n: F.struct(
            F.lit(rule.code).alias("code"),
            F.lit(rule.type).alias("type"),
            F.lit(TYPE_CODES[rule.type]).alias("typeCode"),
            F.lit(rule.message).alias("message"),
            F.concat(F.lit("<"), n["name"], n["attrs"]).alias("context"),
            n["selector"].alias("selector"),
        ),
    )
    if rule.tags is None:
        return issue
    return F.when(F.arrays_overlap(names, F.array(*map(F.lit, rule.tags))), issue).otherwise(
        F.array().cast(schemas.SCAN_RESULT["issues"].dataType)
    )


def scan_trees(
    pages: DataFrame,
    html: str = "html",
    rules: Sequence[TreeRule] = TREE_RULES,
    include_warnings: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``document_title`` and ``issues``, each issue with the selector of its element.

    A page is read once, in its row, and its tree is shared by all rules. Issues come rule by rule, in page
    order within a rule. Pages without source get NULL for both columns. Only errors are listed unless
    ``include_warnings``. ``keep`` names the columns to carry, by default all but the page source.
    """
    keep = [c for c in pages.columns if c != html] if keep is None else list(keep)
    active = [r for r in rules if include_warnings or r.type == ERROR]
    # each step behind a generator: read once, whatever is asked of it later
    read = pages.select(*[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)], visible_markup(F.col(f"`{html}`")).alias("_doc"))
    trees = with_fields(read, {"_title": document_title(F.col("_doc")), "_nodes": element_tree(F.col("_doc"))})
    names = F.array_distinct(F.transform("_nodes", lambda n: n["name"]))
    found = F.concat(*[_issues(r, F.col("_nodes"), F.col("_names")) for r in active]) if active else F.array().cast(schemas.SCAN_RESULT["issues"].dataType)
    ready = trees.withColumn("_names", names)
    return with_fields(ready, {"_issues": F.when(F.col("_nodes").isNotNull(), found)}).select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], F.col("_title").alias("document_title"), F.col("_issues").alias("issues")
    )
