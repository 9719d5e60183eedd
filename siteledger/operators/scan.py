"""Static accessibility rules over page source, and scan records.

Each rule is a column expression giving array<issue>, so a whole scan is one projection over
the pages: no join, no shuffle, no UDF. The rules follow published WCAG 2 techniques; rules
that need computed style, such as contrast, are out of reach of a static scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from siteledger import schemas
from siteledger.functions.html import (
    TAG_REST,
    all_start_tags,
    attribute,
    decode_entities,
    elements,
    first_start_tag,
    has_attribute,
    has_text,
    start_tags,
    text_of,
    visible_markup,
)
from siteledger.functions.text import strip
from siteledger.functions.urls import let, page_key
from siteledger.operators.dedupe import latest_per_key
from siteledger.operators.explode import explode_kept, with_fields

ERROR, WARNING = "error", "warning"

# The numeric codes of issue types.
TYPE_CODES = {ERROR: 1, WARNING: 2}


@dataclass(frozen=True)
class Rule:
    """``find`` gives, from the markup, the context text of every element that breaks the rule.

    ``tags`` names the elements the rule looks at; pages without any of them skip it. None
    runs the rule on every page.
    """

    code: str
    message: str
    element: str
    find: Callable[[Column], Column]
    tags: tuple[str, ...] | None = None
    type: str = ERROR


def _tag(name: str, attrs: Column) -> Column:
    return F.concat(F.lit(f"<{name}"), attrs)


def _tags_where(name: str, test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda doc: F.transform(
        F.filter(start_tags(doc, name), test), lambda attrs: _tag(name, attrs)
    )


def _one_if(test: Column, context: Column) -> Column:
    return F.when(test, F.array(context)).otherwise(F.array().cast("array<string>"))


def _no_lang(doc: Column) -> Column:
    return let(
        first_start_tag(doc, "html"),
        lambda attrs: _one_if(
            ~has_text(attrs, "lang") & ~has_text(attrs, "xml:lang"),
            F.when(attrs == "", "<html>").otherwise(_tag("html", attrs)),
        ),
    )


_TITLE = r"(?is)<title(?=[\s/>])[^>]*+>?+(.*?)(?:</title\s*>|\z)"


def document_title(markup: Column) -> Column:
    """Text of the page's title, '' when it has none."""
    return strip(decode_entities(F.regexp_extract(markup, _TITLE, 1)))


def _no_title(doc: Column) -> Column:
    return _one_if(~doc.rlike(r"(?i)<title[\s/>]"), F.lit("<html>"))


def _empty_title(doc: Column) -> Column:
    return _one_if(
        doc.rlike(r"(?i)<title[\s/>]") & (document_title(doc) == ""), F.lit("<title>")
    )


def _open_tag_of(element: Column) -> Column:
    return F.regexp_extract(element, f"^(<[A-Za-z]+{TAG_REST})", 1)


def _attrs_of(element: Column) -> Column:
    return F.regexp_extract(element, f"^<[A-Za-z]+{TAG_REST}", 1)


def _empty_links(doc: Column) -> Column:
    def silent(link: Column) -> Column:
        alts = F.filter(start_tags(link, "img"), lambda img: ~~has_text(img, "alt"))
        return (
            (strip(decode_entities(text_of(link))) == "")
            & let(
                _attrs_of(link),
                lambda attrs: has_attribute(attrs, "href")
                & ~has_text(attrs, "aria-label")
                & ~has_text(attrs, "aria-labelledby")
                & ~has_text(attrs, "title"),
            )
            & (F.size(alts) == 0)
        )

    return F.transform(F.filter(elements(doc, "a"), silent), _open_tag_of)


# Kinds of input that need no label.
UNLABELLED_INPUTS = ("hidden", "submit", "reset", "button", "image")


def _unlabelled_fields(doc: Column) -> Column:
    parts = F.struct(
        F.transform(start_tags(doc, "label"), lambda a: attribute(a, "for")).alias("targets"),
        # A field inside a label element is labelled by it.
        F.regexp_replace(doc, r"(?is)<label(?=[\s>]).*?(?:</label\s*>|\z)", "").alias("outside"),
    )

    def find(p: Column) -> Column:
        def unnamed(attrs: Column) -> Column:
            return (
                ~has_text(attrs, "aria-label")
                & ~has_text(attrs, "aria-labelledby")
                & ~has_text(attrs, "title")
                & ~F.coalesce(
                    F.array_contains(p["targets"], attribute(attrs, "id")), F.lit(False)
                )
            )

        def visible_input(attrs: Column) -> Column:
            kind = F.lower(F.coalesce(attribute(attrs, "type"), F.lit("text")))
            return ~kind.isin(*UNLABELLED_INPUTS) & unnamed(attrs)

        return F.concat(
            _tags_where("input", visible_input)(p["outside"]),
            _tags_where("select", unnamed)(p["outside"]),
            _tags_where("textarea", unnamed)(p["outside"]),
        )

    return let(parts, find)


def _duplicate_ids(doc: Column) -> Column:
    tags = all_start_tags(doc)
    candidates = F.filter(tags, lambda attrs: attrs.rlike(r"(?i)\sid\s*="))
    ids = F.array_sort(
        F.filter(
            F.transform(candidates, lambda attrs: attribute(attrs, "id")),
            lambda i: i.isNotNull() & (i != ""),
        )
    )
    # Sorted, every repeat stands next to the one before it.
    repeats = let(
        ids,
        lambda found: F.zip_with(
            F.slice(found, 2, F.size(found)),
            found,
            lambda later, earlier: F.when(later == earlier, later),
        ),
    )
    return F.transform(
        F.filter(repeats, lambda i: i.isNotNull()),
        lambda i: F.concat(F.lit('id="'), i, F.lit('"')),
    )


def _timed_refresh(doc: Column) -> Column:
    def timed(attrs: Column) -> Column:
        delay = F.regexp_extract(attribute(attrs, "content"), r"^\s*([0-9]+)", 1)
        return (
            (F.lower(strip(attribute(attrs, "http-equiv"))) == "refresh")
            & delay.rlike("[1-9]")
        )

    return _tags_where("meta", timed)(doc)


def _form_without_submit(doc: Column) -> Column:
    def no_submit(form: Column) -> Column:
        submits = F.filter(
            start_tags(form, "input"),
            lambda a: F.lower(attribute(a, "type")).isin("submit", "image"),
        )
        buttons = F.filter(
            start_tags(form, "button"),
            lambda a: F.lower(F.coalesce(attribute(a, "type"), F.lit("submit"))) == "submit",
        )
        return (F.size(submits) == 0) & (F.size(buttons) == 0)

    return F.transform(F.filter(elements(doc, "form"), no_submit), _open_tag_of)


def _all_tags(name: str) -> Callable[[Column], Column]:
    return lambda doc: F.transform(start_tags(doc, name), lambda attrs: _tag(name, attrs))


# Rule codes in the naming public WCAG checkers use, by technique.
RULES: tuple[Rule, ...] = (
    Rule("WCAG2A.Principle3.Guideline3_1.3_1_1.H57.2",
         "The html element should have a lang attribute that names the language of the page.",
         "html", _no_lang),
    Rule("WCAG2A.Principle2.Guideline2_4.2_4_2.H25.1.NoTitleEl",
         "The page should have a title element in its head.", "head", _no_title),
    Rule("WCAG2A.Principle2.Guideline2_4.2_4_2.H25.1.EmptyTitle",
         "The title element should not be empty.", "title", _empty_title, ("title",)),
    Rule("WCAG2A.Principle1.Guideline1_1.1_1_1.H37",
         "The img element should have an alt attribute.", "img",
         _tags_where("img", lambda a: ~has_attribute(a, "alt")), ("img",)),
    Rule("WCAG2A.Principle4.Guideline4_1.4_1_2.H91.A.NoContent",
         "The link has an address but no text.", "a", _empty_links, ("a",)),
    Rule("WCAG2A.Principle2.Guideline2_4.2_4_1.H64.1",
         "The iframe element should have a title that says what it holds.", "iframe",
         _tags_where("iframe", lambda a: ~has_text(a, "title")), ("iframe",)),
    Rule("WCAG2A.Principle1.Guideline1_3.1_3_1.H44",
         "The form field has no label.", "input", _unlabelled_fields,
         ("input", "select", "textarea")),
    Rule("WCAG2A.Principle4.Guideline4_1.4_1_1.F77",
         "The id is used by more than one element of the page.", "", _duplicate_ids),
    Rule("WCAG2A.Principle2.Guideline2_2.2_2_1.F41.2",
         "The page reloads or redirects after a time limit.", "meta", _timed_refresh, ("meta",)),
    Rule("WCAG2A.Principle3.Guideline3_2.3_2_2.H32.2",
         "The form has no submit button.", "form", _form_without_submit, ("form",)),
    Rule("WCAG2A.Principle1.Guideline1_3.1_3_1.H49.B",
         "Emphasis should be marked by meaning, not by a b element.", "b", _all_tags("b"),
         ("b",), WARNING),
    Rule("WCAG2A.Principle1.Guideline1_3.1_3_1.H49.I",
         "Emphasis should be marked by meaning, not by an i element.", "i", _all_tags("i"),
         ("i",), WARNING),
    Rule("WCAG2A.Principle1.Guideline1_3.1_3_1.H49.Font",
         "Text should not be styled by a font element.", "font", _all_tags("font"),
         ("font",), WARNING),
)


def _issues(rule: Rule, doc: Column, lowered: Column) -> Column:
    issue = F.transform(
        rule.find(doc),
        lambda context: F.struct(
            F.lit(rule.code).alias("code"),
            F.lit(rule.type).alias("type"),
            F.lit(TYPE_CODES[rule.type]).alias("typeCode"),
            F.lit(rule.message).alias("message"),
            context.alias("context"),
            F.lit(rule.element).alias("selector"),
        ),
    )
    if rule.tags is None:
        return issue
    present = F.lit(False)
    for tag in rule.tags:
        present = present | lowered.contains(f"<{tag}")
    return F.when(present, issue).otherwise(
        F.array().cast(schemas.SCAN_RESULT["issues"].dataType)
    )


def scan_pages(
    pages: DataFrame,
    html: str = "html",
    rules: Sequence[Rule] = RULES,
    include_warnings: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``document_title`` and ``issues``; pages without source get NULL for both.

    Only errors are listed unless ``include_warnings``. ``keep`` names the columns to carry,
    by default all but the page source.
    """
    keep = [c for c in pages.columns if c != html] if keep is None else list(keep)
    active = [r for r in rules if include_warnings or r.type == ERROR]
    source = F.col(f"`{html}`")
    read = pages.select(
        *[F.col(f"`{c}`") for c in keep], visible_markup(source).alias("_doc")
    ).withColumn("_low", F.lower("_doc"))
    doc, lowered = F.col("_doc"), F.col("_low")
    found = F.concat(*[_issues(r, doc, lowered) for r in active])
    return with_fields(
        read,
        {
            "document_title": document_title(doc),
            "issues": F.when(doc.isNotNull(), found),
        },
    ).drop("_doc", "_low")


def explode_issues(scanned: DataFrame) -> DataFrame:
    """Long form: one row per issue."""
    rest = [c for c in scanned.columns if c not in ("issues", "document_title")]
    return explode_kept(scanned, rest, F.col("issues"), "_issue").select(*rest, "_issue.*")


def scan_records(
    inventory: DataFrame,
    scanned: DataFrame,
    as_of: Column,
    url: str = "url",
    failures: bool = False,
    fetched_at: str | None = None,
) -> DataFrame:
    """A2: one record per inventory site whose page was scanned.

    Sites and pages meet under ``page_key``. A page scanned several times counts once: the
    newest by ``fetched_at``, or else the last in the order of its columns.
    F17: sites without a result leave no record; ``failures`` returns those sites instead.
    """
    order = [fetched_at] if fetched_at else []
    results = latest_per_key(
        scanned.filter("issues IS NOT NULL").select(
            page_key(F.col(f"`{url}`")).alias("_page"), "document_title", "issues", *order
        ),
        ["_page"],
        order,
    ).drop(*order)
    inventory = inventory.withColumn("_page", page_key(F.col("routeable_url")))
    if failures:
        return inventory.join(results.select("_page"), "_page", "left_anti").drop("_page")
    return inventory.join(results, "_page").select(
        F.col("Agency").alias("agency"),
        F.col("Organization").alias("organization"),
        "domain",
        F.coalesce("subdomain", F.lit("")).alias("subdomain"),
        F.size("issues").alias("number_of_errors"),
        "routeable_url",
        "document_title",
        "issues",
        as_of.cast("date").alias("scan_date"),
    )
