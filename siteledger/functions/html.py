"""HTML expressions.

Pages are read with regular expressions, not a browser: markup made by scripts is not seen.
Two rules keep any page, however long or broken, from stopping a task. Loops over groups are
possessive, which the regex engine runs without recursion and so without a deep stack. And a
pattern that has found the start of a tag always matches, to the end of the page if the tag
is never closed, so that no text is read twice.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from siteledger.functions.urls import let

# Text of a tag after its name, with the closing ">" if there is one.
TAG_REST = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+>?+)"""
_VALUE = r"""("[^"]*+"|'[^']*+'|[^\s"'>]++)"""
# One leading "<" for all three lets the engine skip quickly through plain text.
_HIDDEN = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script(?=[\s/>]).*?(?:</script\s*>|\z)"
    r"|style(?=[\s/>]).*?(?:</style\s*>|\z))"
)


def visible_markup(html: Column) -> Column:
    """Page source without comments, scripts and style sheets."""
    return F.regexp_replace(html, _HIDDEN, "")


def _closed(tags: Column) -> Column:
    return F.filter(tags, lambda tag: tag.endswith(">"))


def start_tags(html: Column, name: str) -> Column:
    """Every start tag ``name``, as its text after the name, in page order."""
    return _closed(
        F.regexp_extract_all(html, F.lit(rf"(?i)<{name}(?=[\s/>]){TAG_REST}"), F.lit(1))
    )


def all_start_tags(html: Column) -> Column:
    """Every start tag of any name, as its text after the name."""
    return _closed(
        F.regexp_extract_all(html, F.lit(rf"<[A-Za-z][A-Za-z0-9:-]*+{TAG_REST}"), F.lit(1))
    )


def first_start_tag(html: Column, name: str) -> Column:
    """Text after the name of the first start tag ``name``; '' without one."""
    return F.regexp_extract(html, rf"(?i)<{name}(?=[\s/>]){TAG_REST}", 1)


def elements(html: Column, name: str) -> Column:
    """Every ``<name ...>...</name>`` element as text, for elements that do not nest; the
    last one may be left open to the end of the page."""
    return F.regexp_extract_all(
        html, F.lit(rf"(?is)(<{name}(?=[\s/>]).*?(?:</{name}\s*>|\z))"), F.lit(1)
    )


def _up_to(name: str) -> str:
    """Pattern of the attributes before ``name``, consumed one by one, so that text inside
    another attribute's quotes is never taken for an attribute."""
    return (
        rf"""(?i)^(?:[\s/]*+(?:(?!{name}(?:[\s=/>]|$))[^\s=>"'/]++"""
        r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+|["'=]))*+[\s/]*+"""
        rf"{name}"
    )


def attribute(attrs: Column, name: str) -> Column:
    """Raw value of the first attribute ``name``; NULL when the tag has none with a value."""
    return let(
        F.regexp_extract(attrs, rf"{_up_to(name)}\s*+=\s*+{_VALUE}", 1),
        lambda raw: F.when(raw != "", F.regexp_replace(raw, """^["']|["']$""", "")),
    )


def has_attribute(attrs: Column, name: str) -> Column:
    """The tag names the attribute, with or without a value."""
    return attrs.rlike(rf"{_up_to(name)}(?:[\s=/>]|$)")


def has_text(attrs: Column, name: str) -> Column:
    """The tag has the attribute with a value that is not blank."""
    return F.coalesce(
        attrs.rlike(rf"""{_up_to(name)}\s*+=\s*+(?:"\s*+[^"]|'\s*+[^']|[^\s"'>])"""), F.lit(False)
    )


def text_of(markup: Column) -> Column:
    """Text of a piece of markup without its tags."""
    return F.regexp_replace(markup, "(?s)<[^>]*+>?+", "")


def _named_references() -> str:
    """The standard library's named character references, as a JSON object."""
    table = {name: chr(code) for name, code in name2codepoint.items()}
    table["apos"] = "'"
    return json.dumps(table)


_REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _code_point(digits: Column) -> Column:
    """Character of an eight-digit hexadecimal code point; U+FFFD outside the valid ranges."""
    valid = digits.rlike("^0000(?!0000|[dD][89a-fA-F])|^000[1-9a-fA-F]|^0010")
    return F.when(valid, F.decode(F.unhex(digits), "UTF-32")).otherwise(F.lit("\ufffd"))


def decode_entities(c: Column) -> Column:
    """Replace ``&amp;``, ``&#38;`` and ``&#x26;`` forms; other ampersands stay as they are."""
    names = F.from_json(F.lit(_named_references()), "map<string,string>")

    def replaced(p: Column, ref: Column) -> Column:
        number = F.regexp_replace(ref, "^#[xX]?0*", "")  # any number of leading zeros
        digits = F.when(ref.rlike("^#[xX]"), number).otherwise(
            F.hex(F.when(F.length(number) <= 7, F.coalesce(number.try_cast("bigint"), F.lit(0))))
        )
        known = F.when(F.length(digits) <= 8, F.lpad(digits, 8, "0")).otherwise("FFFFFFFF")
        char = F.when(ref.startswith("#"), let(known, _code_point)).otherwise(F.element_at(names, ref))
        return F.coalesce(
            F.concat(char, F.substr(p, F.length(ref) + 2)),
            F.concat(F.lit("&"), p),
        )

    def piece(p: Column) -> Column:
        ref = F.regexp_extract(p, _REFERENCE, 1)
        return F.when(p.rlike(_REFERENCE), let(ref, lambda r: replaced(p, r))).otherwise(
            F.concat(F.lit("&"), p)
        )

    def decoded(text: Column) -> Column:
        return let(
            F.split(text, "&", -1),
            lambda parts: F.concat(
                F.element_at(parts, 1),
                F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""),
            ),
        )

    return let(c, lambda text: F.when(text.contains("&"), decoded(text)).otherwise(text))
