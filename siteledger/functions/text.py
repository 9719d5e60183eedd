"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_host_text(c: Column) -> Column:
    """Lower case and stripped."""
    return strip(F.lower(c))


def title_case(c: Column) -> Column:
    """P10: capital after every non-letter, lower case elsewhere (``initcap`` splits on blanks only)."""
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


def blank_bare_www(subdomain: Column) -> Column:
    """A subdomain that is exactly ``www`` becomes empty."""
    return F.when(subdomain == "www", F.lit("")).otherwise(subdomain)


def drop_www_prefix(subdomain: Column, compat: bool = False) -> Column:
    """Drop a leading ``www.``; ``compat`` drops every ``www`` + any character."""
    return F.regexp_replace(subdomain, "www." if compat else r"^www\.", "")
