"""Site filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siteledger.functions.text import strip

# Tlds of the inventory, the type of owner kept, and the parts of a site name
# (read as regular expressions) that mark it as not public.
INVENTORY_TLDS = ("gov", "fed.us", "mil")
EXECUTIVE = "Federal Agency - Executive"
NON_PUBLIC_TERMS = (
    "dev", "test", "staging", "webmail", "intranet", "gopher", "beta", "ftp", "smtp",
    "preprod", "mail2", "fas.my.salesforce", "uccams", "gitlab", "github",
)
EXCLUDED_URL_ENDINGS = ("ecpic.gov/",)
EXCLUDED_URLS = ("https://helix1-redirect.uspto.gov/",)


def _col(name: str):
    return F.col(f"`{name}`")


def drop_headers(df: DataFrame, column: str) -> DataFrame:
    """drop rows that hold the text ``domain``."""
    return df.filter(~_col(column).contains("domain"))


def has_domain(df: DataFrame, column: str = "domain") -> DataFrame:
    """keep rows with a registrable domain."""
    return df.filter(_col(column) != "")


def keep_tlds(
    df: DataFrame, tlds: Sequence[str] = INVENTORY_TLDS, column: str = "tld"
) -> DataFrame:
    """keep the listed top-level domains."""
    return df.filter(_col(column).isin(*tlds))


def keep_type(
    df: DataFrame, domain_type: str = EXECUTIVE, column: str = "Domain Type", stripped: bool = False
) -> DataFrame:
    """F4, and F5 with ``stripped``: keep one type of owner."""
    value = strip(_col(column)) if stripped else _col(column)
    return df.filter(value == domain_type)


def exclude_terms(
    df: DataFrame, column: str, terms: Sequence[str] = NON_PUBLIC_TERMS
) -> DataFrame:
    """drop values that match any term; one pass with one pattern."""
    return df.filter(~_col(column).rlike("|".join(terms))) if terms else df


def exclude_urls(
    df: DataFrame,
    column: str,
    exact: Sequence[str] = (),
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """Drop exact URLs and URLs with one of the endings."""
    for ending in suffixes:
        df = df.filter(~_col(column).endswith(ending))
    return df.filter(~_col(column).isin(*exact)) if exact else df
