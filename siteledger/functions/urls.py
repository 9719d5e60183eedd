"""URL expressions. All are built-in column expressions, no UDFs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from siteledger.functions.text import strip

# RFC 3986 appendix B, in parts.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"

# The order in which addresses of one host are tried.
CANDIDATE_PREFIXES = ("https://", "https://www.", "http://www.", "http://")


def _empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def join_host(subdomain: Column, domain: Column, tld: Column) -> Column:
    """Host from its parts; an absent subdomain, or one equal to the domain, is left out."""
    bare = F.concat_ws(".", domain, tld)
    return F.when(_empty(subdomain) | (subdomain == domain), bare).otherwise(
        F.concat_ws(".", subdomain, domain, tld)
    )


def full_host(subdomain: Column, domain: Column, tld: Column | None = None) -> Column:
    """Host of a site message; the tld defaults to ``gov``."""
    tld = F.lit("gov") if tld is None else F.coalesce(tld, F.lit("gov"))
    return F.when(_empty(subdomain), F.concat_ws(".", domain, tld)).otherwise(
        F.concat_ws(".", subdomain, domain, tld)
    )


def with_scheme(c: Column) -> Column:
    """Prefix ``https://`` unless an http(s) scheme is present."""
    return F.when(c.rlike("^https?://"), c).otherwise(F.concat(F.lit("https://"), c))


def strip_scheme(c: Column) -> Column:
    return F.regexp_replace(c, "^https?://", "")


def netloc(url: Column) -> Column:
    """Authority part of a URL, '' when there is none."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def host_of(url: Column) -> Column:
    """Bare host of a URL or host text: no scheme, user info, port, path or trailing dot."""
    authority = F.regexp_extract(
        url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?([^/?#]*)", 1
    )
    host = F.regexp_extract(authority, r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1)
    return F.rtrim(F.translate(host, "\u3002\uff0e\uff61", "..."), F.lit("."))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def clean_url(url: Column) -> Column:
    """Cut at the first ``?`` and the first ``#``."""
    return F.regexp_replace(url, r"(?s)[?#].*$", "")


def page_key(url: Column) -> Column:
    """Address under which a page is looked up: cut like a link, with ``/`` as empty path."""
    return F.regexp_replace(clean_url(url), "^([A-Za-z][A-Za-z0-9+.-]*://[^/]+)$", "$1/")


def is_absolute(url: Column) -> Column:
    """F16: the URL names a scheme."""
    return url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class BaseUrl(NamedTuple):
    """Parts of a page address that references on the page resolve against."""

    url: Column
    scheme: Column
    origin: Column
    path: Column

    @classmethod
    def of(cls, url: Column) -> BaseUrl:
        return cls(
            url,
            F.regexp_extract(url, _SCHEME, 1),
            F.regexp_extract(url, r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?)", 1),
            url_path(url),
        )


def _remove_dot_segments(segments: Column, rooted: Column) -> Column:
    """Path from its segments with ``.`` and ``..`` resolved; inner empty segments go too,
    unless the reference began with a slash."""
    last = F.size(segments) - 1
    walked = F.aggregate(
        F.filter(segments, lambda s, i: (s != "") | (i == 0) | (i == last) | rooted),
        F.array().cast("array<string>"),
        lambda done, s: F.when(
            s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        ).when(s == ".", done).otherwise(F.concat(done, F.array(s))),
    )
    closing = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")
    )
    return F.regexp_replace(F.array_join(F.concat(walked, closing), "/"), "^(?!/)", "/")


def _merge(base: BaseUrl, rest: Column) -> Column:
    """Resolve a reference that has a path but no host."""
    rooted = rest.startswith("/")
    directory = F.regexp_extract(base.path, "(?s)^(.*/)", 1)
    path = F.regexp_extract(rest, "^([^?#]*)", 1)
    merged = F.when(rooted, path).otherwise(
        F.regexp_replace(F.concat(directory, path), "^(?!/)", "/")
    )
    tail = F.regexp_extract(rest, "(?s)^[^?#]*(.*)$", 1)
    return F.concat(
        base.origin,
        let(F.split(merged, "/", -1), lambda segments: _remove_dot_segments(segments, rooted)),
        tail,
    )


def resolve_against(base: BaseUrl, href: Column) -> Column:
    """Resolve the stripped reference ``href`` against a page.

    Works on text, so a blank or another illegal character in a URL does not turn the
    result to NULL as the built-in URL parser would. The common forms come first and need
    no regular expression.
    """

    def relative(rest: Column) -> Column:
        return (
            F.when(rest == "", base.url)
            .when(rest.startswith("?"), F.concat(base.origin, base.path, rest))
            .when(rest.startswith("#"), F.concat(F.regexp_replace(base.url, "(?s)#.*$", ""), rest))
            .otherwise(_merge(base, rest))
        )

    # "https:page" with the scheme of the page but no host is a relative reference.
    own_scheme = F.lower(F.regexp_extract(href, _SCHEME, 1)) == F.lower(base.scheme)
    return (
        F.when(href.startswith("https://") | href.startswith("http://"), href)
        .when(href.startswith("//"), F.concat(base.scheme, F.lit(":"), href))
        .when(href.startswith("/") & ~href.contains("/."), F.concat(base.origin, href))
        .when(
            is_absolute(href),
            F.when(
                own_scheme & ~href.rlike("^[^:]*://"),
                let(F.regexp_replace(href, _SCHEME, ""), relative),
            )
            .when(own_scheme, F.concat(F.lower(F.regexp_extract(href, _SCHEME, 0)), F.regexp_replace(href, _SCHEME, "")))
            .otherwise(href),
        )
        .otherwise(relative(href))
    )


def resolve_url(base: Column, href: Column) -> Column:
    """P14 for two plain columns."""
    return resolve_against(BaseUrl.of(base), strip(href))


def site_parts(url: Column, suffixes: Sequence[str] = ("gov",)) -> Column:
    """struct(domain, subdomain, path) of a URL, read around the first listed suffix.

    The last label before the suffix is the domain; of the labels before it one ``www`` is
    dropped and the rest is the subdomain.
    """
    alternatives = "|".join(s.replace(".", r"\.") for s in suffixes)
    before = F.regexp_replace(netloc(url), rf"(?s)\.(?:{alternatives}).*$", "")
    labels = F.split(before, r"\.")
    front = F.slice(labels, 1, F.size(labels) - 1)
    www = F.array_position(front, "www").cast("int")
    kept = F.filter(front, lambda _, i: i != www - 1)
    path = F.regexp_replace(url_path(url), ";[^/]*$", "")
    return F.struct(
        F.element_at(labels, -1).alias("domain"),
        F.array_join(kept, ".").alias("subdomain"),
        F.regexp_replace(path, "^/", "").alias("path"),
    )


def composite_id(*parts: Column) -> Column:
    """Parts joined with ``+``; a missing part counts as empty."""
    return F.concat_ws("+", *[F.coalesce(p, F.lit("")) for p in parts])


def record_key(agency: Column, organization: Column, domain: Column, subdomain: Column) -> Column:
    """Storage key of a scan record; an empty subdomain is left out."""
    return F.concat_ws("/", agency, organization, domain, F.nullif(subdomain, F.lit("")))
