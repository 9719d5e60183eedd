"""In-site links of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siteledger.functions.html import attribute, decode_entities, start_tags, visible_markup
from siteledger.functions.text import strip
from siteledger.functions.urls import (
    BaseUrl,
    clean_url,
    composite_id,
    is_absolute,
    let,
    netloc,
    resolve_against,
    site_parts,
)
from siteledger.operators.explode import explode_kept

# Parts of a URL that mark it as no page of the site.
UNWANTED = ("mailto", "tel:", "javascript", "youtube.com", "twitter.com")

# File extensions that public crawlers skip by default.
IGNORED_EXTENSIONS = (
    # archives
    "7z", "7zip", "bz2", "rar", "tar", "tar.gz", "xz", "zip",
    # images
    "mng", "pct", "bmp", "gif", "jpg", "jpeg", "png", "pst", "psp", "tif", "tiff", "ai",
    "drw", "dxf", "eps", "ps", "svg", "cdr", "ico", "webp",
    # audio
    "mp3", "wma", "ogg", "wav", "ra", "aac", "mid", "au", "aiff",
    # video
    "3gp", "asf", "asx", "avi", "mov", "mp4", "mpg", "qt", "rm", "swf", "wmv", "m4a", "m4v",
    "flv", "webm",
    # office documents
    "xls", "xlsm", "xlsx", "xltm", "xltx", "potm", "potx", "ppt", "pptm", "pptx", "pps",
    "doc", "docb", "docx", "docm", "dot", "dotm", "dotx", "odt", "ods", "odg", "odp",
    # other
    "css", "pdf", "exe", "bin", "rss", "dmg", "iso", "apk", "jar", "sh", "rb", "js", "hta",
    "bat", "cpl", "msi", "msp", "py",
)


def has_ignored_extension(
    url: Column, extensions: Sequence[str] = IGNORED_EXTENSIONS, compat: bool = False
) -> Column:
    """the URL ends with an ignored file extension, in any case.

    ``compat`` asks only for the letters at the end, without the dot before them, so that
    ``/ships`` counts as a ``ps`` file.
    """
    lowered = F.lower(url)
    if compat:
        return lowered.rlike("(?:" + "|".join(e.replace(".", r"\.") for e in extensions) + ")$")
    # One hash-set lookup for the part after the last dot.
    found = F.substring_index(lowered, ".", -1).isin(*[e for e in extensions if "." not in e])
    for extension in extensions:
        if "." in extension:
            found = found | lowered.endswith(f".{extension}")
    return found


def contains_any(url: Column, terms: Sequence[str]) -> Column:
    """the URL contains one of the terms."""
    found = F.lit(False)
    for term in terms:
        found = found | url.contains(term)
    return found


def page_links(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    extensions: Sequence[str] = IGNORED_EXTENSIONS,
    unwanted: Sequence[str] = UNWANTED,
    compat: bool = False,
    followed: bool = False,
) -> DataFrame:
    """Add ``links``, the distinct links of each page as array<struct(url, raw)>.

    A link is kept if it is no fragment of the page, has no ignored extension, no unwanted
    term and names a scheme. ``url`` is its address cut at ``?`` and ``#``, ``raw`` the full
    one. All of a page's links are handled inside its row, so nothing is shuffled.

    ``followed`` adds the links a crawl may follow in the same form. Those are read as a link extractor
    reads them: ``area`` elements count like ``a``, and addresses resolve against the
    document's ``base`` where it has one. ``links`` knows neither.
    """

    def resolved(markup: Column, tags: str, base: BaseUrl) -> Column:
        hrefs = F.transform(start_tags(markup, tags), lambda attrs: strip(decode_entities(attribute(attrs, "href"))))
        distinct = F.array_distinct(F.filter(hrefs, lambda h: (h != "") & ~h.startswith("#")))
        absolute = F.filter(
            F.transform(distinct, lambda h: resolve_against(base, h)),
            lambda u: ~has_ignored_extension(u, extensions, compat) & is_absolute(u),
        )
        return F.filter(
            F.transform(absolute, lambda u: F.struct(clean_url(u).alias("url"), u.alias("raw"))),
            lambda link: ~contains_any(link["url"], unwanted),
        )

    def parts(of: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in zip(BaseUrl._fields, BaseUrl.of(of))])

    own = BaseUrl(*[F.col(f"_base.{n}") for n in BaseUrl._fields])
    read = pages.withColumns({"_markup": visible_markup(F.col(f"`{html}`")), "_base": parts(F.col(f"`{url}`"))})
    read = read.withColumn("links", resolved(F.col("_markup"), "a", own))
    if followed:
        stated = F.transform(start_tags(F.col("_markup"), "base"), lambda attrs: strip(decode_entities(attribute(attrs, "href"))))
        first = F.get(F.filter(stated, lambda h: h != ""), F.lit(0))
        other = F.col("_markup").rlike(r"(?i)<(?:area|base)[\s/>]")
        stated_url = F.when(other, let(first, lambda h: F.when(h.isNotNull(), resolve_against(own, h))))
        read = read.withColumn("_stated", F.coalesce(stated_url, F.col("_base.url"))).withColumns({"_from": parts(F.col("_stated")), "_other": other})
        base = BaseUrl(*[F.col(f"_from.{n}") for n in BaseUrl._fields])
        read = read.withColumn("followed", F.when(F.col("_other"), resolved(F.col("_markup"), "(?:a|area)", base)).otherwise(F.col("links")))
        read = read.drop("_stated", "_from", "_other")
    return read.drop("_markup", "_base")


def extract_links(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    site: Column | None = None,
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """``(*keep, page_url, url)``: each distinct in-site link of each page, once.

    F12: a link is in-site if its address contains ``site``, by default the network location
    of the page.
    """
    site = netloc(F.col(f"`{url}`")) if site is None else site
    found = page_links(
        pages.select(*keep, F.col(f"`{url}`").alias("_url"), F.col(f"`{html}`").alias("_html"),
                     site.alias("_site")),
        "_url", "_html", **options,
    )
    in_site = F.filter(
        F.array_distinct(F.transform("links", lambda link: link["url"])),
        lambda u: F.contains(u, F.col("_site")),
    )
    return explode_kept(found, [*keep, F.col("_url").alias("page_url")], in_site, "url")


def unseen_links(links: DataFrame, seen: DataFrame, on: str | Sequence[str] = "url") -> DataFrame:
    """Links that are not in the seen set.

    The seen set is made distinct first, which is combined before its shuffle: a link seen
    very often arrives once. A hot link on the left side is split by adaptive execution.
    """
    names = [on] if isinstance(on, str) else list(on)
    return links.join(seen.select(*names).distinct(), names, "left_anti")


def link_messages(
    links: DataFrame,
    agency: Column,
    organization: Column,
    url: str = "url",
    suffixes: Sequence[str] = ("gov",),
    tld: Column | None = None,
) -> DataFrame:
    """One link message per link, with its composite id."""
    named = links.select(
        agency.alias("Agency"),
        organization.alias("Organization"),
        F.col(f"`{url}`").alias("routeable_url"),
        site_parts(F.col(f"`{url}`"), suffixes).alias("_parts"),
        (F.lit(suffixes[0]) if tld is None else tld).alias("tld"),
    )
    domain, subdomain, path = (F.col(f"_parts.{p}") for p in ("domain", "subdomain", "path"))
    return named.select(
        "Agency",
        "Organization",
        domain,
        subdomain,
        "tld",
        "routeable_url",
        composite_id(
            F.col("Agency"), F.col("Organization"), domain, subdomain, path
        ).alias("db_id"),
    )
