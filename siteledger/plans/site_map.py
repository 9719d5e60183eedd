"""Link mapping: sites to messages about every in-site link."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siteledger.functions.urls import full_host
from siteledger.operators.crawl import crawl
from siteledger.operators.links import link_messages


def map_links(
    sites: DataFrame,
    pages: DataFrame,
    max_depth: int | None = None,
    suffixes: Sequence[str] = ("gov",),
    **options,
) -> DataFrame:
    """One link message per site and in-site link reachable from its address.

    Links are followed on the site's host and below it. Owners come from the site; a missing
    one is empty.
    """
    seeds = sites.select(
        F.col("routeable_url").alias("seed_url"),
        full_host(F.col("subdomain"), F.col("domain"), F.col("tld")).alias("host"),
    )
    found = crawl(pages, seeds, max_depth, allowed_host=F.col("host"), **options)
    owners = sites.select(
        F.col("routeable_url").alias("seed_url"), "Agency", "Organization", "tld"
    )
    return link_messages(
        found.join(owners, "seed_url"),
        F.coalesce("Agency", F.lit("")),
        F.coalesce("Organization", F.lit("")),
        suffixes=suffixes,
    )
