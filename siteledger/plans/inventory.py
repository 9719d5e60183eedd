"""Inventory build: registry and seed sites to routeable, named sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siteledger import schemas
from siteledger.functions.text import blank_bare_www, drop_www_prefix
from siteledger.functions.urls import join_host, with_scheme
from siteledger.operators.dedupe import keep_first, keep_first_except
from siteledger.operators.filters import (
    EXCLUDED_URL_ENDINGS,
    EXCLUDED_URLS,
    EXECUTIVE,
    NON_PUBLIC_TERMS,
    exclude_terms,
    exclude_urls,
    keep_type,
)
from siteledger.operators.hosts import split_host
from siteledger.operators.rename import AgencyRule, rename_by_rules
from siteledger.operators.routes import reachable, resolve_routes, url_candidates
from siteledger.plans.owner_rules import OWNER_RULES
from siteledger.sources.lists import ORDER

_REGISTRY_ORDER = [f"registry_{c}" for c in ORDER]
_SITE_ORDER = [f"site_{c}" for c in ORDER]


def merge_registry_sites(
    registry: DataFrame, sites: DataFrame, domain_type: str | None = EXECUTIVE
) -> DataFrame:
    """Every registry row with each seed site of its domain.

    Clashing columns get the endings ``_fed`` and ``_sites``. A registry row without a site
    keeps ``domain.tld`` as its site. The type filter runs before the join: it is on the
    left side, so the result is the same and the join smaller.

    The left join is written as an inner join and an anti join, because adaptive execution
    can split a domain that holds most of the sites only in an inner join.
    """
    left = registry if domain_type is None else keep_type(registry, domain_type)
    clash = [c for c in ("tld", "subdomain") if c in sites.columns]
    left = left.withColumnsRenamed(
        {**{c: f"{c}_fed" for c in clash}, **dict(zip(ORDER, _REGISTRY_ORDER))}
    )
    right = sites.withColumnsRenamed(
        {**{c: f"{c}_sites" for c in clash}, **dict(zip(ORDER, _SITE_ORDER))}
    )
    with_sites = left.join(right, "domain")
    alone = left.join(right.select("domain").distinct(), "domain", "left_anti")
    return with_sites.unionByName(
        alone.withColumn("site", F.concat_ws(".", "domain", "tld_fed")), allowMissingColumns=True
    )


def build_inventory(
    registry: DataFrame,
    suffixes: DataFrame,
    probe_log: DataFrame,
    sites: DataFrame | None = None,
    domain_type: str = EXECUTIVE,
    terms: Sequence[str] = NON_PUBLIC_TERMS,
    url_endings: Sequence[str] = EXCLUDED_URL_ENDINGS,
    urls: Sequence[str] = EXCLUDED_URLS,
    rules: Sequence[AgencyRule] = OWNER_RULES,
    probed_at: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """The site inventory. Without ``sites`` the registry is the only source.

    Filters and keep-first run before the join with the probe log, the largest input, and
    probes are joined once per distinct address.
    """
    if sites is None:
        order = list(ORDER)
        rows = keep_type(registry, domain_type)
        host = join_host(F.col("subdomain"), F.col("domain"), F.col("tld"))
    else:
        order = _REGISTRY_ORDER + _SITE_ORDER
        rows = merge_registry_sites(registry, sites, domain_type)
        rows = exclude_terms(keep_first(rows, ["site"], order), "site", terms)
        host = join_host(F.col("subdomain_sites"), F.col("domain"), F.col("tld_fed"))

    named = rows.select(
        "Domain Type", "Agency", "Organization", *order, with_scheme(host).alias("schematized_url")
    )
    named = keep_first(named, ["schematized_url"], order)
    # The rows travel with their candidates: looking the result up by address afterwards
    # (J2) would compute everything before this line a second time.
    resolved = resolve_routes(
        url_candidates(named, "schematized_url"),
        probe_log,
        "schematized_url",
        probed_at,
        keep=["Domain Type", "Agency", "Organization", *order],
    )
    routed = keep_first(reachable(resolved).drop("schematized_url"), ["routeable_url"], order)

    parts = split_host(routed, "routeable_url", suffixes).withColumn(
        "subdomain", blank_bare_www(F.col("subdomain"))
    )
    kept = exclude_urls(parts, "routeable_url", suffixes=url_endings)
    kept = keep_first_except(kept, "routeable_url", order)
    kept = exclude_urls(kept, "routeable_url", exact=urls).withColumn(
        "subdomain", drop_www_prefix(F.col("subdomain"), compat)
    )
    unique = keep_first(kept, ["subdomain", "domain", "tld"], order)
    return rename_by_rules(unique, rules=rules).select(*schemas.INVENTORY.names, *order)
