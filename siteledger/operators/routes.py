"""Reachable address of a site from a probe log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from siteledger.functions.urls import CANDIDATE_PREFIXES, strip_scheme
from siteledger.operators.dedupe import keep_first, latest_per_key

TIMEOUT = "timeout"


def url_candidates(df: DataFrame, host: str) -> DataFrame:
    """P5: four ranked addresses per host. Adds ``rank`` and ``candidate_url``."""
    bare = strip_scheme(F.col(f"`{host}`"))
    ladder = F.array(*[F.concat(F.lit(p), bare) for p in CANDIDATE_PREFIXES])
    return df.select("*", F.posexplode(ladder).alias("rank", "candidate_url"))


def resolve_routes(
    candidates: DataFrame,
    probe_log: DataFrame,
    site: str,
    probed_at: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(site, *keep, routeable_url)`` for every site that some probe decided.

    A probe decides when it timed out or answered below 400. The best-ranked deciding
    address of a site wins: a timeout gives the text ``timeout``, status 200 the address the
    probe ended at, any other status NULL. Sites without a deciding probe are left out; a
    left join on the site shows them as NULL.

    Of repeated probes of one address the latest by the column ``probed_at`` counts; without
    such a column one that decides does, an answer of status 200 before any other. ``keep``
    carries columns of the candidates along, so that they need not be joined again.
    """
    timed_out = F.col("outcome") == TIMEOUT
    decides = timed_out | (F.col("status") < 400)
    columns = ["candidate_url", "outcome", "status", "final_url"]
    if probed_at:
        probes = latest_per_key(
            probe_log.select(*columns, probed_at), ["candidate_url"], [probed_at]
        ).filter(decides)
    else:
        good = F.coalesce(F.col("status") == 200, F.lit(False))
        probes = latest_per_key(
            probe_log.select(*columns, good.alias("_good")).filter(decides),
            ["candidate_url"],
            ["_good"],
        )
    url = F.when(timed_out, F.lit(TIMEOUT)).when(F.col("status") == 200, F.col("final_url"))
    decided = candidates.select(site, *keep, "rank", "candidate_url").join(probes, "candidate_url")
    return keep_first(
        decided.select(site, *keep, "rank", url.alias("routeable_url")), [site], ["rank"]
    ).drop("rank")


def attach_routes(df: DataFrame, resolved: DataFrame, site: str) -> DataFrame:
    """Look up each row's resolved address; NULL where no probe decided."""
    return df.join(resolved, site, "left")


def reachable(df: DataFrame, column: str = "routeable_url") -> DataFrame:
    """keep resolved rows that did not time out."""
    return df.filter(F.col(column) != TIMEOUT)
