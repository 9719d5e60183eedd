"""Scan and joined results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siteledger.functions.messages import issue_count
from siteledger.operators.records import (
    RECORD_RETENTION_DAYS,
    accessible_share,
    daily_shares,
    from_files,
    latest_records,
    retain,
    split_unreadable,
)
from siteledger.operators.scan import scan_pages, scan_records
from siteledger.session import materialize, scratch_path
from siteledger.sources.history import append_history
from siteledger.sources.pages import is_laid_out, pages_of
from siteledger.sources.records import read_record_files, read_records, write_records


def scan_sites(
    inventory: DataFrame,
    pages: DataFrame,
    as_of: Column,
    url: str = "url",
    html: str = "html",
    fetched_at: str | None = None,
    failures: bool = False,
) -> DataFrame:
    """Scan records of all inventory sites whose page was fetched; ``failures`` gives the others.

    Page source is never shuffled: pages are scanned where they lie, and the much smaller
    results are joined under the key of their page, so ``https://a.gov`` and ``https://a.gov/``
    are one. Of several fetches of a page the newest by ``fetched_at`` counts. All pages handed in
    are scanned, unless they come from a ``write_pages`` table: of that only the folders with pages of
    these sites are opened.
    """
    if is_laid_out(pages):
        pages = pages_of(pages, inventory)
    fetched = pages.select(url, html, *([fetched_at] if fetched_at else []))
    scanned = scan_pages(fetched, html)
    return scan_records(inventory, scanned, as_of, url, failures, fetched_at)


def join_results(
    spark: SparkSession,
    record_dir: str,
    data_path: str,
    history_path: str,
    as_of: Column,
    days: int = RECORD_RETENTION_DAYS,
    upsert: bool = False,
    one_per_file: bool = True,
    unreadable_path: str | None = None,
    by_file_age: bool = False,
) -> DataFrame:
    """All stored records to one table, and their accessible share to the history.

    Of several records under one key the one of the last scan, written last, counts. A record
    whose date cannot be read is as old as its file; records dated after ``as_of`` are left for
    a later run. Unreadable records go to ``unreadable_path``, where one is named.

    ``by_file_age`` trusts that a file is not older than the scan it holds: files from before the first
    day retained, less a day for time zones, are left out when they are listed and never opened.
    """
    since = None
    if by_file_age:
        day = F.date_format(F.date_sub(as_of.cast("date"), days + 1), "yyyy-MM-dd'T'00:00:00")
        since = spark.range(1).select(day).first()[0]
    files = read_record_files(spark, record_dir, one_per_file=one_per_file, modified_after=since)
    if unreadable_path:
        # read and judged once: one write, a folder for either kind
        judged = materialize(
            files.withColumn("readable", issue_count(F.col("issues")).isNotNull()),
            scratch_path(spark, "record-files"),
            "readable",
        )
        judged.filter("NOT readable").drop("readable").write.mode("overwrite").parquet(unreadable_path)
        readable = judged.filter("readable").drop("readable")
    else:
        readable, _ = split_unreadable(files)
    records = retain(
        from_files(readable, ["written_at"]).withColumn(
            "scan_date", F.coalesce("scan_date", F.to_date("written_at"))
        ),
        "scan_date", as_of, days,
    ).filter(F.col("scan_date") <= as_of.cast("date"))
    latest = latest_records(records, ["scan_date", "written_at"]).drop("written_at")
    write_records(latest, data_path)
    share = accessible_share(read_records(spark, data_path))
    append_history(share, as_of, history_path, upsert=upsert)
    return share


def backfill_history(
    records: DataFrame,
    history_path: str,
    first: Column | None = None,
    last: Column | None = None,
    days: int = RECORD_RETENTION_DAYS,
    ts: str | Sequence[str] = (),
) -> None:
    """The history as a snapshot on each day from ``first`` to ``last`` would have left it.

    All days come out of one pass over the records and replace those that are there already.
    """
    shares = daily_shares(records, days=days, first=first, last=last, ts=ts)
    append_history(shares, F.col("snapshot_date"), history_path, upsert=True)
