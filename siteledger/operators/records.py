"""Scan records over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siteledger import schemas
from siteledger.functions.messages import date_text, issue_count, list_length, scan_result
from siteledger.functions.urls import record_key
from siteledger.operators.dedupe import latest_per_key
from siteledger.operators.explode import with_fields

RECORD_KEYS = ("agency", "organization", "domain", "subdomain")
RECORD_RETENTION_DAYS = 10
DEAD_LETTER_RETENTION_DAYS = 5


def retain(
    df: DataFrame, date: str, as_of: Column, days: int = RECORD_RETENTION_DAYS
) -> DataFrame:
    """Drop rows more than ``days`` days older than ``as_of``. On a table partitioned
    by ``date`` this prunes partitions."""
    return df.filter(F.col(f"`{date}`") >= F.date_sub(as_of.cast("date"), days))


def latest_records(
    records: DataFrame,
    ts: str | Sequence[str] = "scan_date",
    keys: Sequence[str] = RECORD_KEYS,
) -> DataFrame:
    """The record written last under each key."""
    return latest_per_key(records, keys, ts)


def accessible_share(
    records: DataFrame, by: Sequence[str] = (), count: Column | None = None
) -> DataFrame:
    """``n_records``, ``n_accessible`` and their ratio, in all or per group.

    Records whose issue count is NULL are unreadable and count nowhere; with no record the
    share is NULL. Counting is pre-aggregated before the shuffle, so a group holding most
    records is no heavier than any other.
    """
    n = F.col("number_of_errors") if count is None else count
    groups = [F.col(f"`{b}`") for b in by]
    return (
        records.select(*groups, n.alias("_n"))
        .filter("_n IS NOT NULL")
        .groupBy(*groups)
        .agg(
            F.count("*").alias("n_records"),
            F.count_if(F.col("_n") == 0).alias("n_accessible"),
            F.avg((F.col("_n") == 0).cast("double")).alias("accessible_share"),
        )
    )


def daily_shares(
    records: DataFrame,
    by: Sequence[str] = (),
    days: int = RECORD_RETENTION_DAYS,
    first: Column | None = None,
    last: Column | None = None,
    keys: Sequence[str] = RECORD_KEYS,
    date: str = "scan_date",
    ts: str | Sequence[str] = (),
    count: Column | None = None,
) -> DataFrame:
    """The share of every day, as a snapshot of that day would give it, in one pass.

    Returns ``(*by, snapshot_date, n_records, n_accessible, accessible_share)``, a row for each day
    from ``first`` to ``last`` (by default from the first scan until the last one expires) on which
    a group holds a record.

    A record counts from its scan day until the day before its key's next scan, or until ``days``
    days later, whichever comes first. Only the two ends of that interval move, as +1 and -1; sums
    of these per day and group, added up in order of day, are the counts. So neither records nor days are
    multiplied by each other: a key sends one row per scan day and input partition, a group two
    rows per day, and the running sums read one row per day of a group.

    Of several scans of a key on one day the last by ``ts`` counts. A record whose count is NULL
    counts nowhere, but ends the interval of the one before. Records without a date are left out.
    """
    order = [ts] if isinstance(ts, str) else list(ts)
    n = F.col("number_of_errors") if count is None else count
    key_names = [f"_k{i}" for i in range(len(keys))]
    by_names = [f"_b{i}" for i in range(len(by))]
    written = [F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)]
    groups = [F.col(f"`{b}`").alias(name) for name, b in zip(by_names, by)]
    scans = (
        records.filter(F.col(f"`{date}`").isNotNull())
        .groupBy(
            *[F.col(f"`{k}`").alias(name) for name, k in zip(key_names, keys)],
            F.col(f"`{date}`").cast("date").alias("_day"),
        )
        .agg(F.max(F.struct(*written, n.alias("_n"), *groups)).alias("_scan"))
    )
    following = F.lead("_day").over(Window.partitionBy(*key_names).orderBy("_day"))
    expires = F.date_add("_day", days + 1)
    until = F.least(expires, F.coalesce(following, expires))  # the first day on which it no longer counts
    spans = scans.select(
        F.col("_day").alias("_from"), until.alias("_until"), "_scan._n", *[f"_scan.{b}" for b in by_names]
    ).filter("_n IS NOT NULL")
    if first is not None:
        spans = spans.withColumn("_from", F.greatest("_from", first.cast("date")))
    if last is not None:
        spans = spans.withColumn("_until", F.least("_until", F.date_add(last.cast("date"), 1)))
    change = F.explode(F.array(
        F.struct(F.col("_from").alias("day"), F.lit(1).alias("sign")),
        F.struct(F.col("_until").alias("day"), F.lit(-1).alias("sign")),
    ))
    changes = (
        spans.filter("_from < _until")
        .select(*by_names, (F.col("_n") == 0).cast("int").alias("_good"), change.alias("_at"))
        .groupBy(*by_names, F.col("_at.day").alias("_day"))
        .agg(F.sum("_at.sign").alias("_d"), F.sum(F.col("_at.sign") * F.col("_good")).alias("_g"))
    )
    in_order = Window.partitionBy(*by_names).orderBy("_day")
    held = changes.select(
        *by_names,
        "_day",
        F.lead("_day").over(in_order).alias("_next"),
        F.sum("_d").over(in_order).alias("n_records"),
        F.sum("_g").over(in_order).alias("n_accessible"),
    ).filter("n_records > 0")
    return held.select(
        *[F.col(name).alias(b) for name, b in zip(by_names, by)],
        F.explode(F.sequence("_day", F.date_sub("_next", 1))).alias("snapshot_date"),
        "n_records",
        "n_accessible",
        (F.col("n_accessible") / F.col("n_records")).alias("accessible_share"),
    )


def split_unreadable(files: DataFrame, issues: str = "issues") -> tuple[DataFrame, DataFrame]:
    """Record files with a readable issue text, and the others."""
    readable = issue_count(F.col(f"`{issues}`")).isNotNull()
    return files.filter(readable), files.filter(~readable)


def from_files(files: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed records from the stored form, whose issues are JSON inside a text. ``keep``
    names further columns to carry, such as ``written_at``."""
    parsed = with_fields(files, {"_result": scan_result(F.col("issues"))})
    result, no_issues = F.col("_result"), F.array().cast(schemas.SCAN_RESULT["issues"].dataType)
    return parsed.select(
        "agency",
        "organization",
        "domain",
        "subdomain",
        F.when(result.isNotNull(), list_length(result["issues"])).alias("number_of_errors"),
        F.col("routeableUrl").alias("routeable_url"),
        F.col("_result.documentTitle").alias("document_title"),
        F.coalesce(F.from_json(result["issues"], schemas.SCAN_RESULT["issues"].dataType), no_issues).alias("issues"),
        F.col("scanDate").try_cast("date").alias("scan_date"),
        *keep,
    )


def to_files(records: DataFrame) -> DataFrame:
    """The stored form of typed records, with the storage ``key`` of each."""
    result = F.struct(
        F.col("document_title").alias("documentTitle"),
        F.col("routeable_url").alias("pageUrl"),
        F.col("issues"),
    )
    return records.select(
        record_key(*[F.col(k) for k in RECORD_KEYS]).alias("key"),
        "agency",
        "organization",
        "domain",
        "subdomain",
        F.col("number_of_errors").cast("string").alias("numberOfErrors"),
        F.col("routeable_url").alias("routeableUrl"),
        F.to_json(result, {"ignoreNullFields": "false"}).alias("issues"),
        date_text(F.col("scan_date")).alias("scanDate"),
    )
