"""Fetched pages in folders by the key they are looked up under."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siteledger.functions.urls import page_key
from siteledger.session import materialize, scratch_path

#: Folders of a page table. A table keeps the number it was written with.
PAGE_BUCKETS = 256
#: Keys of a look-up up to this size go to every reader of pages; beyond, only their folders do.
BROADCAST_BYTES = 32 << 20

KEY, BUCKET, BUCKETS = "page_key", "page_bucket", "page_buckets"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_pages(pages: DataFrame, path: str, url: str = "url", buckets: int = PAGE_BUCKETS) -> None:
    """Lay pages out in folders by the hash of their key, so that a look-up opens only the folders it needs.

    This is the one time that page source moves. Adaptive execution gives a large folder several
    files. Within a file pages are sorted by key, so that a reader skips row groups as well.
    """
    key = page_key(F.col(f"`{url}`"))
    rows = pages.withColumns({KEY: key, BUCKETS: F.lit(buckets), BUCKET: bucket_of(key, buckets)})
    rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, KEY).write.mode("overwrite").partitionBy(
        BUCKETS, BUCKET
    ).parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def is_laid_out(pages: DataFrame) -> bool:
    return {KEY, BUCKET, BUCKETS} <= set(pages.columns)


def pages_of(
    pages: DataFrame, sites: DataFrame, url: str = "routeable_url", most: int = BROADCAST_BYTES
) -> DataFrame:
    """The pages of a ``write_pages`` table at the addresses ``sites`` names; their source stays where it is.

    The distinct keys of the sites are written first, so their size is known. Up to ``most`` bytes of
    them are broadcast and tell pages apart; of more only the numbers of their folders are, and
    the result then holds further pages of those folders, which no site asks for. Either way the scan of the pages
    prunes its folders when it runs, by what the sites turned out to be.
    """
    spark = pages.sparkSession
    found = pages.select(BUCKETS).first()
    if found is None:
        return pages
    key = page_key(F.col(f"`{url}`"))
    keys = sites.select(key.alias(KEY)).filter(F.length(KEY) > 0).distinct()
    keys = materialize(keys.withColumn(BUCKET, bucket_of(F.col(KEY), found[0])), scratch_path(spark, "page-keys"))
    size = keys.agg(F.sum(F.octet_length(KEY) + 16)).first()[0] or 0
    # The filters say nothing new: only a side that is filtered may prune the folders of the other.
    if size <= most:
        wanted, on = keys.filter(F.length(KEY) > 0), [BUCKET, KEY]
    else:
        wanted, on = keys.select(BUCKET).distinct().filter(F.col(BUCKET) >= 0), [BUCKET]
    return pages.join(F.broadcast(wanted), on, "left_semi")
