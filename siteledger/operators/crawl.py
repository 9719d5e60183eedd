"""Transitive in-site links over fetched pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siteledger.functions.urls import clean_url, host_of, netloc as netloc_of, page_key
from siteledger.operators.links import (
    IGNORED_EXTENSIONS,
    UNWANTED,
    contains_any,
    has_ignored_extension,
    page_links,
)
from siteledger.session import materialize, scratch_path
from siteledger.sources.pages import bucket_of

MAX_SLASHES = 5
#: Seeds of one site that share a row: the bits of a long.
SEEDS_A_WORD = 64
_SITE = ["netloc", "host", "word"]


def may_follow(
    raw: Column,
    unwanted: Sequence[str] = UNWANTED,
    extensions: Sequence[str] = IGNORED_EXTENSIONS,
    max_slashes: int = MAX_SLASHES,
) -> Column:
    """the part of the follow rule that does not depend on the site."""
    slashes = F.length(raw) - F.length(F.replace(raw, F.lit("/"), F.lit("")))
    return (
        (slashes <= max_slashes)
        & ~contains_any(raw, unwanted)
        & ~has_ignored_extension(clean_url(raw), extensions)
    )


def on_host(url: Column, host: Column) -> Column:
    """the URL's host is ``host`` or lies below it."""
    of_url = F.lower(host_of(url))
    return (of_url == host) | F.endswith(of_url, F.concat(F.lit("."), host))


def crawl(
    pages: DataFrame,
    seeds: DataFrame,
    max_depth: int | None = None,
    url: str = "url",
    html: str = "html",
    seed: str = "seed_url",
    netloc: Column | None = None,
    allowed_host: Column | None = None,
    emit_seed: bool = False,
    unwanted: Sequence[str] = UNWANTED,
    extensions: Sequence[str] = IGNORED_EXTENSIONS,
    **options,
) -> DataFrame:
    """``(seed, url, depth)``: every in-site link reachable from each seed, once.

    Breadth first over all seeds at once. Links are read from the page source one time, into
    folders by the hash of their page; a round opens the folders of the pages it reads only.
    Seeds with the same site share rows: each is one bit of a word of
    ``SEEDS_A_WORD``, so a round's rows grow with the pages and not with pages times seeds.
    Of earlier rounds only rows about links found again move. Written rounds end the lineage, survive
    lost executors and carry their true size, so a small frontier is broadcast and the links stay
    where they are; hot pages and hosts are split by adaptive execution.

    ``netloc`` (the text an in-site link contains) and ``allowed_host`` (followed links lie
    on it or below it) are columns of ``seeds``; both default to the seed's own. Links of
    ``area`` elements, and the addresses links have under a document's ``base``, are followed
    and not returned.
    """
    spark = pages.sparkSession
    root = scratch_path(spark, "crawl")
    folders = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = _numbered(seeds, seed, netloc, allowed_host, f"{root}/seeds")
    graph = _graph(pages, url, html, unwanted, extensions, options)
    graph = _in_folders(graph.withColumn("folder", bucket_of(F.col("page"), folders)), f"{root}/graph")
    bit = F.expr("shiftleft(1L, bit)")
    start = numbered.groupBy(*_SITE, "url").agg(F.bit_or(bit).alias("reach"))
    frontier = materialize(start.withColumn("follow", F.col("reach")), f"{root}/rounds/depth=0")
    fields, keys = frontier.schema, [*_SITE, "url"]
    rounds: list[str] = []
    depth = 0
    while max_depth is None or depth < max_depth:
        to_read = frontier.filter("follow <> 0").select(
            *_SITE, page_key(F.col("url")).alias("page"), F.col("follow").alias("bits")
        )
        # at most one number for each folder
        opened = [r[0] for r in to_read.select(bucket_of(F.col("page"), folders)).distinct().collect()]
        if not opened:
            break
        depth += 1
        link, bits = F.col("link"), F.col("bits")
        follow = link["follow"] & on_host(link["url"], F.col("host"))
        found = (
            to_read.join(graph.filter(F.col("folder").isin(opened)), "page")
            .select(*_SITE, "bits", F.explode("links").alias("link"))
            .filter(F.contains(F.col("link.url"), F.col("netloc")))
            .groupBy(*_SITE, F.col("link.url").alias("url"))
            .agg(
                F.bit_or(F.when(link["emit"], bits).otherwise(0)).alias("reach"),
                F.bit_or(F.when(follow, bits).otherwise(0)).alias("follow"),
            )
        )
        # Seeds are followed from the start, but returned as links only where one leads back to them.
        seen = _rounds(spark, root, rounds, fields)
        reach_seen = F.col("reach") if emit_seed else F.when(F.col("depth") > 0, F.col("reach")).otherwise(0)
        seen = (
            seen.join(found.select(*keys), keys, "left_semi")
            .groupBy(*keys)
            .agg(F.bit_or(reach_seen).alias("_reach"), F.bit_or("follow").alias("_follow"))
        )

        def unseen(name: str) -> Column:
            return F.col(name).bitwiseAND(F.bitwise_not(F.coalesce(f"_{name}", F.lit(0).cast("bigint"))))

        new = found.join(seen, keys, "left").select(*keys, unseen("reach").alias("reach"), unseen("follow").alias("follow"))
        # The depth is in the folder name only: every round then runs the same compiled code.
        rounds.append(f"{root}/rounds/depth={depth}")
        frontier = materialize(new.filter("reach <> 0 OR follow <> 0").select(*fields.names), rounds[-1])

    first = 0 if emit_seed else 1
    rows = _rounds(spark, root, rounds, fields).filter((F.col("depth") >= first) & (F.col("reach") != 0))
    same = (rows.word == numbered.word) & rows.netloc.eqNullSafe(numbered.netloc) & rows.host.eqNullSafe(numbered.host)
    return (
        rows.join(numbered, same & (rows.reach.bitwiseAND(bit) != 0))
        .select(F.col("seed_url").alias(seed), rows.url.alias("url"), "depth")
    )


def _numbered(
    seeds: DataFrame, seed: str, netloc: Column | None, allowed_host: Column | None, path: str
) -> DataFrame:
    """Seeds by site, each with its word and bit: its place among the sorted seeds of a partition."""
    own = netloc_of(F.col(f"`{seed}`"))
    sites = seeds.select(
        F.col(f"`{seed}`").alias("seed_url"),
        (own if netloc is None else netloc).alias("netloc"),
        F.lower(host_of(own) if allowed_host is None else allowed_host).alias("host"),
        clean_url(F.col(f"`{seed}`")).alias("url"),
    ).distinct()
    keys = ["netloc", "host", "seed_url"]
    place = F.monotonically_increasing_id()  # the partition above 33 bits, the row below
    ordered = sites.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(
        ordered.select(
            "*",
            F.floor(place / SEEDS_A_WORD).cast("bigint").alias("word"),
            (place % SEEDS_A_WORD).cast("int").alias("bit"),
        ),
        path,
    )


def _graph(pages: DataFrame, url: str, html: str, unwanted, extensions, options) -> DataFrame:
    """(page, links): each page's links as array<struct(url, follow, emit)>."""

    def entries(links: str, emit: bool) -> Column:
        # a link that is only followed is not kept for the sake of one that may not be
        return F.transform(
            links,
            lambda link: F.struct(
                link["url"].alias("url"),
                (F.lit(False) if emit else may_follow(link["raw"], unwanted, extensions)).alias("follow"),
                F.lit(emit).alias("emit"),
            ),
        )

    read = page_links(
        pages.select(F.col(f"`{url}`").alias("_page"), F.col(f"`{html}`").alias("_html")),
        "_page", "_html", unwanted=unwanted, extensions=extensions, followed=True, **options,
    )
    followed = F.filter(entries("followed", False), lambda link: link["follow"])
    return read.select(
        page_key(F.col("_page")).alias("page"),
        F.array_distinct(F.concat(entries("links", True), followed)).alias("links"),
    )


def _in_folders(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written in folders by their column ``folder``, and read back."""
    rows.hint("rebalance", "folder").write.mode("overwrite").partitionBy("folder").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _rounds(spark: SparkSession, root: str, rounds: Sequence[str], fields: T.StructType) -> DataFrame:
    """All rounds so far, with their ``depth``."""
    schema = T.StructType([*fields, T.StructField("depth", T.IntegerType())])
    reader = spark.read.schema(schema).option("basePath", f"{root}/rounds")
    return reader.parquet(f"{root}/rounds/depth=0", *rounds)
