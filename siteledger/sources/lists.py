"""Registry, seed lists, suffix list and inventory files."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siteledger import schemas
from siteledger.functions.text import clean_host_text
from siteledger.operators.filters import INVENTORY_TLDS, drop_headers, has_domain, keep_tlds
from siteledger.operators.hosts import split_host

logger = logging.getLogger(__name__)

# A quote inside a quoted field is written twice, as in any spreadsheet export.
QUOTE = '"'

#: Columns that give rows their place in the input: source, start of the split, row in split.
ORDER = ("source_idx", "file_path", "file_block", "file_row")


def _with_order(df: DataFrame, source_idx: int = 0) -> DataFrame:
    """Add the place of each row. Splits of a file are read in sequence by one task each, so
    (file, split start, running number) is file order whatever the number of tasks."""
    return df.select(
        "*",
        F.lit(source_idx).alias("source_idx"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("file_row"),
    )


#: What a row holds beyond the last column of the header.
_BEYOND = "_beyond"


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Some line holds an odd number of quotes, as one does where a quoted field goes on in the next."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def _read_rows(spark: SparkSession, path: str, line_breaks: bool | None) -> DataFrame:
    """The rows of a delimited file by header name, ``_BEYOND`` where a row has too many fields.

    Files are split over tasks unless fields hold line breaks; with None a pass over the lines tells.
    """
    names = spark.read.csv(path, header=True, escape=QUOTE).columns
    fields = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BEYOND]])
    whole = has_line_breaks(spark, path) if line_breaks is None else line_breaks
    rows = spark.read.csv(path, schema=fields, header=True, escape=QUOTE, multiLine=whole, mode="PERMISSIVE")
    return _with_order(rows)


def rejected_rows(spark: SparkSession, path: str, line_breaks: bool | None = None) -> DataFrame:
    """Rows of a registry or inventory file with more fields than its header, as ``record``, with
    their place. ``read_registry`` and ``read_inventory`` leave them out; a row with fewer fields is
    no error, what it lacks is NULL."""
    rows = _read_rows(spark, path, line_breaks)
    names = [c for c in rows.columns if c not in ORDER]
    torn = rows.filter(F.col(_BEYOND).isNotNull())
    return torn.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])).alias("record"), *ORDER)


def read_registry(
    spark: SparkSession, path: str, suffixes: DataFrame, line_breaks: bool | None = None
) -> DataFrame:
    """The site registry, with host parts and row order. Other columns are ignored.

    Rows with too many fields are left out; ``rejected_rows`` has them. ``line_breaks`` says whether
    quoted fields go over several lines, which makes a file one task; by default the file is asked.
    """
    # Columns are found by name in the header, whatever their order in the file.
    raw = _read_rows(spark, path, line_breaks).filter(F.col(_BEYOND).isNull()).select(
        *[F.col(f"`{n}`") for n in schemas.REGISTRY.names], *ORDER
    )
    cleaned = raw.withColumn("Domain Name", clean_host_text(F.col("`Domain Name`")))
    return split_host(cleaned, "Domain Name", suffixes)


def _read_seed_list(spark: SparkSession, path: str, idx: int) -> DataFrame | None:
    first = T.StructType([T.StructField("site", T.StringType())])
    try:
        return _with_order(spark.read.csv(path, schema=first, header=False, escape=QUOTE), idx)
    except AnalysisException as e:
        # A list that is not there is skipped whole; one that is damaged raises.
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("seed list %s is skipped: %s", path, e.getCondition())
        return None


def read_seed_sites(
    spark: SparkSession,
    paths: Sequence[str],
    suffixes: DataFrame,
    tlds: Sequence[str] = INVENTORY_TLDS,
    compat: bool = False,
) -> DataFrame:
    """The first column of every list, as ``site`` with its host parts.

    Lists may have any number of columns. A header has no listed tld and goes with F3;
    ``compat`` also drops every real site whose name contains ``domain`` (X5).
    """
    lists = [_read_seed_list(spark, p, i) for i, p in enumerate(paths)]
    found = [df for df in lists if df is not None]
    if not found:
        raise ValueError("none of the seed lists can be read")
    sites = reduce(DataFrame.unionByName, found).withColumn(
        "site", clean_host_text(F.col("site"))
    )
    split = keep_tlds(has_domain(split_host(sites, "site", suffixes)), tlds)
    return drop_headers(split, "site") if compat else split


def read_suffixes(spark: SparkSession, path: str, private: bool = False) -> DataFrame:
    """A published suffix list: one rule per line, ``//`` comments, ``*.`` wildcards and
    ``!`` exceptions. The private section is left out unless asked for."""
    text = F.col("value")
    if not private:
        text = F.regexp_replace(text, r"(?s)// *===BEGIN PRIVATE DOMAINS===.*$", "")
    rule = F.element_at(F.split(F.col("line"), r"\s+"), 1)
    lines = spark.read.text(path, wholetext=True).select(
        F.explode(F.split(text, r"\r?\n")).alias("line")
    )
    kind = (
        F.when(rule.startswith("!"), "exception").when(rule.startswith("*."), "wildcard")
    ).otherwise("plain")
    return (
        lines.select(F.lower(clean_host_text(F.col("line"))).alias("line"))
        .filter((F.col("line") != "") & ~F.col("line").startswith("//"))
        .select(F.regexp_replace(rule, r"^(?:!|\*\.)", "").alias("suffix"), kind.alias("kind"))
        .distinct()
    )


def read_inventory(spark: SparkSession, path: str, line_breaks: bool | None = None) -> DataFrame:
    """S3: the inventory by header name, in file order; blank lines are ignored. Rows with too many
    fields are left out, and ``line_breaks`` is as in ``read_registry``."""
    raw = _read_rows(spark, path, line_breaks).filter(F.col(_BEYOND).isNull())
    names = [n for n in schemas.INVENTORY.names if n in raw.columns]
    return raw.select(*[F.col(f"`{n}`") for n in names], *ORDER)


def write_inventory(inventory: DataFrame, path: str) -> None:
    """CSV with a header."""
    columns = [F.col(f"`{n}`") for n in schemas.INVENTORY.names if n in inventory.columns]
    inventory.select(*columns).write.mode("overwrite").csv(
        path, header=True, escape=QUOTE, emptyValue="", nullValue=""
    )
