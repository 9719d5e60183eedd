"""Split hosts into subdomain, registrable domain and public suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siteledger import schemas
from siteledger.functions.punycode import written_host
from siteledger.functions.text import clean_host_text
from siteledger.functions.urls import host_of
from siteledger.operators.explode import with_fields

KINDS = ("plain", "wildcard", "exception")

# Fixed values: (suffix, kind) rows that cover the inventories this library is built for.
# Pass a full published list, read with sources.suffixes.read_suffixes, for other sites.
DEFAULT_SUFFIXES = [
    ("gov", "plain"),
    ("mil", "plain"),
    ("us", "plain"),
    ("fed.us", "plain"),
    ("nsn.us", "plain"),
    ("pr", "plain"),
    ("gov.pr", "plain"),
    ("com", "plain"),
    ("org", "plain"),
    ("net", "plain"),
    ("edu", "plain"),
    ("int", "plain"),
]

_IPV4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"


def default_suffixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_SUFFIXES, schemas.SUFFIX)


_LABELS = "length(_host) - length(replace(_host, '.', '')) + 1"


def _match(df: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Add ``_n``, the number of suffix labels of ``_host``: join the tails of the distinct hosts.

    Distinct hosts and suffixes are all that moves besides the rows' own hosts; Spark
    broadcasts whichever side its size allows. Both meet in their written form, so that an ``xn--``
    host finds a suffix in any script and the other way round; a label stays one label.
    """
    tails = df.select("_host").distinct().select(
        "_host",
        F.expr(_LABELS).alias("_labels"),
        written_host(F.col("_host")).alias("_written"),
    ).select(
        "_host", "_labels", "_written", F.explode(F.expr("sequence(_labels, 1, -1)")).alias("_k")
    ).withColumn("_tail", F.expr("substring_index(_written, '.', -_k)"))
    unknown = F.raise_error(F.concat(F.lit("unknown kind of suffix: "), F.col("kind")))
    kind = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(unknown.cast("string"))
    is_exception = (F.col("kind") == "exception").cast("int")
    position = F.col("_k") + (F.col("kind") == "wildcard").cast("int")
    found = (
        tails.join(suffixes.select(written_host(F.col("suffix")).alias("_tail"), kind.alias("kind")), "_tail")
        .filter(position <= F.col("_labels"))
        .groupBy("_host")
        .agg(F.max(position * 2 + is_exception).alias("_best"))
        .select("_host", F.expr("_best DIV 2 - _best % 2").cast("int").alias("_n"))
    )
    return df.join(found, "_host", "left")


def split_host(
    df: DataFrame,
    column: str,
    suffixes: DataFrame,
    names: tuple[str, str, str] = ("subdomain", "domain", "tld"),
) -> DataFrame:
    """Add subdomain, domain and tld of the host or URL in ``column``.

    ``suffixes`` holds (suffix, kind) rows with kind ``plain``, ``wildcard`` (``ck`` stands
    for ``*.ck``) or ``exception``. The longest matching tail wins and an exception beats a
    wildcard. A bare suffix has an empty domain; an unknown suffix is an empty tld with the
    last label as domain; an IP address is its own domain. Any other kind is an error.
    """
    hosts = df.withColumn("_host", host_of(clean_host_text(F.col(f"`{column}`"))))
    matched = _match(hosts, suffixes)

    host = F.col("_host")
    address = host.rlike(_IPV4) | host.startswith("[")
    parts = matched.withColumn(
        "_tld",
        F.when(address | F.coalesce(F.col("_n"), F.lit(0)).eqNullSafe(0), F.lit("")).otherwise(
            F.expr("substring_index(_host, '.', -_n)")
        ),
    ).withColumn(
        "_front", F.expr("left(_host, length(_host) - length(_tld) - IF(_tld = '', 0, 1))")
    )
    domain = F.when(address, host).otherwise(F.substring_index("_front", ".", -1))
    subdomain = F.expr("left(_front, greatest(length(_front) - length(_last) - 1, 0))")
    return (
        with_fields(
            parts.withColumn("_last", domain),
            {
                names[0]: subdomain,
                names[1]: F.col("_last"),
                names[2]: F.when(host.isNotNull(), F.col("_tld")),
            },
        )
        .drop("_host", "_n", "_tld", "_front", "_last")
    )
