"""Session defaults and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold on any cluster size; sizes (partitions, memory) are left to the caller.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, app: str = "siteledger", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without: it takes a folder in its warehouse. On a cluster the
    executors might not see each other's files there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{scratch_root(spark)}/siteledger/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once, in folders by the named columns, and read it back.

    The written files survive lost executors, end the lineage, and give the planner true
    sizes, so that it broadcasts the result only when it is known to be small.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, path: str, key: str) -> Iterator[DataFrame]:
    """``df`` written to ``path`` in one file per bucket of ``key``, for as long as it is joined.

    Joins on ``key`` leave the table where it is. Only the catalog knows of buckets, so it gets
    an entry of an unused name that goes in the end.
    """
    spark, name = df.sparkSession, f"siteledger_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(n, key).write.format("parquet").option("path", path)
    try:
        writer.bucketBy(n, key).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
