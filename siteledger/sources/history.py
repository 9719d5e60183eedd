"""History of the accessible share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siteledger import schemas


def append_history(share: DataFrame, as_of: Column, path: str, upsert: bool = False) -> None:
    """Add the share as of a date; the table is created when absent.

    A date may be added twice; ``upsert`` replaces the rows of the date instead, which makes
    a repeated run harmless. A NULL share (no records) adds nothing.
    """
    rows = share.filter("accessible_share IS NOT NULL").select(
        as_of.cast("date").alias("snapshot_date"), "accessible_share"
    )
    writer = rows.write.partitionBy("snapshot_date")
    if upsert:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history table; empty when nothing was ever added."""
    try:
        return spark.read.schema(schemas.HISTORY).parquet(path).select(*schemas.HISTORY.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.HISTORY)


def read_history_file(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document of one-entry maps ``{date: share}``."""
    entries = F.from_json(F.col("value"), schemas.HISTORY_FILE)
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(entries).alias("entry"))
        .select(F.explode("entry").alias("date", "accessible_share"))
        .select(F.col("date").cast("date").alias("snapshot_date"), "accessible_share")
    )


def write_history_file(history: DataFrame, path: str) -> None:
    """The history as one JSON document, oldest first; it has one entry per snapshot."""
    rows = F.sort_array(F.collect_list(F.struct("snapshot_date", "accessible_share")))
    document = F.to_json(
        F.transform(
            rows,
            lambda r: F.create_map(
                F.date_format(r["snapshot_date"], "yyyy-MM-dd"), r["accessible_share"]
            ),
        )
    )
    history.agg(document.alias("value")).write.mode("overwrite").text(path)
