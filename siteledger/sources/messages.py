"""Message files: batches and events as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_batches(batches: DataFrame, path: str) -> None:
    """One line per batch: ``{"Entries": [{"Id": ..., "MessageBody": ...}, ...]}``."""
    batches.select(F.to_json(F.struct(F.col("entries").alias("Entries"))).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def batches_to_events(batches: DataFrame) -> DataFrame:
    """The queue's side of a send: one event text per message, as a consumer receives it."""
    entry = F.explode("entries").alias("entry")
    record = F.struct(
        F.concat_ws("-", F.col("batch_id").cast("string"), F.col("entry.Id")).alias("messageId"),
        F.col("entry.MessageBody").alias("body"),
        F.create_map(F.lit("ApproximateReceiveCount"), F.lit("1")).alias("attributes"),
    )
    return batches.select("batch_id", entry).select(
        F.to_json(F.struct(F.array(record).alias("Records"))).alias("value")
    )


def read_events(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Event texts, one per line or one per file, as column ``value``."""
    return spark.read.text(path, wholetext=one_per_file, recursiveFileLookup=True)
