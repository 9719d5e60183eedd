"""Queue events as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siteledger import schemas
from siteledger.operators.events import from_events
from siteledger.operators.records import DEAD_LETTER_RETENTION_DAYS, retain

MAX_RECEIVES = 2


def stream_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.MESSAGE,
    one_per_file: bool = True,
    max_files: int | None = None,
    sent_at: bool = False,
) -> DataFrame:
    """Messages of the event files arriving in a folder, good and bad, as a stream; with
    ``sent_at`` also when each was sent."""
    reader = spark.readStream.format("text").option("wholetext", one_per_file)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return from_events(reader.load(path), schema, sent_at=sent_at)


def is_poison(max_receives: int = MAX_RECEIVES) -> Column:
    """A message that cannot be read, or that was received too often."""
    return F.col("bad") | (F.coalesce("receive_count", F.lit(0)) > max_receives)


def route_bad_messages(
    batch: DataFrame,
    dead_letter_path: str,
    batch_id: int,
    as_of: Column | None = None,
    max_receives: int = MAX_RECEIVES,
) -> DataFrame:
    """Put poison messages aside with their day of arrival and return the others.

    Each micro-batch owns one folder of the dead-letter table and replaces it when it runs
    again, so a retry adds nothing twice.
    """
    poison = batch.filter(is_poison(max_receives)).select(
        "message_id",
        "receive_count",
        "body",
        (F.current_date() if as_of is None else as_of.cast("date")).alias("ingest_date"),
    )
    poison.write.mode("overwrite").partitionBy("ingest_date").parquet(
        f"{dead_letter_path}/batch={batch_id}"
    )
    return batch.filter(~is_poison(max_receives)).drop("bad", "body")


def read_dead_letters(
    spark: SparkSession,
    dead_letter_path: str,
    as_of: Column,
    days: int = DEAD_LETTER_RETENTION_DAYS,
) -> DataFrame:
    """Messages put aside in the last ``days`` days; older folders are not read."""
    letters = spark.read.option("basePath", dead_letter_path).parquet(
        f"{dead_letter_path}/batch=*"
    )
    return retain(letters, "ingest_date", as_of, days).drop("batch")
