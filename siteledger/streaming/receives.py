"""Receives counted by the stream itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from siteledger.operators.dedupe import latest_per_key
from siteledger.operators.records import RECORD_KEYS
from siteledger.streaming.events import MAX_RECEIVES
from siteledger.streaming.state import run_available, upsert_latest

#: How long after the newest message sent an older one may still arrive; a queue keeps none longer.
LONGEST_DELAY = "14 days"


def count_receives(stream: DataFrame, delay: str = LONGEST_DELAY) -> DataFrame:
    """Messages with ``receives``, how often each has arrived so far, in all micro-batches.

    ``stream`` comes from ``stream_events(..., sent_at=True)``. A message is told by its id, or else by its body, and by
    the time it was sent, which stays the same when it is delivered again. Counts are kept in the state store until the
    watermark, ``delay`` behind the newest message sent, has passed that time; a message older than that is one the queue no
    longer holds, and is dropped (the query's progress counts such rows). One whose event does not tell when it was sent
    cannot expire: it is counted for good.
    """
    identity = F.coalesce("message_id", F.sha2(F.coalesce("body", F.lit("")), 256))
    names = [c for c in stream.columns if c != "sent_at"]
    return (
        stream.withColumn("message_key", identity)
        .withWatermark("sent_at", delay)
        .groupBy("message_key", "sent_at")
        .agg(F.count("*").alias("receives"), F.first(F.struct(*[F.col(f"`{c}`") for c in names])).alias("_message"))
        .select("message_key", "receives", "_message.*")
    )


def consume_counted(
    stream: DataFrame,
    table_path: str,
    dead_letter_path: str,
    checkpoint: str,
    keys: Sequence[str] = RECORD_KEYS,
    ts: str | Sequence[str] = "scan_ts",
    date: str = "scan_date",
    to_records: Callable[[DataFrame], DataFrame] | None = None,
    max_receives: int = MAX_RECEIVES,
    delay: str = LONGEST_DELAY,
) -> StreamingQuery:
    """Take in each message once, and put it aside when it arrives more than ``max_receives`` times.

    Neither the message's own count nor the cut into micro-batches matters: a message that can be read is in the
    table from its first receive on, later receives lose against it, and the one beyond the limit makes it a dead letter as
    well. One that cannot be read is a dead letter at once. ``read_counted`` shows each dead letter with its last count.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            poison = kept.filter(F.col("bad") | (F.col("receives") > max_receives)).select(
                "message_key", "message_id", F.col("receives").alias("receive_count"), "body", F.current_date().alias("ingest_date")
            )
            poison.write.mode("overwrite").partitionBy("ingest_date").parquet(f"{dead_letter_path}/batch={batch_id}")
            good = kept.filter(~F.col("bad")).drop("bad", "body", "receives", "message_key")
            upsert_latest(good if to_records is None else to_records(good), table_path, batch_id, keys, ts, date)
        finally:
            kept.unpersist()

    return run_available(count_receives(stream, delay), checkpoint, on_batch, mode="update")


def read_counted(spark: SparkSession, dead_letter_path: str) -> DataFrame:
    """Dead letters of ``consume_counted``, one row a message: the day and count of its last receive."""
    rows = spark.read.option("basePath", dead_letter_path).parquet(f"{dead_letter_path}/batch=*")
    return latest_per_key(rows, ["message_key"], ["receive_count", "batch"]).drop("batch")
