"""Keyed record updates and snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from siteledger.operators.dedupe import latest_per_key
from siteledger.operators.records import (
    RECORD_KEYS,
    RECORD_RETENTION_DAYS,
    accessible_share,
    retain,
)
from siteledger.sources.history import append_history
from siteledger.streaming.events import route_bad_messages


def upsert_latest(
    batch: DataFrame,
    table_path: str,
    batch_id: int,
    keys: Sequence[str] = RECORD_KEYS,
    ts: str | Sequence[str] = "scan_ts",
    date: str = "scan_date",
) -> None:
    """Write a micro-batch's last record per key.

    Batches are kept side by side, in folders by batch and date, and the last record per key
    over all of them is taken on reading. A batch that runs again replaces its own folder;
    a message delivered twice loses against itself. Nothing already written is rewritten.
    """
    latest_per_key(batch, keys, ts).write.mode("overwrite").partitionBy(date).parquet(
        f"{table_path}/batch={batch_id}"
    )


def read_latest(
    spark: SparkSession,
    table_path: str,
    schema: T.StructType,
    keys: Sequence[str] = RECORD_KEYS,
    ts: str | Sequence[str] = "scan_ts",
    date: str = "scan_date",
    as_of: Column | None = None,
    days: int = RECORD_RETENTION_DAYS,
) -> DataFrame:
    """Current state of a table written by ``upsert_latest``.

    With ``as_of`` only dates still retained are read; their folders are pruned. Batches that
    ``compact_in_place`` has put together are read from there.
    """
    rows = _batches(spark, table_path, schema)
    upto = _compacted_upto(spark, table_path)
    if upto is not None:
        rows = rows.filter(F.col("batch") > upto).select(*schema.names).unionByName(
            spark.read.schema(schema).parquet(_compacted(table_path, upto)).select(*schema.names)
        )
    if as_of is not None:
        rows = retain(rows, date, as_of, days)
    return latest_per_key(rows.select(*schema.names), keys, ts)


def _batches(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    with_batch = T.StructType([*schema, T.StructField("batch", T.LongType())])
    return spark.read.schema(with_batch).option("basePath", table_path).parquet(
        f"{table_path}/batch=*"
    )


def _compacted(table_path: str, upto: int) -> str:
    return f"{table_path}/compacted/upto={upto}"


def _compacted_upto(spark: SparkSession, table_path: str) -> int | None:
    """The last batch of the newest complete compaction; None without one."""
    try:
        versions = spark.read.schema("upto bigint").json(f"{table_path}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return versions.agg(F.max("upto")).first()[0]


def compact_in_place(
    spark: SparkSession,
    table_path: str,
    schema: T.StructType,
    keys: Sequence[str] = RECORD_KEYS,
    ts: str | Sequence[str] = "scan_ts",
    date: str = "scan_date",
    upto: int | None = None,
    **retention,
) -> int | None:
    """Put the batches up to ``upto`` together, while further ones may arrive; returns ``upto``.

    By default all batches but the newest, which may still be written or run again. Their state is
    written beside them, and only then a version names it: readers see either all of it or none,
    and a compaction that failed is written anew. Batches named by a version are not read
    any more and may be deleted once no reader is left that began before it.
    """
    rows = _batches(spark, table_path, schema)
    if upto is None:
        newest = rows.agg(F.max("batch")).first()[0]
        upto = -1 if newest is None else newest - 1
    before = _compacted_upto(spark, table_path)
    if upto <= (-1 if before is None else before):
        return before
    rows = rows.filter(F.col("batch") <= upto)
    if before is not None:
        old = spark.read.schema(schema).parquet(_compacted(table_path, before))
        rows = rows.filter(F.col("batch") > before).select(*schema.names).unionByName(old)
    if retention:
        rows = retain(rows, date, **retention)
    latest_per_key(rows.select(*schema.names), keys, ts).hint("rebalance", date).write.mode(
        "overwrite"
    ).partitionBy(date).parquet(_compacted(table_path, upto))
    spark.range(1).select(F.lit(upto).alias("upto")).write.mode("append").json(
        f"{table_path}/versions"
    )
    return upto


def compact(
    spark: SparkSession,
    table_path: str,
    new_path: str,
    schema: T.StructType,
    keys: Sequence[str] = RECORD_KEYS,
    ts: str | Sequence[str] = "scan_ts",
    date: str = "scan_date",
    **retention,
) -> None:
    """Write the current state as the first batch of a new table."""
    state = read_latest(spark, table_path, schema, keys, ts, date, **retention)
    state.hint("rebalance", date).write.mode("overwrite").partitionBy(date).parquet(
        f"{new_path}/batch=-1"
    )


def run_available(
    stream: DataFrame,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> StreamingQuery:
    """Process everything that has arrived so far, then stop."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def consume(
    stream: DataFrame,
    table_path: str,
    dead_letter_path: str,
    checkpoint: str,
    keys: Sequence[str] = RECORD_KEYS,
    ts: str | Sequence[str] = "scan_ts",
    date: str = "scan_date",
    to_records: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Take in every message that has arrived, once.

    Poison messages go to the dead letters, the others, turned to records by
    ``to_records``, to the table of the last record per key. A micro-batch is kept while it
    is used twice, so that its files are read and parsed one time.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = route_bad_messages(kept, dead_letter_path, batch_id)
            rows = good if to_records is None else to_records(good)
            upsert_latest(rows, table_path, batch_id, keys, ts, date)
        finally:
            kept.unpersist()

    return run_available(stream, checkpoint, on_batch)


def snapshot(
    spark: SparkSession,
    table_path: str,
    schema: T.StructType,
    history_path: str,
    as_of: Column,
    upsert: bool = True,
    count: Column | None = None,
    **state,
) -> DataFrame:
    """T4: share of the records retained as of a date, added to the history."""
    share = accessible_share(
        read_latest(spark, table_path, schema, as_of=as_of, **state), count=count
    )
    append_history(share, as_of, history_path, upsert=upsert)
    return share
