"""Keyed state in folders by key, of which a batch rewrites those it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siteledger.operators.dedupe import latest_per_key
from siteledger.operators.records import RECORD_KEYS, RECORD_RETENTION_DAYS, retain
from siteledger.sources.versions import commit, pinned, versions

#: Folders of a state table. A table keeps the number it was begun with.
FOLDERS = 64


def _folder(keys: Sequence[str], folders: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(folders)).cast("int")


def upsert_folders(
    batch: DataFrame,
    table_path: str,
    batch_id: int,
    schema: T.StructType,
    keys: Sequence[str] = RECORD_KEYS,
    ts: str | Sequence[str] = "scan_ts",
    folders: int = FOLDERS,
) -> None:
    """Bring a micro-batch's last record per key into the state.

    Keys live in folders by their hash. The batch is put together with the folders of its own keys, the
    last record per key goes to new folders, and a version, one per batch, then names for each
    part of the keys the folder it is in. Other folders are neither read nor written, no folder is ever
    changed, and readers see a batch as a whole or not at all. A batch that runs again finds its version and
    leaves it; one that failed before is written anew.

    What a batch costs is the state of the folders it touches: more folders suit small batches and large states.
    """
    spark = batch.sparkSession
    if batch_id in versions(spark, table_path):
        return
    _, current = pinned(spark, table_path)
    rows = batch.select(*schema.names, _folder(keys, folders).alias("key_folder"))
    touched = sorted(r[0] for r in rows.select("key_folder").distinct().collect())  # a number a folder at most
    old = [current[str(k)] for k in touched if str(k) in current]
    if old:
        before = spark.read.schema(schema).parquet(*old).select(*schema.names, _folder(keys, folders).alias("key_folder"))
        rows = rows.unionByName(before)
    data = f"{table_path}/data/batch={batch_id}"
    latest_per_key(rows, keys, ts).hint("rebalance", "key_folder").write.mode("overwrite").partitionBy("key_folder").parquet(data)
    commit(spark, table_path, batch_id, {**current, **{str(k): f"{data}/key_folder={k}" for k in touched}})


def read_folders(
    spark: SparkSession,
    table_path: str,
    schema: T.StructType,
    date: str = "scan_date",
    as_of: Column | None = None,
    days: int = RECORD_RETENTION_DAYS,
    version: int | None = None,
) -> DataFrame:
    """The state after a batch, by default the newest: one folder for each part of the keys, however many
    batches there were, and nothing left to put together. ``as_of`` leaves out what is no longer retained."""
    _, current = pinned(spark, table_path, version)
    if not current:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*sorted(current.values())).select(*schema.names)
    return rows if as_of is None else retain(rows, date, as_of, days)
