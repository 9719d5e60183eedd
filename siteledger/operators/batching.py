"""Consecutive batches over a distributed row index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siteledger.session import materialize, scratch_path

_ROW_BITS = (1 << 33) - 1


def with_row_index(
    df: DataFrame, order_by: Sequence[str], index: str = "row_index"
) -> DataFrame:
    """Add the position of each row in the order of ``order_by``, from 0.

    Rows are range partitioned and sorted; a row's index is its position within its
    partition plus the number of rows in the partitions before. The sorted rows are written
    once, so that both passes see the same partitions even if an executor is lost between
    them. The remaining columns break ties, which also lets a hot value of ``order_by``
    spread over several partitions. The only thing ever in one place is one count per
    partition.
    """
    keys = [F.col(f"`{c}`") for c in order_by]
    keys += [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in order_by and f.dataType.typeName() not in ("map", "variant")
    ]
    keys.append(F.monotonically_increasing_id())
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys[:-1])
    placed = materialize(
        sorted_rows.select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_pos"),
        ),
        scratch_path(df.sparkSession, "row_index"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # One row per partition of the sort: bounded by the partition count, not by the data.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(index, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )


def batch_rows(
    df: DataFrame,
    n: int,
    order_by: Sequence[str],
    value: Column,
    where: Column | None = None,
) -> DataFrame:
    """``(batch_id, entries)``: batches of ``n`` consecutive rows.

    Batches are cut before ``where`` is applied, so they may hold fewer than ``n`` entries,
    and a batch with no entry left is dropped. Each entry is struct(Id, MessageBody) with
    ``Id`` the position among the batch's kept entries. A NULL or empty body is dropped.
    """
    indexed = with_row_index(
        df.select(
            *order_by,
            value.cast("string").alias("_body"),
            (F.lit(True) if where is None else F.coalesce(where, F.lit(False))).alias("_keep"),
        ),
        order_by,
    )
    entries = F.transform(
        F.sort_array(F.collect_list(F.struct("row_index", "_body"))),
        lambda e, i: F.struct(
            i.cast("string").alias("Id"), e["_body"].alias("MessageBody")
        ),
    )
    return (
        indexed.filter("_keep AND _body IS NOT NULL AND _body <> ''")
        .groupBy(F.expr(f"row_index DIV {int(n)}").alias("batch_id"))
        .agg(entries.alias("entries"))
    )
