"""Keep-first and latest-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _tie_breakers(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Every further orderable column, so that the choice among ties never depends on the
    number of partitions or on a repeated task."""
    return [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in used and _orderable(f.dataType)
    ]


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark turns "row_number() = 1" into a group limit before the shuffle: each input
    # partition sends at most one row per key, however many rows a hot key has.
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        *order, *_tie_breakers(df, keys)
    )
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order_by``. NULL keys are equal to each other."""
    return _first(df, keys, [F.col(f"`{o}`") if isinstance(o, str) else o for o in order_by])


def keep_first_except(
    df: DataFrame,
    column: str | Sequence[str],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """Keep-first on all columns but ``column`` and the plain columns of ``order_by``."""
    left_out = {column} if isinstance(column, str) else set(column)
    left_out |= {o for o in order_by if isinstance(o, str)}
    return keep_first(df, [c for c in df.columns if c not in left_out], order_by)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str | Sequence[str]
) -> DataFrame:
    """One row per key: the one written last. ``ts`` lists the order columns, newest first."""
    columns = [ts] if isinstance(ts, str) else list(ts)
    return _first(df, keys, [F.col(f"`{c}`").desc_nulls_last() for c in columns])
