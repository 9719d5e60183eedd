"""Compute expensive expressions once per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def with_fields(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Add or replace columns that are computed exactly once per row, whatever is done with them later.

    A filter on a projected column is moved below the projection and computes the column
    again. A generator of one struct is not crossed by such filters.
    """
    row = F.struct(*[c.alias(name) for name, c in fields.items()])
    rest = [F.col(f"`{c}`") for c in df.columns if c not in fields]
    return df.select(*rest, F.inline_outer(F.array(row)).alias(*fields))


def explode_kept(
    df: DataFrame, keep: Sequence[str | Column], array: Column, name: str
) -> DataFrame:
    """One row per element of ``array``, as column ``name``.

    A plain explode lets the planner infer a filter ``size(array) > 0`` below it, which would
    compute the array twice per row. The outer form with a later filter computes it once.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(
        F.col(name).isNotNull()
    )
