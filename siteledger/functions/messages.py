"""Message and record expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from siteledger import schemas
from siteledger.functions.urls import let


def message_body(columns: Sequence[str]) -> Column:
    """JSON object of the named columns; missing values stay as JSON ``null``."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})


_RESULT = f"documentTitle string, issues string, {schemas.CORRUPT} string"


def scan_result(issues_json: Column) -> Column:
    """P20: struct(documentTitle, issues) of a JSON text, ``issues`` as the text of the inner list.

    NULL when the text itself is missing or is no JSON object (X8). The text is read once.
    """
    parsed = F.from_json(
        issues_json, _RESULT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    )
    return let(parsed, lambda r: F.when(r.isNotNull() & r[schemas.CORRUPT].isNull(), r))


def list_length(issues: Column) -> Column:
    """P20: length of the inner list of a readable result; a missing one counts as 0."""
    return F.coalesce(F.json_array_length(issues), F.lit(0))


def issue_count(issues_json: Column) -> Column:
    """P20: length of ``issues`` inside a JSON text; a missing inner list counts as 0.

    NULL when the text itself is missing or is no JSON object (X8).
    """
    return let(
        scan_result(issues_json), lambda r: F.when(r.isNotNull(), list_length(r["issues"]))
    )


def count_text(issues: Column) -> Column:
    """Number of issues, as the text the stored record holds."""
    return F.size(issues).cast("string")


def date_text(date: Column) -> Column:
    """``yyyy-MM-dd``."""
    return F.date_format(date, "yyyy-MM-dd")
