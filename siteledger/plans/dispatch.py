"""Dispatch: inventory to batches of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siteledger import schemas
from siteledger.functions.messages import message_body
from siteledger.functions.text import strip
from siteledger.operators.batching import batch_rows
from siteledger.operators.filters import EXECUTIVE
from siteledger.sources.lists import ORDER

BATCH_SIZE = 10


def dispatch(
    inventory: DataFrame, n: int = BATCH_SIZE, domain_type: str | None = EXECUTIVE
) -> DataFrame:
    """Batches of ``n`` inventory rows in file order, as messages. The type filter runs after
    the batches are cut; None sends every row."""
    columns = [c for c in schemas.INVENTORY.names if c in inventory.columns]
    where = None if domain_type is None else strip(F.col("`Domain Type`")) == domain_type
    return batch_rows(inventory, n, ORDER, message_body(columns), where)
