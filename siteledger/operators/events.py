"""Messages to and from queue events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from siteledger import schemas
from siteledger.functions.messages import message_body


def to_messages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One ``(Id, MessageBody)`` message per row; each is a send of its own, with Id 1."""
    return df.select(
        F.lit("1").alias("Id"), message_body(columns or df.columns).alias("MessageBody")
    )


def from_events(
    df: DataFrame,
    schema: T.StructType = schemas.MESSAGE,
    value: str = "value",
    sent_at: bool = False,
) -> DataFrame:
    """Decode queue events: one row per record with the message's columns, ``message_id``,
    ``receive_count``, the raw ``body`` and ``bad``.

    ``bad`` marks what cannot be processed: an event that is not JSON, one without records,
    and a body that is not a JSON object. Good and bad rows stay in one DataFrame so that
    the input is parsed once; see ``streaming.events.route_bad_messages``. ``sent_at`` adds the
    time the message was sent, or first received, which is the same whenever it is delivered.
    """
    raw = F.col(f"`{value}`")
    fields = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    records = df.select(
        raw.alias("_event"),
        F.explode_outer(F.from_json(raw, schemas.EVENT)["Records"]).alias("_record"),
    )
    body = F.col("_record.body")
    parsed = records.select(
        F.col("_record.messageId").alias("message_id"),
        F.col("_record.attributes")["ApproximateReceiveCount"]
        .try_cast("int")
        .alias("receive_count"),
        F.timestamp_millis(
            F.coalesce(
                *[
                    F.col("_record.attributes")[name].try_cast("bigint")
                    for name in ("SentTimestamp", "ApproximateFirstReceiveTimestamp")
                ]
            )
        ).alias("sent_at"),
        F.coalesce(body, F.col("_event")).alias("body"),
        body.isNull().alias("_no_body"),
        F.from_json(
            body, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
        ).alias("_message"),
    )
    bad = (
        F.col("_no_body")
        | F.col("_message").isNull()
        | F.col(f"_message.{schemas.CORRUPT}").isNotNull()
        | ~F.col("body").rlike(r"^\s*\{")
    )
    return parsed.select(
        "message_id",
        "receive_count",
        *(["sent_at"] if sent_at else []),
        "body",
        F.coalesce(bad, F.lit(True)).alias("bad"),
        *[F.col(f"_message.`{f.name}`") for f in schema.fields],
    )
