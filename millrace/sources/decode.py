"""Messages to events: envelope, times, and what is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import PAYLOAD, TEXT_FIELDS

#: An instant says its zone; without one it is no instant.
ZONED = r"(Z|[+-]\d{2}(:?\d{2})?)$"


def event_ms(received: Column, text: str = "event_timestamp") -> Column:
    """Epoch ms of an ISO instant; of text that is none, the time of arrival."""
    parsed = F.when(F.col(text).rlike(ZONED), F.unix_millis(F.try_to_timestamp(F.col(text))))
    return F.coalesce(parsed, received)


def decode(messages: DataFrame) -> DataFrame:
    """Events of (value, received, seq): JSON text, epoch ms of arrival, order of arrival.

    A message may hold the event itself or an object ``event`` that holds it; fields
    that aren't known are ignored.  Null, empty and broken messages, an ``event``
    that is null, and events without a pipeline are dropped.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(
        F.from_json(text, f"event struct<{', '.join(f'{k}:string' for k in TEXT_FIELDS)}>, {PAYLOAD}").alias("m"),
        F.coalesce(F.array_contains(F.json_object_keys(F.when(F.trim(text).startswith("{"), text)), "event"), F.lit(False)).alias("wrapped"), "received", "seq",
    )
    fields = [F.when(F.col("wrapped"), F.col(f"m.event.{k}")).otherwise(F.col(f"m.{k}")).alias(k) for k in TEXT_FIELDS]
    events = parsed.select(*fields, "received", "seq").where("pipeline_id IS NOT NULL")
    return events.select(*TEXT_FIELDS, event_ms(F.col("received")).alias("ts"), "received", "seq")
