"""Parsing of raw events; the same expressions run on a stream and on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas


def parse_events(raw: DataFrame) -> DataFrame:
    """Declared event fields from the JSON text in ``value``.

    Broken JSON becomes a row of nulls and a bad timestamp becomes null, so no
    event stops the stream and none is lost.
    """
    event = F.from_json(F.col("value").cast("string"), schemas.EVENT_FIELDS)
    fields = raw.select(event.alias("event")).select("event.*")
    return fields.withColumn("timestamp", F.try_to_timestamp("timestamp"))


# Why an event has a dead letter.
NO_TEXT, NOT_JSON, NOT_AN_EVENT = "NO_TEXT", "NOT_JSON", "NOT_AN_EVENT"
BAD_FIELD, BAD_TIMESTAMP, BAD_AMOUNT = "BAD_FIELD", "BAD_TIMESTAMP", "AMOUNT_OUT_OF_RANGE"
_TEXT, _CORRUPT = "value", "_corrupt_record"


def judged_events(raw: DataFrame) -> DataFrame:
    """The events of :func:`parse_events` with their text in ``value``, and a ``reason`` where the text says more.

    The reason is the first that holds: no text, no JSON, no object, a field of
    another type, a timestamp that cannot be read, an amount that the landing
    table cannot hold. The JSON is parsed a second time only where the first
    time something was left over.
    """
    event = F.from_json(F.col(_TEXT).cast("string"), f"{schemas.EVENT_FIELDS}, {_CORRUPT} string")
    rows = raw.select(F.col(_TEXT).cast("string").alias(_TEXT), event.alias("event"))
    at = F.try_to_timestamp("event.timestamp")
    tree = F.try_parse_json(_TEXT)
    unread = F.when(tree.isNull(), NOT_JSON).when(
        ~F.schema_of_variant(tree).startswith("OBJECT"), NOT_AN_EVENT).otherwise(BAD_FIELD)
    reason = F.when(F.coalesce(F.trim(_TEXT), F.lit("")) == "", NO_TEXT).when(F.col(f"event.{_CORRUPT}").isNotNull(), unread)
    reason = reason.when(F.col("event.timestamp").isNotNull() & at.isNull(), BAD_TIMESTAMP)
    amount = F.col("event.base_amount")
    reason = reason.when(amount.isNotNull() & amount.try_cast("decimal(18,2)").isNull(), BAD_AMOUNT)
    names = [n for n in T.StructType.fromDDL(schemas.EVENT_FIELDS).names if n != "timestamp"]
    return rows.select(*[F.col(f"event.{n}").alias(n) for n in names], at.alias("timestamp"), _TEXT, reason.alias("reason"))


def landing_rows(events: DataFrame) -> DataFrame:
    """Parsed events in the shape of the landing table, amounts as money.

    An amount too large for the column becomes null: an error here would stop
    the stream at the same event after every restart.
    """
    amount = F.col("base_amount").try_cast("decimal(18,2)")
    return schemas.conform(
        events.withColumn("base_amount", amount), "public.realtime_transactions"
    )
