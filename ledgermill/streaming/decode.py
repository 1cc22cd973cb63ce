"""Decoding and routing of the mixed event topic. Works on streams and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.schemas import CORRUPT, EVENT, EVENT_COLUMNS, EVENT_TIME_FORMAT

CARD = "CARD_TRANSACTION"


def decode(messages: DataFrame) -> DataFrame:
    """``value`` to typed columns; text that is no JSON keeps its raw form.

    The parsed struct is unpacked by ``inline``: a filter on its fields is not
    pushed below a generator, so each message is parsed once however many
    fields the filter reads.
    """
    schema = T.StructType([*EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": CORRUPT}
    )
    return (
        messages.select(F.inline(F.array(parsed)))
        .withColumn("event_time", F.try_to_timestamp("timestamp", F.lit(EVENT_TIME_FORMAT)))
    )


def with_route(events: DataFrame) -> DataFrame:
    """Name the typed stream of each event, or ``QUARANTINE``.

    An unknown type, unreadable JSON or an unreadable time is quarantined; an
    event with no type but a transaction id is a card event.
    """
    kind = F.coalesce(
        F.col("event_type"), F.when(F.col("transaction_id").isNotNull(), F.lit(CARD))
    )
    known = kind.isin(*EVENT_COLUMNS)
    readable = F.col(CORRUPT).isNull() & F.col("event_time").isNotNull()
    return events.withColumn("route", F.when(known & readable, kind).otherwise("QUARANTINE"))


def typed_events(events: DataFrame, event_type: str) -> DataFrame:
    """One typed stream with only its own columns."""
    return (
        with_route(events)
        .filter(F.col("route") == event_type)
        .select(*EVENT_COLUMNS[event_type])
    )


def quarantined_events(events: DataFrame) -> DataFrame:
    return with_route(events).filter(F.col("route") == "QUARANTINE").drop("route")


def route_summary(events: DataFrame) -> DataFrame:
    """Events per route."""
    return with_route(events).groupBy("route").agg(F.count(F.lit(1)).alias("event_count"))
