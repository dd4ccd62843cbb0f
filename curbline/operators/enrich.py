"""JSON messages to validated events with calendar columns; batch and streaming alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import clock
from curbline.operators.once import unpack_once
from curbline.schema import (
    EVENT_COLUMNS,
    EVENT_SCHEMA,
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    SOURCE_ZONE,
    STAGING_COLUMNS,
)


def decode_events(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields of the JSON in ``value`` (text or bytes); what cannot be read is null."""
    return unpack_once(messages, F.from_json(F.col("value").cast("string"), EVENT_SCHEMA), keep)


def _valid_fields() -> Column:
    """All conditions but that on the time; a base of blanks only passes: it is the producer that trims."""
    return (
        F.col("trip_id").isNotNull()
        & F.col("pickup_latitude").between(*LATITUDE_RANGE)
        & F.col("pickup_longitude").between(*LONGITUDE_RANGE)
        & F.col("base").isNotNull()
        & (F.col("base") != "")
    )


def is_valid_event() -> Column:
    return _valid_fields() & F.col("event_timestamp").isNotNull()


def valid_events(events: DataFrame, zone: str = SOURCE_ZONE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wire events with the timestamp parsed to an instant, invalid ones left out.

    Only the time stands behind the fence that keeps filters from repeating its parsing; the
    other conditions come first and reach a scan.
    """
    return _timed(events.where(_valid_fields()), zone, keep).where(F.col("event_timestamp").isNotNull())


def _timed(events: DataFrame, zone: str, keep: tuple[str, ...]) -> DataFrame:
    instant = F.struct(clock.parse_instant(F.col("event_timestamp"), zone).alias("instant"))
    others = ("trip_id", "pickup_latitude", "pickup_longitude", "base", *keep)
    fields = [F.col("instant").alias(n) if n == "event_timestamp" else F.col(n) for n in EVENT_COLUMNS]
    return unpack_once(events, instant, others).select(*fields, *keep)


def marked_events(events: DataFrame, zone: str = SOURCE_ZONE, keep: tuple[str, ...] = ()) -> DataFrame:
    """All wire events, the timestamp parsed to an instant; ``is_valid`` marks those that ``valid_events`` lets through."""
    return _timed(events, zone, keep).withColumn("is_valid", F.coalesce(is_valid_event(), F.lit(False)))


def judged_messages(messages: DataFrame, zone: str = SOURCE_ZONE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every message with its event, the timestamp as an instant, and ``reason``, empty where the event is valid.

    One pass for both sides of a route; batch and streaming alike.
    """
    fields = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    decoded = unpack_once(messages.withColumn("value", F.col("value").cast("string")), fields, ("value", *keep))
    instant = clock.parse_instant(F.col("event_timestamp"), zone)
    parsed = unpack_once(decoded, F.struct(instant.alias("instant")), ("value", *EVENT_COLUMNS, *keep))
    reason = F.concat_ws(
        ", ",
        F.when(F.col("trip_id").isNull(), "no id"),
        F.when(F.col("instant").isNull(), "bad time"),
        F.when(~F.coalesce(F.col("pickup_latitude").between(*LATITUDE_RANGE), F.lit(False)), "bad latitude"),
        F.when(~F.coalesce(F.col("pickup_longitude").between(*LONGITUDE_RANGE), F.lit(False)), "bad longitude"),
        F.when(F.coalesce("base", F.lit("")) == "", "no base"),
    )
    events = [F.col("instant").alias(n) if n == "event_timestamp" else F.col(n) for n in EVENT_COLUMNS]
    return parsed.select("value", *events, *keep, reason.alias("reason"))


def rejected_messages(messages: DataFrame, zone: str = SOURCE_ZONE) -> DataFrame:
    """``value`` and ``reason`` of each message that ``transform_messages`` leaves out."""
    return judged_messages(messages, zone).where("reason != ''").select("value", "reason")


def add_calendar(events: DataFrame, zone: str = SOURCE_ZONE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Date, hour and ISO weekday of the pickup on the clocks of ``zone``."""
    local = F.col("local_time")
    return (
        events.withColumn("local_time", clock.instant_to_local(F.col("event_timestamp"), zone))
        .withColumn("trip_date", F.to_date(local))
        .withColumn("pickup_hour", F.hour(local))
        .withColumn("day_of_week", clock.iso_weekday(local))
        .select(*STAGING_COLUMNS, *keep)
    )


def arrival_of(messages: DataFrame) -> DataFrame:
    """Adds ``arrival``: when and where a message came in, as far as the source tells.

    A bus gives time, partition and offset; a message without any has an arrival of null.
    """
    known = [c for c in ("timestamp", "partition", "offset") if c in messages.columns]
    arrival = F.struct(*known) if known else F.lit(None).cast("timestamp")
    return messages.withColumn("arrival", arrival)


def transform_messages(
    messages: DataFrame, zone: str = SOURCE_ZONE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Decode, validate, enrich; ``keep`` names columns of the messages to carry along."""
    return add_calendar(valid_events(decode_events(messages, keep), zone, keep), zone, keep)
