"""Raw text rows to canonical events, and the rows that fail with their reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import clock, text
from curbline.functions.identity import trip_id
from curbline.operators.once import unpack_once
from curbline.schema import ID_PREFIX, LATITUDE_RANGE, LONGITUDE_RANGE, SOURCE_ZONE


def parse_raw(rows: DataFrame, zone: str = SOURCE_ZONE) -> DataFrame:
    """Adds the parsed fields and ``reason``, null where the row is valid."""
    texts = rows.select(
        "row_number",
        text.strip(F.col("`Date/Time`")).alias("date_text"),
        text.strip(F.col("Lat")).alias("latitude_text"),
        text.strip(F.col("Lon")).alias("longitude_text"),
        text.strip(F.col("Base")).alias("base"),
    )
    timed = texts.withColumn("local", clock.parse_slash_date_time(F.col("date_text")))
    fields = F.struct(
        "date_text",
        "latitude_text",
        "longitude_text",
        "base",
        text.number(F.col("latitude_text")).alias("pickup_latitude"),
        text.number(F.col("longitude_text")).alias("pickup_longitude"),
        clock.local_to_instant(F.col("local"), zone).alias("instant"),
    )
    parsed = unpack_once(timed, fields, ("row_number",))
    missing = (
        F.col("date_text").isNull()
        | F.col("latitude_text").isNull()
        | F.col("longitude_text").isNull()
        | F.col("base").isNull()
    )
    reason = (
        F.when(missing, "missing_field")
        .when(F.col("pickup_latitude").isNull(), "bad_latitude")
        .when(F.col("pickup_longitude").isNull(), "bad_longitude")
        .when(F.col("instant").isNull(), "bad_timestamp")
        .when(F.col("base") == "", "empty_base")
        .when(~F.col("pickup_latitude").between(*LATITUDE_RANGE), "latitude_out_of_range")
        .when(~F.col("pickup_longitude").between(*LONGITUDE_RANGE), "longitude_out_of_range")
    )
    return parsed.withColumn("reason", reason)


def canonical_events(
    rows: DataFrame,
    zone: str = SOURCE_ZONE,
    numeric_id: bool = False,
    prefix: str = ID_PREFIX,
    keep_row_number: bool = False,
) -> DataFrame:
    """Valid rows as wire events.

    The id hashes the coordinates as written in the source, or with ``numeric_id`` as the
    shortest text of the parsed numbers; the two differ for text such as ``40.7690``.
    """
    valid = parse_raw(rows, zone).where(F.col("reason").isNull())
    latitude, longitude = F.col("latitude_text"), F.col("longitude_text")
    if numeric_id:
        latitude = text.shortest_float_text(latitude, F.col("pickup_latitude"))
        longitude = text.shortest_float_text(longitude, F.col("pickup_longitude"))
    return valid.select(
        *(["row_number"] if keep_row_number else []),
        trip_id(
            F.col("row_number"), F.col("date_text"), latitude, longitude, F.col("base"), prefix
        ).alias("trip_id"),
        clock.iso_utc(F.col("instant")).alias("event_timestamp"),
        "pickup_latitude",
        "pickup_longitude",
        "base",
    )


def rejected_rows(rows: DataFrame, zone: str = SOURCE_ZONE) -> DataFrame:
    """Position and first failing check of each row that yields no event."""
    return (
        parse_raw(rows, zone).where(F.col("reason").isNotNull()).select("row_number", "reason")
    )
