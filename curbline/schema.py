"""Schemas and fixed values shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The data contract depends on each of these as written.
SOURCE_ZONE = "America/New_York"
ID_PREFIX = "uber-"
ID_HEX_DIGITS = 20
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
PEAK_HOURS = ((7, 10), (17, 20))
DAY_PARTS = (("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 20))
OTHER_DAY_PART = "Night"
WEEKEND_DAYS = (6, 7)
GRID_DECIMALS = 2
ROLLING_ROWS = 7
HEAD_START_ROWS = 50_000
SLICE_ROWS = 20
TOP_CELLS = 250
RECENT_BATCHES = 10
JDBC_BATCH_ROWS = 5_000
TRIGGER = "10 seconds"

RAW_COLUMNS = ("Date/Time", "Lat", "Lon", "Base")

# One raw trip row with its 1-based position in the source, all text.
RAW_SCHEMA = StructType(
    [StructField("row_number", LongType())]
    + [StructField(name, StringType()) for name in RAW_COLUMNS]
)

# Column shards: role -> raw columns carried next to trip_id.
SHARD_COLUMNS = {
    "datetime": ("Date/Time",),
    "latitude": ("Lat",),
    "longitude_base": ("Lon", "Base"),
}
# Column shards: role -> canonical fields carried by its partial events.
PARTIAL_FIELDS = {
    "datetime": ("event_timestamp",),
    "latitude": ("pickup_latitude",),
    "longitude_base": ("pickup_longitude", "base"),
}

# The event on the wire: the timestamp is ISO-8601 text in UTC.
EVENT_SCHEMA = StructType(
    [
        StructField("trip_id", StringType(), False),
        StructField("event_timestamp", StringType(), False),
        StructField("pickup_latitude", DoubleType(), False),
        StructField("pickup_longitude", DoubleType(), False),
        StructField("base", StringType(), False),
    ]
)
EVENT_COLUMNS = tuple(EVENT_SCHEMA.names)

# The staging table: a validated event with its calendar columns.
STAGING_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("event_timestamp", TimestampType()),
        StructField("pickup_latitude", DoubleType()),
        StructField("pickup_longitude", DoubleType()),
        StructField("base", StringType()),
        StructField("trip_date", DateType()),
        StructField("pickup_hour", IntegerType()),
        StructField("day_of_week", IntegerType()),
    ]
)
STAGING_COLUMNS = tuple(STAGING_SCHEMA.names)

# The trip fact: one row per pickup.
FACT_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("event_timestamp", TimestampType()),
        StructField("trip_date", DateType()),
        StructField("pickup_hour", IntegerType()),
        StructField("day_of_week", IntegerType()),
        StructField("day_name", StringType()),
        StructField("is_weekend", BooleanType()),
        StructField("time_of_day", StringType()),
        StructField("is_peak_hour", BooleanType()),
        StructField("latitude_grid", DecimalType(6, GRID_DECIMALS)),
        StructField("longitude_grid", DecimalType(6, GRID_DECIMALS)),
        StructField("pickup_latitude", DoubleType()),
        StructField("pickup_longitude", DoubleType()),
        StructField("base", StringType()),
    ]
)
FACT_COLUMNS = tuple(FACT_SCHEMA.names)

BATCH_METRICS_SCHEMA = StructType(
    [
        StructField("batch_id", LongType()),
        StructField("records_received", LongType()),
        StructField("processed_at", TimestampType()),
    ]
)
