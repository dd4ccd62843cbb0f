"""The ``events`` table seen as trips.

The mapping is fixed, so a query and its SQL check read the same trips. Some rows get
a latitude out of range or an empty base on purpose: validation must have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from curbline.functions import clock
from curbline.functions.identity import trip_id
from curbline.operators.once import unpack_once

TABLE_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)


def table_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir))


def _date_text() -> Column:
    """month/day/year hour:minute:second, no leading zeros but in minutes and seconds."""
    ts = F.col("ts")
    minutes = F.substring(ts.cast("string"), 14, 6)
    date = F.concat_ws("/", F.month(ts).cast("string"), F.day(ts).cast("string"), F.year(ts).cast("string"))
    return F.concat(date, F.lit(" "), F.hour(ts).cast("string"), minutes)


def _latitude() -> Column:
    spread = F.rint(F.col("value") * 100).cast("bigint") % 4000
    return F.when(F.col("event_id") % 89 == 0, F.lit(95.0)).otherwise(
        (spread + 405000).cast("double") / 10000
    )


def _longitude() -> Column:
    spread = (F.col("user_id") * 37 + F.col("event_id")) % 5000
    return (spread - 742000).cast("double") / 10000


def _base() -> Column:
    return F.when(F.col("event_id") % 97 == 0, F.lit("")).otherwise(F.col("event_type"))


def raw_rows(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numbered raw rows, all text, as a CSV scan gives them."""
    return events.select(
        (F.col("event_id") + 1).alias("row_number"),
        _date_text().alias("Date/Time"),
        _latitude().cast("string").alias("Lat"),
        _longitude().cast("string").alias("Lon"),
        _base().alias("Base"),
        *keep,
    )


def staging_source(events: DataFrame) -> DataFrame:
    """Typed trips as they lie in the staging source, bad rows included.

    Worked out once, like stored columns: filters on them cost no second computation. The
    id stays outside, so that it is not hashed where nobody reads it.
    """
    latitude, longitude, base = _latitude(), _longitude(), _base()
    keyed = events.withColumn(
        "trip_id",
        trip_id(
            F.col("event_id") + 1,
            _date_text(),
            latitude.cast("string"),
            longitude.cast("string"),
            base,
        ),
    )
    fields = F.struct(
        clock.local_to_instant(F.col("ts")).alias("event_timestamp"),
        latitude.alias("pickup_latitude"),
        longitude.alias("pickup_longitude"),
        base.alias("base"),
    )
    return unpack_once(keyed, fields, ("trip_id",))


def wire_events(events: DataFrame) -> DataFrame:
    """Trips as wire events: timestamp as ISO text in UTC, bad rows included."""
    iso = clock.iso_utc(F.col("event_timestamp"))
    return staging_source(events).withColumn("event_timestamp", iso)
