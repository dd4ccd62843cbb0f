"""Staging view and trip fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import clock
from curbline.operators.enrich import is_valid_event
from curbline.schema import FACT_COLUMNS, GRID_DECIMALS, SOURCE_ZONE

def grid(degrees: Column) -> Column:
    """Decimal cell edge; 13 decimals hold all digits a coordinate can carry."""
    return F.round(degrees.cast("decimal(16,13)"), GRID_DECIMALS)


def staging_trips(source: DataFrame, zone: str = SOURCE_ZONE) -> DataFrame:
    """Valid trips with calendar and grid columns, all read off the clocks of ``zone``."""
    typed = source.select(
        "trip_id",
        F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
        F.col("pickup_latitude").cast("double").alias("pickup_latitude"),
        F.col("pickup_longitude").cast("double").alias("pickup_longitude"),
        "base",
    ).where(is_valid_event())
    local, hour = F.col("local_time"), F.col("pickup_hour")
    return (
        typed.withColumn("local_time", clock.instant_to_local(F.col("event_timestamp"), zone))
        .withColumns(
            {
                "trip_date": F.to_date(local),
                "pickup_hour": F.hour(local),
                "day_of_week": clock.iso_weekday(local),
                "day_name": clock.day_name(local),
                "is_weekend": clock.is_weekend(local),
                "latitude_grid": grid(F.col("pickup_latitude")),
                "longitude_grid": grid(F.col("pickup_longitude")),
            }
        )
        .withColumns(
            {"time_of_day": clock.time_of_day(hour), "is_peak_hour": clock.is_peak_hour(hour)}
        )
        .drop("local_time")
    )


def trip_fact(staging: DataFrame) -> DataFrame:
    return staging.select(*FACT_COLUMNS)
