"""The nine aggregate models.

Each takes the fact, or counts already grouped from it (``trip_rollup``, ``cell_counts``):
rows with a ``trip_count`` column weigh that many trips. Calendar attributes are worked out
from ``trip_date`` and ``pickup_hour`` after grouping, so a scan reads only the keys.

Windows without a partition key run here only over hours, day parts and calendar dates,
whose number does not grow with the trips. Bases and grid cells go through
``with_share_and_rank``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions import clock
from curbline.functions.ratios import mean, percent
from curbline.operators.ranking import with_share_and_rank
from curbline.schema import ROLLING_ROWS

def _over_all(column: Column) -> Column:
    return column.over(Window.partitionBy())


def count_by(trips: DataFrame, *keys: str | Column) -> DataFrame:
    weight = F.sum("trip_count") if "trip_count" in trips.columns else F.count(F.lit(1))
    return trips.groupBy(*keys).agg(weight.alias("trip_count"))


def trip_rollup(fact: DataFrame) -> DataFrame:
    """Counts by date, hour and base: all that eight of the nine models need."""
    return count_by(fact, "trip_date", "pickup_hour", "base")


def cell_counts(fact: DataFrame) -> DataFrame:
    return count_by(fact, "latitude_grid", "longitude_grid")


def daily_cell_counts(fact: DataFrame) -> DataFrame:
    """Counts by cell and date, so that one date's can be replaced."""
    return count_by(fact, "trip_date", "latitude_grid", "longitude_grid")


def _share() -> Column:
    return percent(F.col("trip_count"), _over_all(F.sum("trip_count"))).alias("share_pct")


def _rank() -> Column:
    return F.rank().over(Window.orderBy(F.desc("trip_count"))).cast("bigint").alias("rank")


def trips_by_date(trips: DataFrame) -> DataFrame:
    """Daily counts with share, overall mean, mean of the last seven rows and change."""
    by_date = Window.orderBy("trip_date")
    rolling = by_date.rowsBetween(1 - ROLLING_ROWS, 0)
    count = F.col("trip_count")
    before = F.lag("trip_count").over(by_date)
    return count_by(trips, "trip_date").select(
        "trip_date",
        "trip_count",
        _share(),
        mean(_over_all(F.sum(count)), _over_all(F.count(count))).alias("avg_daily_trips"),
        mean(F.sum(count).over(rolling), F.count(count).over(rolling)).alias("rolling_7d_avg"),
        percent(count - before, before).alias("pct_change"),
    )


def trips_by_hour(trips: DataFrame) -> DataFrame:
    return count_by(trips, "pickup_hour").select(
        "pickup_hour",
        "trip_count",
        _share(),
        _rank(),
        clock.is_peak_hour(F.col("pickup_hour")).alias("is_peak_hour"),
    )


def trips_by_base(trips: DataFrame) -> DataFrame:
    return with_share_and_rank(count_by(trips, "base"))


def trips_by_day_type(trips: DataFrame) -> DataFrame:
    weekend = clock.is_weekend(F.col("trip_date"))
    day_type = F.when(weekend, "Weekend").otherwise("Weekday").alias("day_type")
    return count_by(trips, day_type).select("day_type", "trip_count", _share())


def trips_by_time_of_day(trips: DataFrame) -> DataFrame:
    part = clock.time_of_day(F.col("pickup_hour")).alias("time_of_day")
    return count_by(trips, part).select("time_of_day", "trip_count", _share())


def day_hour_heatmap(trips: DataFrame) -> DataFrame:
    day = F.col("trip_date")
    return count_by(
        trips,
        clock.iso_weekday(day).alias("day_of_week"),
        clock.day_name(day).alias("day_name"),
        "pickup_hour",
    )


def trips_by_base_hour(trips: DataFrame) -> DataFrame:
    return count_by(trips, "base", "pickup_hour")


def geo_grid(trips: DataFrame) -> DataFrame:
    return with_share_and_rank(count_by(trips, "latitude_grid", "longitude_grid"))


def kpis(trips: DataFrame) -> DataFrame:
    """The one-row summary, in one pass over the trips.

    The trips shrink to the rollup; grouping sets then give the counts by date, by hour
    and by base in one frame, and a last aggregate reads each figure off its own rows.
    Ties go to the lowest hour and the first base in alphabetical order.
    """
    sides = (
        trip_rollup(trips)
        .groupingSets(
            [["trip_date"], ["pickup_hour"], ["base"]], "trip_date", "pickup_hour", "base"
        )
        .agg(F.sum("trip_count").alias("trips"), F.grouping_id().alias("absent"))
    )
    # grouping_id has a 1 for each of (trip_date, pickup_hour, base) not grouped by.
    is_day, is_hour, is_base = (F.col("absent") == bits for bits in (0b011, 0b101, 0b110))
    date, hour, base, trips_ = (F.col(c) for c in ("trip_date", "pickup_hour", "base", "trips"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, trips_)), F.lit(0))

    first_base = F.when(is_base, F.struct(-trips_, base))
    return sides.agg(
        total(is_day).alias("total_trips"),
        F.count(F.when(is_base, base)).alias("active_bases"),
        F.count_if(is_day).alias("unique_dates"),
        F.count_if(is_hour).alias("unique_hours"),
        mean(F.sum(F.when(is_day, trips_)), F.count_if(is_day)).alias("avg_daily_trips"),
        F.percentile(F.when(is_day, trips_), 0.5).alias("median_daily_trips"),
        F.max_by(hour, F.when(is_hour, F.struct(trips_, -hour))).alias("busiest_hour"),
        F.min_by(hour, F.when(is_hour, F.struct(trips_, hour))).alias("quietest_hour"),
        F.min_by(base, first_base).alias("top_base"),
        F.min_by(trips_, first_base).alias("top_base_trips"),
        total(is_hour & clock.is_peak_hour(hour)).alias("peak_trips"),
        total(is_day & clock.is_weekend(date)).alias("weekend_trips"),
    )
