"""The model run: staging view, fact table, aggregate tables; in full, or for the dates that changed.

The fact and the two count tables lie in date folders, and counts are additive over dates: a refresh replaces the folders of the
changed dates and builds the aggregates from the small count tables. Every step replaces what it wrote, so a refresh that was cut short is
mended by running it again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from curbline.plans import aggregates, trips
from curbline.schema import FACT_SCHEMA, SOURCE_ZONE
from curbline.streaming.batches import Folder

CONCURRENT_JOBS = 4

# Model -> (builder, counts table it is built from, columns its readers sort by).
AGGREGATES: dict[str, tuple[Callable[[DataFrame], DataFrame], str, tuple[str, ...]]] = {
    "trips_by_date": (aggregates.trips_by_date, "trip_rollup", ("trip_date",)),
    "trips_by_hour": (aggregates.trips_by_hour, "trip_rollup", ("pickup_hour",)),
    "trips_by_base": (aggregates.trips_by_base, "trip_rollup", ("-trip_count", "base")),
    "trips_by_day_type": (aggregates.trips_by_day_type, "trip_rollup", ("-trip_count", "day_type")),
    "trips_by_time_of_day": (
        aggregates.trips_by_time_of_day,
        "trip_rollup",
        ("-trip_count", "time_of_day"),
    ),
    "day_hour_heatmap": (
        aggregates.day_hour_heatmap,
        "trip_rollup",
        ("day_of_week", "pickup_hour"),
    ),
    "trips_by_base_hour": (aggregates.trips_by_base_hour, "trip_rollup", ("base", "pickup_hour")),
    "geo_grid": (
        aggregates.geo_grid,
        "cell_counts",
        ("-trip_count", "latitude_grid", "longitude_grid"),
    ),
    "kpis": (aggregates.kpis, "trip_rollup", ()),
}


COUNTS = {"trip_rollup": aggregates.trip_rollup, "cell_counts": aggregates.daily_cell_counts}
_COUNT = StructField("trip_count", LongType())
# Tables in date folders: without a trip they have no file to take the schema from.
DATED = {
    "trip_fact": FACT_SCHEMA,
    "trip_rollup": StructType([*[FACT_SCHEMA[n] for n in ("pickup_hour", "base")], _COUNT, FACT_SCHEMA["trip_date"]]),
    "cell_counts": StructType(
        [*[FACT_SCHEMA[n] for n in ("latitude_grid", "longitude_grid")], _COUNT, FACT_SCHEMA["trip_date"]]
    ),
}
_DAY = 86_400


def build_models(
    source: DataFrame,
    out: str,
    zone: str = SOURCE_ZONE,
    view: str = "stg_trips",
    gather_dates: bool = True,
) -> None:
    """Rebuild all models under the folder ``out``.

    The staging model is a view. The fact is written by date; two scans of its key
    columns give the rollup and the cell counts, and every aggregate is built from those
    two small tables, read back from storage so that a lost executor costs no rescan.

    ``gather_dates`` brings the rows of a date together before the write, large dates split
    and small ones packed, so that not every task writes a file per date. It shuffles the
    fact: turn it off where the source lies in date order.
    """
    spark = source.sparkSession
    staging = trips.staging_trips(source, zone)
    staging.createOrReplaceTempView(view)
    _write_dated(trips.trip_fact(staging), out, "trip_fact", gather_dates)
    _build_from(spark, out, read_model(spark, out, "trip_fact"))


def refresh_models(
    source: DataFrame, out: str, dates: Iterable[date], zone: str = SOURCE_ZONE, gather_dates: bool = True
) -> None:
    """Bring the models under ``out`` up to date where only trips of ``dates`` have come, gone or changed.

    Of the source only those dates are read: by ranges of the timestamp, which reach its scan, and by its own ``trip_date`` where
    it has that column (of the same zone). A date without a trip left loses its folders.
    """
    wanted = sorted(set(dates))
    if not wanted:
        return
    spark = source.sparkSession
    near = source.where(reduce(lambda a, b: a | b, [_around(day) for day in wanted]))
    if "trip_date" in source.columns:
        near = near.where(F.col("trip_date").isin(wanted))
    fact = trips.trip_fact(trips.staging_trips(near, zone)).where(F.col("trip_date").isin(wanted))
    _write_dated(fact, out, "trip_fact", gather_dates, "dynamic")
    # The fact of a date that has lost its trips still holds its old rows: what is there now tells.
    left = {row.trip_date for row in fact.select("trip_date").distinct().collect()}
    for day in wanted:
        if day not in left:
            for name in DATED:
                Folder(spark, f"{out}/{name}").delete(f"trip_date={day.isoformat()}")
    built = read_model(spark, out, "trip_fact").where(F.col("trip_date").isin(wanted))
    _build_from(spark, out, built, "dynamic")


def _around(day: date) -> Column:
    """Instants that may fall on a date in any zone: filters on literals, which a scan can use."""
    start = (day - date(1970, 1, 1)).days * _DAY
    low, high = (F.timestamp_seconds(F.lit(start + shift * _DAY)) for shift in (-1, 2))
    return (F.col("event_timestamp") >= low) & (F.col("event_timestamp") < high)


def _write_dated(frame: DataFrame, out: str, name: str, gather: bool = True, mode: str = "static") -> None:
    """Write a table in date folders: all of it, or (dynamic) the dates that the frame has."""
    gathered = frame.hint("rebalance", "trip_date") if gather else frame
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy("trip_date").parquet(f"{out}/{name}")


def _build_from(spark: SparkSession, out: str, fact: DataFrame, mode: str = "static") -> None:
    """Write the counts of a fact, or of some dates of it, and all aggregates."""
    _each(spark, lambda name: _write_dated(COUNTS[name](fact), out, name, mode=mode), COUNTS)

    def write_aggregate(name: str) -> None:
        build, counts, _ = AGGREGATES[name]
        build(read_model(spark, out, counts)).write.mode("overwrite").parquet(f"{out}/{name}")

    _each(spark, write_aggregate, AGGREGATES)


def _each(spark: SparkSession, work: Callable[[str], None], names: Iterable[str]) -> None:
    """Run small jobs side by side: their stages would leave most of a cluster idle."""
    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        target = inheritable_thread_target(spark)(work)
        for done in [pool.submit(target, name) for name in names]:
            done.result()


def read_model(spark: SparkSession, out: str, name: str) -> DataFrame:
    reader = spark.read.schema(DATED[name]) if name in DATED else spark.read
    return reader.parquet(f"{out}/{name}")
