"""Queries that a dashboard asks of the built models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.plans.models import AGGREGATES, read_model
from curbline.schema import RECENT_BATCHES, TOP_CELLS


def sort_columns(names: tuple[str, ...]) -> list[Column]:
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in names]


def serving_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A built model in its display order."""
    order = AGGREGATES[name][2]
    table = read_model(spark, out, name)
    return table.orderBy(*sort_columns(order)) if order else table


def heatmap_pivot(heatmap: DataFrame) -> DataFrame:
    """One row per weekday, one column per hour, 0 where no trip fell."""
    hours = [f"hour_{hour:02d}" for hour in range(24)]
    return (
        heatmap.withColumn("hour_name", F.format_string("hour_%02d", "pickup_hour"))
        .groupBy("day_name")
        .pivot("hour_name", hours)
        .agg(F.sum("trip_count"))
        .na.fill(0)
    )


def base_hours(base_hour: DataFrame, base: str) -> DataFrame:
    """Hourly counts of one base."""
    return base_hour.where(F.col("base") == base).orderBy("pickup_hour")


def top_cells(cells: DataFrame, limit: int = TOP_CELLS) -> DataFrame:
    """Busiest grid cells; equal counts in order of position."""
    return cells.orderBy(F.desc("trip_count"), "latitude_grid", "longitude_grid").limit(limit)


def map_points(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("latitude_grid").alias("lat"), F.col("longitude_grid").alias("lon"))


def kpi_ratios(kpis: DataFrame) -> DataFrame:
    """Peak and weekend share of all trips in percent, 0 where there are no trips."""
    total = F.col("total_trips").cast("double")

    def share(part: str) -> Column:
        ratio = F.col(part).cast("double") / F.nullif(total, F.lit(0.0)) * 100
        return F.coalesce(ratio, F.lit(0.0))

    return kpis.select(
        share("peak_trips").alias("peak_share"), share("weekend_trips").alias("weekend_share")
    )


def recent_batches(metrics: DataFrame, limit: int = RECENT_BATCHES) -> DataFrame:
    return metrics.orderBy(F.desc("processed_at"), F.desc("batch_id")).limit(limit)


def stream_health(metrics: DataFrame, limit: int = RECENT_BATCHES) -> DataFrame:
    """Latest batch, its size and time, and how many recent batches are on record."""
    latest = F.max(F.struct("processed_at", "batch_id", "records_received")).alias("latest")
    return (
        recent_batches(metrics, limit)
        .agg(latest, F.count(F.lit(1)).alias("batches_recorded"))
        .select(
            F.col("latest.batch_id").alias("latest_batch"),
            F.col("latest.records_received").alias("latest_batch_size"),
            "batches_recorded",
            F.col("latest.processed_at").alias("last_processed"),
        )
    )
