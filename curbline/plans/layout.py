"""The trip fact laid out for map windows: rows in Morton order of their grid cells.

Cells that lie together on the map lie together in the files, so the smallest and largest latitude and longitude that Parquet keeps for
each row group are close to each other, and a filter on both skips most row groups. The order of a cell interleaves the bits of
its row and column; ties are broken by the id, so that a cell with a third of all trips is dealt to many files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.schema import FACT_SCHEMA, GRID_DECIMALS, LATITUDE_RANGE, LONGITUDE_RANGE

ROW_GROUP_BYTES = 16 * 1024**2
# Masks that spread the bits of a number of 16 bits over every other bit of 32, by halving steps.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _cell(edge: Column, lowest: float) -> Column:
    """Number of a cell's row or column, from 0."""
    return F.round((edge.cast("double") - lowest) * 10**GRID_DECIMALS).cast("long")


def _spread(number: Column) -> Column:
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return number


def morton(latitude: Column, longitude: Column) -> Column:
    """Place of a grid cell on the curve; rows and columns of cells take 16 bits each. Null where an edge is."""
    row, column = _cell(latitude, LATITUDE_RANGE[0]), _cell(longitude, LONGITUDE_RANGE[0])
    return _spread(row).bitwiseOR(F.shiftleft(_spread(column), 1))


def write_clustered(
    fact: DataFrame, path: str, files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Write a fact in Morton order, in ranges of about equal size: ``files``, or as many as the session shuffles to."""
    order = [morton(F.col("latitude_grid"), F.col("longitude_grid")), F.col("trip_id")]
    dealt = fact.repartitionByRange(files, *order) if files else fact.repartitionByRange(*order)
    writer = dealt.sortWithinPartitions(*order).write.mode("overwrite")
    writer.option("parquet.block.size", row_group_bytes).parquet(path)


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(path)


def in_window(
    fact: DataFrame,
    latitudes: tuple[float, float],
    longitudes: tuple[float, float],
    base: str | None = None,
) -> DataFrame:
    """Trips of the cells in a window, edges included, and of one base if given.

    The bounds are literals of the columns' own type: they reach the scan, which skips row groups by them.
    """
    for name, (low, high) in (("latitude_grid", latitudes), ("longitude_grid", longitudes)):
        kind = FACT_SCHEMA[name].dataType
        fact = fact.where(F.col(name).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    return fact if base is None else fact.where(F.col("base") == base)
