"""Gapless places over rows in any order, without one task for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.session import work_dir

#: Rows of a partition are numbered below this power of two by ``monotonically_increasing_id``.
PART_BITS = 33


def dealt_in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows plus ``part`` and ``at``: ranges of ``order`` in sequence, and the place inside each, from 0.

    The ranges are cut by a sample, so the numbered rows are written to the shared folder and read back: every
    later use sees the same ranges. Rows that are equal in all of ``order`` may stand in any sequence, and rows
    that share a hot value spread over ranges by what follows it.
    """
    path = work_dir(rows.sparkSession, "places")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("row_id", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    written = rows.sparkSession.read.schema(numbered.schema).parquet(path)
    part = F.shiftright("row_id", PART_BITS).cast("int")
    at = F.col("row_id").bitwiseAND((1 << PART_BITS) - 1)
    return written.select(*rows.columns, part.alias("part"), at.alias("at"))


def with_place(rows: DataFrame, *order: Column) -> DataFrame:
    """Adds ``place``: 1 for the first row by ``order``, with no gaps. One count per range is ever ordered together."""
    dealt = dealt_in_order(rows, *order)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead"))
    )
    return dealt.join(starts, "part").select(*rows.columns, (F.col("ahead") + F.col("at") + 1).alias("place"))
