"""Share of total and rank over grouped counts of any number of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions.ratios import percent


def with_share_and_rank(counts: DataFrame) -> DataFrame:
    """Adds ``share_pct`` and ``rank`` (by ``trip_count`` descending, gaps after ties).

    A rank window over all groups would be one task. The rank depends on ``trip_count``
    alone, so it is worked out on the distinct counts and joined back. N trips hold at
    most sqrt(2 N) distinct counts: two million for two trillion trips.
    """
    ladder = counts.groupBy("trip_count").agg(F.count(F.lit(1)).alias("groups"))
    above = Window.orderBy(F.desc("trip_count")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rungs = ladder.select(
        "trip_count",
        (F.coalesce(F.sum("groups").over(above), F.lit(0)) + 1).alias("rank"),
        F.sum(F.col("trip_count") * F.col("groups")).over(everything).alias("total"),
    )
    return counts.join(rungs, "trip_count").select(
        *counts.columns, percent(F.col("trip_count"), F.col("total")).alias("share_pct"), "rank"
    )
