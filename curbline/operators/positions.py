"""Gapless positions over rows that already carry a unique, ordered row number."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.schema import HEAD_START_ROWS, SLICE_ROWS

SPAN_ROWS = 1_000_000


def with_position(
    rows: DataFrame,
    order: str = "row_number",
    after: int = 0,
    upto: int | None = None,
    span_rows: int = SPAN_ROWS,
) -> DataFrame:
    """Adds ``position``: 1 for the first row by ``order``, with no gaps.

    Rows are numbered inside fixed spans of ``order``, at most ``span_rows`` each since the
    number is unique, and shifted by the count of the spans before. Only one count per span
    is ever ordered globally. With ``after`` and ``upto`` only positions above the one and up
    to the other are kept, and spans outside that range are dropped by the join.
    """
    spanned = rows.withColumn("span", F.expr(f"`{order}` div {span_rows}"))
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spanned.groupBy("span")
        .agg(F.count(F.lit(1)).alias("span_count"))
        .select(
            "span", "span_count", F.coalesce(F.sum("span_count").over(before), F.lit(0)).alias("ahead")
        )
        .where(F.col("ahead") + F.col("span_count") > after)
    )
    position = F.col("ahead") + F.row_number().over(Window.partitionBy("span").orderBy(order))
    if upto is not None:
        offsets = offsets.where(F.col("ahead") < upto)
    placed = spanned.join(offsets, "span").select(*rows.columns, position.alias("position"))
    placed = placed.where(F.col("position") > after)
    return placed if upto is None else placed.where(F.col("position") <= upto)


def take_range(
    rows: DataFrame, skip: int = 0, limit: int | None = None, order: str = "row_number"
) -> DataFrame:
    """Rows after the first ``skip``, at most ``limit`` of them; 0 or None means all.

    The first rows alone are a top-N: one scan, and only ``limit`` rows are ever ordered together.
    """
    if skip < 0 or (limit is not None and limit < 0):
        raise ValueError("skip and limit must not be negative")
    if limit and not skip:
        first = rows.orderBy(order).limit(limit)
        return first.withColumn("position", F.row_number().over(Window.orderBy(order)).cast("bigint"))
    return with_position(rows, order, skip, skip + limit if limit else None)


def with_slice(
    positioned: DataFrame, head_start: int = HEAD_START_ROWS, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Adds ``slice_no``: 0 for the head start, then one number per ``slice_rows`` rows."""
    if head_start < 0 or slice_rows < 1:
        raise ValueError("head_start must be >= 0 and slice_rows >= 1")
    beyond = F.expr(f"1 + (position - 1 - {head_start}) div {slice_rows}")
    return positioned.withColumn(
        "slice_no", F.when(F.col("position") <= head_start, F.lit(0).cast("bigint")).otherwise(beyond)
    )
