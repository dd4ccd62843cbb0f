"""Keyed writes on plain tables: insert-if-absent and last-write-wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def one_per_key(
    rows: DataFrame, key: str, order: tuple[str, ...] = (), copies: str | None = None
) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    An aggregate with a partial step, so copies of a hot key shrink before the shuffle,
    and a rerun picks the same row. ``copies`` names a column for the number of a key's rows.
    """
    rest = [name for name in rows.columns if name != key]
    counts = [F.count(F.lit(1)).alias(copies)] if copies else []
    if len(rest) == 1:
        # A plain minimum of a number or a time stays in hash aggregation.
        return rows.groupBy(key).agg(F.min(rest[0]).alias(rest[0]), *counts)
    ranked = F.struct(*order, *[name for name in rest if name not in order])
    return (
        rows.groupBy(key).agg(F.min(ranked).alias("first_row"), *counts).select(
            key, *[F.col(f"first_row.`{name}`").alias(name) for name in rest], *([copies] if copies else [])
        )
    )


def insert_absent(
    batch: DataFrame, existing: DataFrame, key: str = "trip_id", order: tuple[str, ...] = (),
    unique_keys: bool = False,
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``, one per key, the first by ``order``.

    The stored keys are reduced to those of the batch first. Where the batch's keys are few
    by their measured size, the planner sends them to the table instead of moving its keys.
    Pass ``unique_keys`` where the batch holds each key once, to save the reduction.
    """
    keys = batch.select(key) if unique_keys else batch.select(key).distinct()
    taken = existing.select(key).join(keys, key, "left_semi")
    firsts = batch if unique_keys else one_per_key(batch, key, order)
    return firsts.join(taken, key, "left_anti")


def upsert_latest(
    old: DataFrame, new: DataFrame, key: tuple[str, ...], version: str
) -> DataFrame:
    """One row per key, the one with the highest ``version``; the new side wins a tie."""
    rest = [name for name in old.columns if name not in key]
    both = old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))
    newest = F.max(F.struct(version, "is_new", *[n for n in rest if n != version])).alias("newest")
    return both.groupBy(*key).agg(newest).select(
        *key, *[F.col(f"newest.{name}").alias(name) for name in rest]
    )
