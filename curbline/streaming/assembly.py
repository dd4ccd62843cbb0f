"""Put complete events together from partial events, and give each out once it is complete.

Partial events carry ``trip_id``, the fields of their role and ``arrival``, the time the
message came in, with ``partition`` and ``offset`` where the source has them.

A micro-batch looks up what is pending of its ids and joins both, the latest value of each field. Ids that make a valid event go to the
staging table with that batch; of the others the batch's own parts are added to the pending table, where they wait for as long as it takes:
no watermark, no state in memory, nothing lost when the stream ends. Parts of an id that has been stored are dropped. The pending
table is a log of additions, which are joined by a maximum, and of marks for ids that have left; its filters tell which files may hold an
id, and its folds join the additions of an id and drop what has left. A replayed batch finds what it found before, since it does not
read its own folders, and replaces them.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from curbline.operators.enrich import add_calendar, decode_events, marked_events
from curbline.schema import EVENT_COLUMNS, EVENT_SCHEMA, SOURCE_ZONE, STAGING_COLUMNS, TRIGGER
from curbline.streaming.batches import fold, read_batches, read_folders
from curbline.streaming.sinks import (
    COMPACT_EVERY,
    STAGING_FILES,
    compact_staging,
    drop_filters,
    record_batch,
    run_of,
    start_writer,
    stored_rows,
    write_bucketed,
)

_PAYLOAD = EVENT_COLUMNS[1:]
# What orders two values of a field: the later arrival wins, then the larger value.
_ORDER = StructType(
    [
        StructField("arrival", TimestampType()),
        StructField("partition", LongType()),
        StructField("offset", LongType()),
    ]
)
_PENDING = StructType(
    [
        StructField("trip_id", StringType()),
        *[
            StructField(name, StructType([StructField("at", _ORDER), StructField("value", EVENT_SCHEMA[name].dataType)]))
            for name in _PAYLOAD
        ],
        StructField("left", BooleanType()),
    ]
)
_PENDING_FILES = StructType([*_PENDING.fields, StructField("bucket", LongType())])


def _all_present(fields: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in fields])


def decode_partials(messages: DataFrame) -> DataFrame:
    """JSON partial events of any role; the fields of the other roles are null.

    ``messages`` has ``value`` and ``timestamp``, as the bus gives them, and may have
    ``partition`` and ``offset``.
    """
    place = [
        (F.col(name) if name in messages.columns else F.lit(None)).cast("bigint").alias(name)
        for name in ("partition", "offset")
    ]
    placed = messages.select("value", F.col("timestamp").alias("arrival"), *place)
    decoded = decode_events(placed, ("arrival", "partition", "offset"))
    return decoded.where(F.col("trip_id").isNotNull())


def _latest_values() -> list[Column]:
    """Per field the struct of its latest arrival and its value; equal arrivals: the larger value."""
    at = F.struct("arrival", "partition", "offset").alias("at")
    return [
        F.max(F.when(F.col(name).isNotNull(), F.struct(at, F.col(name).alias("value")))).alias(name)
        for name in _PAYLOAD
    ]


def assemble(decoded: DataFrame) -> DataFrame:
    """The latest value of each field per id, with its arrival."""
    return decoded.groupBy("trip_id").agg(*_latest_values())


def joined(assembled: DataFrame) -> DataFrame:
    """One row per id from rows of ``assemble`` that may repeat an id."""
    return assembled.groupBy("trip_id").agg(*[F.max(name).alias(name) for name in _PAYLOAD])


def _values(assembled: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Assembled fields as plain columns; ``arrival`` is when the last of them came."""
    last = F.greatest(*[F.col(f"{name}.at.arrival") for name in _PAYLOAD])
    return assembled.select(
        "trip_id", *[F.col(f"{name}.value").alias(name) for name in _PAYLOAD], last.alias("arrival"), *keep
    )


def complete_events(assembled: DataFrame) -> DataFrame:
    """Wire events of the ids that have every field."""
    return _values(assembled).where(_all_present(_PAYLOAD)).select(*EVENT_COLUMNS)


def read_pending(spark: SparkSession, pending_path: str) -> DataFrame:
    """Ids that wait, a row each: the latest value of each field and its arrival, null where it has not come."""
    rows = read_batches(spark, pending_path, _PENDING_FILES)
    waiting = rows.groupBy("trip_id").agg(
        *[F.max(name).alias(name) for name in _PAYLOAD], F.bool_or("left").alias("gone")
    )
    return waiting.where(~F.col("gone")).drop("gone")


def assemble_batch(
    parts: DataFrame,
    batch_id: int,
    run: str,
    staging_path: str,
    metrics_path: str,
    pending_path: str,
    zone: str = SOURCE_ZONE,
) -> None:
    """Store the trips that the parts of one micro-batch complete, and keep the parts of the others.

    ``records_received`` counts the events completed, as the sink receives them.
    """
    spark = parts.sparkSession
    name = f"run={run}/batch={batch_id}"
    own = assemble(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        many = own.count()
        if many == 0:
            return
        stored = stored_rows(spark, staging_path, STAGING_FILES, own, run, batch_id, many)
        waiting = stored_rows(spark, pending_path, _PENDING_FILES, own, run, batch_id, many)
        judged = _judged(own, stored, waiting, zone).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            complete = judged.where("is_valid").count()
            # Trips first: cut short after them, a replay finds the same parts and replaces both.
            if complete:
                write_bucketed(judged.where("is_valid").select(*STAGING_COLUMNS), staging_path, name, complete)
                record_batch(spark, metrics_path, run, batch_id, complete)
            # Of the ids that are complete, only those that had waited need a mark.
            rows = judged.where("waited or not is_valid").select(
                "trip_id", *[F.col(f"own_{n}").alias(n) for n in _PAYLOAD], F.col("is_valid").alias("left")
            )
            write_bucketed(rows, pending_path, name, many)
        finally:
            judged.unpersist()
    finally:
        own.unpersist()


def _judged(own: DataFrame, stored: DataFrame, waiting: DataFrame, zone: str) -> DataFrame:
    """A row per id of ``own`` that is not stored: its trip so far and ``is_valid``, its own parts unless valid, and ``waited``.

    All sides lie by id, as ``assemble`` left ``own``; ids that are not of the batch leave before they are joined.
    """
    ids = own.select("trip_id")
    taken = stored.select("trip_id").join(ids, "trip_id", "left_semi")
    held = joined(waiting.select("trip_id", *_PAYLOAD).join(ids, "trip_id", "left_semi"))
    before = held.select("trip_id", *[F.col(n).alias(f"held_{n}") for n in _PAYLOAD], F.lit(True).alias("waited"))
    met = own.join(taken, "trip_id", "left_anti").join(before, "trip_id", "left")
    both = met.select(
        "trip_id",
        *[F.greatest(n, f"held_{n}").alias(n) for n in _PAYLOAD],
        *[F.col(n).alias(f"own_{n}") for n in _PAYLOAD],
        F.coalesce("waited", F.lit(False)).alias("waited"),
    )
    kept = ("waited", *[f"own_{n}" for n in _PAYLOAD])
    marked = marked_events(_values(both, kept), zone, kept)
    own_parts = {f"own_{n}": F.when(~F.col("is_valid"), F.col(f"own_{n}")) for n in _PAYLOAD}
    return add_calendar(marked, zone, (*kept, "is_valid")).withColumns(own_parts)


def compact_pending(spark: SparkSession, pending_path: str, fan: int = COMPACT_EVERY) -> None:
    """Fold the pending table: one row per id; a mark takes the additions of its id along, and goes where no older folder is left."""

    def write(run: str, names: list[str], name: str, lowest: bool) -> None:
        rows = read_folders(spark, pending_path, _PENDING_FILES, names)
        by_id = rows.groupBy("trip_id").agg(*[F.max(n).alias(n) for n in _PAYLOAD], F.bool_or("left").alias("left"))
        kept = by_id.where(~F.col("left")) if lowest else by_id.select(
            "trip_id", *[F.when(~F.col("left"), F.col(n)).alias(n) for n in _PAYLOAD], "left"
        )
        kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_bucketed(kept, pending_path, name, kept.count())
        finally:
            kept.unpersist()

    fold(spark, pending_path, fan, write)
    drop_filters(spark, pending_path)


def write_assembly_stream(
    decoded: DataFrame,
    staging_path: str,
    metrics_path: str,
    pending_path: str,
    checkpoint_path: str,
    zone: str = SOURCE_ZONE,
    trigger: str = TRIGGER,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Trips into a staging table with the micro-batch that completes them; the parts of others wait in the pending table.

    A replayed batch replaces what it wrote to either.
    """

    @cache
    def run() -> str:
        return run_of(decoded.sparkSession, checkpoint_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        assemble_batch(batch, batch_id, run(), staging_path, metrics_path, pending_path, zone)
        compact_staging(spark, staging_path, metrics_path, compact_every)
        compact_pending(spark, pending_path, compact_every)

    return start_writer(decoded.writeStream.foreachBatch(write_batch), checkpoint_path, trigger)
