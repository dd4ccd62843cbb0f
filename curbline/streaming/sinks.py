"""Checkpointed sinks for the enriched trip stream."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from curbline.operators.enrich import add_calendar
from curbline.operators.merge import insert_absent, one_per_key
from curbline.schema import (
    BATCH_METRICS_SCHEMA,
    JDBC_BATCH_ROWS,
    SOURCE_ZONE,
    STAGING_COLUMNS,
    STAGING_SCHEMA,
    TRIGGER,
)
from curbline.streaming.batches import Folder, fold, live_names, read_batches, read_folders
from curbline.streaming.membership import drop_filters, may_hold, write_filter

# Ids meet only ids of their own bucket; the number belongs to the layout of a table.
STAGING_BUCKETS = 64
# Files per date and micro-batch of the lake, at most.
LAKE_FILES = 8
# Folders of one size of a run that are folded into one of the next.
COMPACT_EVERY = 16

STAGING_FILES = StructType([*STAGING_SCHEMA.fields, StructField("bucket", LongType())])


def start_writer(
    writer: DataStreamWriter,
    checkpoint_path: str,
    trigger: str = TRIGGER,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a query; the trigger ``available`` works off what is there and stops."""
    writer = writer.outputMode(output_mode).option("checkpointLocation", checkpoint_path)
    if trigger == "available":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def write_parquet_stream(
    stream: DataFrame,
    output_path: str,
    checkpoint_path: str,
    trigger: str = TRIGGER,
    files: int = LAKE_FILES,
) -> StreamingQuery:
    """Append to a Parquet table in date folders, at most ``files`` files per date and batch."""
    dealt = stream.repartition("trip_date", F.pmod(F.xxhash64("trip_id"), F.lit(files)))
    writer = dealt.writeStream.format("parquet").option("path", output_path)
    return start_writer(writer.partitionBy("trip_date"), checkpoint_path, trigger)


def read_staging(spark: SparkSession, staging_path: str) -> DataFrame:
    """The key-deduplicated staging table."""
    return read_batches(spark, staging_path, STAGING_FILES).select(*STAGING_COLUMNS)


def read_batch_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """One row per run and batch; a batch belongs to the run whose folder it was written to."""
    return read_batches(spark, metrics_path, BATCH_METRICS_SCHEMA).select("run", *BATCH_METRICS_SCHEMA.names)


def bucket_of(key: str = "trip_id") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(STAGING_BUCKETS))


def stored_rows(
    spark: SparkSession, path: str, schema: StructType, ids: DataFrame, run: str, batch_id: int, many: int = 0
) -> DataFrame:
    """The rows of a bucketed table in files that may hold one of ``ids``, but those of the batch's own folder.

    The filters beside the table tell the files; new ids read none. ``many`` is about the number of ids, if known.
    """
    others = [name for name in live_names(spark, path) if name != f"run={run}/batch={batch_id}"]
    keys = ids.select("trip_id", bucket_of().alias("bucket"))
    names, buckets = may_hold(spark, path, keys, others, many=many, buckets=STAGING_BUCKETS)
    rows = read_folders(spark, path, schema, names)
    return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))


def write_bucketed(rows: DataFrame, path: str, name: str, many: int) -> None:
    """A folder of a bucketed table and, before it, its filter; ``many`` is about its number of rows.

    A folder that is complete stays: a replayed batch would write the same, and readers see no gap.
    """
    if Folder(rows.sparkSession, path).matches(f"{name}/_SUCCESS"):
        return
    bucketed = rows.withColumn("bucket", bucket_of())
    write_filter(bucketed, path, name, many, STAGING_BUCKETS)
    # Sorted by bucket, so that a look-up skips row groups.
    dealt = bucketed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "trip_id")
    dealt.write.mode("overwrite").parquet(f"{path}/{name}")


def record_batch(spark: SparkSession, metrics_path: str, run: str, batch_id: int, records: int) -> None:
    """The metrics row of a batch; a replayed batch replaces it."""
    spark.range(0, 1, 1, 1).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(records).cast("bigint").alias("records_received"),
        F.current_timestamp().alias("processed_at"),
    ).write.mode("overwrite").parquet(f"{metrics_path}/run={run}/batch={batch_id}")


def merge_batch(
    batch: DataFrame, batch_id: int, run: str, staging_path: str, metrics_path: str
) -> None:
    """Add the trips of one micro-batch that are not in the staging table yet.

    The first trip with an id stays: within a batch the first by ``arrival``, if it has that
    column. The look-up reads the files whose filters may hold an id of the batch, and compares exactly, whatever
    the date. A batch owns one folder per run, so replaying the batch gives the same table, and a new
    metrics row for the old one.
    """
    spark = batch.sparkSession
    order = ("arrival",) if "arrival" in batch.columns else ()
    # Reduced as it is decoded: what follows reads one row per id, laid out by id.
    firsts = one_per_key(batch, "trip_id", order, copies="copies").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        many, records = firsts.agg(F.count(F.lit(1)), F.sum("copies")).first()
        if many == 0:
            return
        others = stored_rows(spark, staging_path, STAGING_FILES, firsts, run, batch_id, many)
        new = insert_absent(firsts, others, unique_keys=True).select(*STAGING_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_bucketed(new, staging_path, f"run={run}/batch={batch_id}", many)
        finally:
            new.unpersist()
        record_batch(spark, metrics_path, run, batch_id, records)
    finally:
        firsts.unpersist()


def compact_staging(spark: SparkSession, staging_path: str, metrics_path: str, fan: int = COMPACT_EVERY) -> None:
    """Fold what has gathered ``fan`` committed folders of one size."""

    def write_trips(run: str, names: list[str], name: str, lowest: bool) -> None:
        rows = read_folders(spark, staging_path, STAGING_FILES, names)
        write_bucketed(rows.select(*STAGING_COLUMNS), staging_path, name, rows.count())

    def write_metrics(run: str, names: list[str], name: str, lowest: bool) -> None:
        rows = read_folders(spark, metrics_path, BATCH_METRICS_SCHEMA, names).drop("run", "batch")
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{metrics_path}/{name}")

    fold(spark, staging_path, fan, write_trips)
    fold(spark, metrics_path, fan, write_metrics)
    # Filters of folders that are gone.
    drop_filters(spark, staging_path)


def run_of(spark: SparkSession, checkpoint_path: str) -> str:
    """The id of a query, which its checkpoint keeps for good: a fresh checkpoint is a new run."""
    written = spark.read.schema("id string").json(f"{checkpoint_path}/metadata").first()
    return written.id


def write_staging_stream(
    stream: DataFrame,
    staging_path: str,
    metrics_path: str,
    checkpoint_path: str,
    trigger: str = TRIGGER,
    output_mode: str = "append",
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Merge each micro-batch into the staging table and record its size.

    Folders are named by the query's own id, so no two checkpoints can write to one folder. One
    query at a time may write to a staging table.
    """

    @cache
    def run() -> str:
        return run_of(stream.sparkSession, checkpoint_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_batch(batch, batch_id, run(), staging_path, metrics_path)
        compact_staging(spark, staging_path, metrics_path, compact_every)

    writer = stream.writeStream.foreachBatch(write_batch)
    return start_writer(writer, checkpoint_path, trigger, output_mode)


REJECTS_SCHEMA = StructType([StructField("value", StringType()), StructField("reason", StringType())])


def read_rejects(spark: SparkSession, rejects_path: str) -> DataFrame:
    """``value, reason`` of refused messages, with the ``run`` and ``batch`` that refused them."""
    return read_batches(spark, rejects_path, REJECTS_SCHEMA)


def route_batch(
    judged: DataFrame, batch_id: int, run: str, staging_path: str, metrics_path: str, rejects_path: str,
    zone: str = SOURCE_ZONE,
) -> None:
    """Send one micro-batch of ``judged_messages`` two ways: valid events to staging, the others with their reason to the rejects.

    The messages are decoded once, and each is in one of the tables; a replayed batch changes neither.
    """
    keep = ("arrival",) if "arrival" in judged.columns else ()
    judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        refused = judged.where("reason != ''").select("value", "reason")
        name = f"run={run}/batch={batch_id}"
        if not Folder(judged.sparkSession, rejects_path).matches(f"{name}/_SUCCESS"):
            refused.hint("rebalance").write.mode("overwrite").parquet(f"{rejects_path}/{name}")
        trips = add_calendar(judged.where("reason = ''"), zone, keep)
        merge_batch(trips, batch_id, run, staging_path, metrics_path)
    finally:
        judged.unpersist()


def write_routed_stream(
    judged: DataFrame,
    staging_path: str,
    metrics_path: str,
    rejects_path: str,
    checkpoint_path: str,
    zone: str = SOURCE_ZONE,
    trigger: str = TRIGGER,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """A stream of ``judged_messages`` into the staging table and a table of rejects."""

    @cache
    def run() -> str:
        return run_of(judged.sparkSession, checkpoint_path)

    def write_rejects(spark: SparkSession) -> Callable:
        def write(run: str, names: list[str], name: str, lowest: bool) -> None:
            rows = read_folders(spark, rejects_path, REJECTS_SCHEMA, names).drop("run", "batch")
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{rejects_path}/{name}")

        return write

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        route_batch(batch, batch_id, run(), staging_path, metrics_path, rejects_path, zone)
        compact_staging(spark, staging_path, metrics_path, compact_every)
        fold(spark, rejects_path, compact_every, write_rejects(spark))

    return start_writer(judged.writeStream.foreachBatch(write_batch), checkpoint_path, trigger)


def merge_statements(ingest_table: str, target_table: str, metrics_table: str) -> tuple[str, ...]:
    """What runs in the database after a batch has been appended to the ingest table."""
    columns = ", ".join(STAGING_COLUMNS)
    return (
        f"insert into {target_table} ({columns}) select {columns} from {ingest_table}"
        " on conflict (trip_id) do nothing",
        f"truncate table {ingest_table}",
        f"insert into {metrics_table} (batch_id, records_received, processed_at)"
        " values (%s, %s, now()) on conflict (batch_id) do update set"
        " records_received = excluded.records_received, processed_at = excluded.processed_at",
    )


def write_jdbc_stream(
    stream: DataFrame,
    jdbc_url: str,
    ingest_table: str,
    target_table: str,
    user: str,
    password: str,
    checkpoint_path: str,
    connect: Callable[[], Any],
    trigger: str = TRIGGER,
    metrics_table: str = "analytics.streaming_batches",
    driver: str = "org.postgresql.Driver",
    connections: int = 16,
) -> StreamingQuery:
    """Merge each micro-batch into a PostgreSQL table.

    Executors append to an ingest table over at most ``connections`` connections; one
    transaction then merges by key, empties the ingest table and records the batch.
    ``connect`` gives a DB-API connection for that transaction.
    """
    merge, truncate, record = merge_statements(ingest_table, target_table, metrics_table)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records = batch.count()
            if records == 0:
                return
            (
                batch.select(*STAGING_COLUMNS)
                .write.format("jdbc")
                .option("url", jdbc_url)
                .option("dbtable", ingest_table)
                .option("user", user)
                .option("password", password)
                .option("driver", driver)
                .option("batchsize", JDBC_BATCH_ROWS)
                .option("numPartitions", connections)
                .mode("append")
                .save()
            )
            apply_merge(connect, (merge, truncate, record), batch_id, records)
        finally:
            batch.unpersist()

    return start_writer(stream.writeStream.foreachBatch(write_batch), checkpoint_path, trigger)


def apply_merge(
    connect: Callable[[], Any], statements: tuple[str, ...], batch_id: int, records: int
) -> None:
    """Run the merge statements in one transaction; an error leaves the tables as they were."""
    merge, truncate, record = statements
    connection = connect()
    try:
        cursor = connection.cursor()
        cursor.execute(merge)
        cursor.execute(truncate)
        cursor.execute(record, (batch_id, records))
        connection.commit()
    finally:
        connection.close()
