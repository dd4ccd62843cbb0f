"""Keyed JSON messages: the bus as source and sink, and its file twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from curbline.schema import EVENT_COLUMNS, TRIGGER


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str,
    starting_offsets: str = "earliest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Stream of one topic, or of several given as a comma list.

    The offsets apply to a first start only; a restart goes on from the checkpoint.
    ``max_offsets`` bounds a micro-batch and with it the ingest rate.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Stream of a Parquet file, folder or path pattern, at most so many files or bytes per
    micro-batch."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both")
    for limit in (max_files, max_bytes):
        if limit is not None and limit < 1:
            raise ValueError("a micro-batch limit must be at least 1")
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    path = path.rstrip("/")
    if not any(mark in path for mark in "*?[{"):
        # The source takes a folder or a pattern; as a pattern, the path may be a file too.
        path = f"{path[:-1]}[{path[-1]}]"
    return reader.parquet(path)


def message_payload(
    events: DataFrame, fields: tuple[str, ...] = EVENT_COLUMNS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Key and JSON value of each message; a null field stays in the JSON as null."""
    return events.select(
        F.col("trip_id").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        *keep,
    )


def publish_kafka(
    events: DataFrame, bootstrap_servers: str, topic: str, fields: tuple[str, ...] = EVENT_COLUMNS
) -> None:
    """Send a bounded set of events, keyed so that one trip stays in one topic partition.

    ``fields`` are what a message holds: ``("trip_id", *PARTIAL_FIELDS[role])`` for partial events.
    """
    writer = message_payload(events, fields).write.format("kafka")
    for key, value in _bus_options(bootstrap_servers, topic).items():
        writer = writer.option(key, value)
    writer.save()


def publish_kafka_stream(
    events: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint_path: str,
    fields: tuple[str, ...] = EVENT_COLUMNS,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Send a stream of events, such as assembled ones, with the same keys and payload."""
    writer = message_payload(events, fields).writeStream.format("kafka")
    for key, value in _bus_options(bootstrap_servers, topic).items():
        writer = writer.option(key, value)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint_path)
    return writer.trigger(processingTime=trigger).start()


def _bus_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "kafka.acks": "all", "topic": topic}
