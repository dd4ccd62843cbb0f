"""Ready-made streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from curbline.operators.enrich import arrival_of, judged_messages, transform_messages
from curbline.schema import SOURCE_ZONE, TRIGGER
from curbline.streaming.sinks import write_parquet_stream, write_routed_stream, write_staging_stream


def start_trip_queries(
    messages: DataFrame,
    lake_path: str,
    staging_path: str,
    metrics_path: str,
    checkpoint_root: str,
    zone: str = SOURCE_ZONE,
    trigger: str = TRIGGER,
    rejects_path: str | None = None,
) -> list[StreamingQuery]:
    """One transformed stream into two sinks, each with its own checkpoint; refused messages to ``rejects_path``, if given."""
    arrived = arrival_of(messages)
    trips = transform_messages(arrived, zone, ("arrival",))
    lake = write_parquet_stream(trips.drop("arrival"), lake_path, f"{checkpoint_root}/lake", trigger)
    checkpoint = f"{checkpoint_root}/staging"
    if rejects_path is None:
        return [lake, write_staging_stream(trips, staging_path, metrics_path, checkpoint, trigger)]
    judged = judged_messages(arrived, zone, ("arrival",))
    return [lake, write_routed_stream(judged, staging_path, metrics_path, rejects_path, checkpoint, zone, trigger)]


def run_until_one_ends(spark: SparkSession) -> None:
    """Block until any query of the session ends, and raise what it failed with."""
    spark.streams.awaitAnyTermination()
