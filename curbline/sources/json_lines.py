"""JSON-lines files of wire events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbline.schema import EVENT_COLUMNS, EVENT_SCHEMA


def write_json_lines(events: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """One object per line with all five fields, null ones written as null."""
    (
        events.select(*EVENT_COLUMNS, *partition_by)
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .partitionBy(*partition_by)
        .json(path)
    )


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).json(path)
