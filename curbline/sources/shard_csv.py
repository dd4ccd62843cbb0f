"""Column shards kept as CSV: three narrow files that share trip_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from curbline.schema import SHARD_COLUMNS


def shard_schema(role: str) -> StructType:
    return StructType(
        [StructField(name, StringType()) for name in ("trip_id", *SHARD_COLUMNS[role])]
    )


def write_shard_csv(shards: dict[str, DataFrame], path: str) -> None:
    for role, shard in shards.items():
        shard.write.mode("overwrite").option("header", True).option("escape", '"').csv(
            f"{path}/{role}"
        )


def read_shard_csv(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Shards by role, as text; a file whose header differs fails the read."""
    return {
        role: spark.read.schema(shard_schema(role))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(f"{path}/{role}")
        for role in SHARD_COLUMNS
    }


def stream_shard_csv(
    spark: SparkSession, path: str, role: str, max_files: int | None = None
) -> DataFrame:
    """One shard as a stream of CSV files, at most ``max_files`` per micro-batch."""
    reader = (
        spark.readStream.schema(shard_schema(role))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(f"{path}/{role}")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The merged trips as written: five columns of a Parquet table."""
    return spark.read.parquet(path).select(
        "trip_id", "event_timestamp", "pickup_latitude", "pickup_longitude", "base"
    )
