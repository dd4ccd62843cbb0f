"""Column shards as tables bucketed by trip_id, so that they lie together.

A shard's valid rows are reduced to one per id, with the number of its ``copies``, and written as one sorted file per bucket. Equal
ids of all shards are in the bucket of one number: the three-way join, the listing of orphans and the search for repeated ids read
bucket by bucket and move no row. A shard that comes once and is read often pays its exchange at the write.

Choose ``buckets`` so that a bucket of a shard has some 100 MB: a bucket is a task. The number is part of the folder's name, because a
table opened with another number would look for its ids in the wrong place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from curbline.functions import clock
from curbline.operators.shards import valid_rows
from curbline.schema import EVENT_COLUMNS, PARTIAL_FIELDS, SHARD_COLUMNS, SOURCE_ZONE, STAGING_SCHEMA

COPIES = StructField("copies", LongType())


def _folder(path: str, role: str, buckets: int) -> str:
    return f"{path}/{role}-{buckets}"


def _one_per_id(rows: DataFrame) -> DataFrame:
    """One row per id, the first by its other columns, and how often the id came; copies of a hot id shrink before the shuffle."""
    rest = [name for name in rows.columns if name != "trip_id"]
    counted = rows.groupBy("trip_id").agg(F.min(F.struct(*rest)).alias("first_row"), F.count(F.lit(1)).alias("copies"))
    return counted.select("trip_id", *[F.col(f"first_row.{name}").alias(name) for name in rest], "copies")


def write_shard_tables(
    shards: dict[str, DataFrame], path: str, name: str, buckets: int, zone: str = SOURCE_ZONE
) -> dict[str, DataFrame]:
    """Write the valid rows of each shard below ``path`` and give the tables, which the session knows as ``<name>_<role>``."""
    spark = next(iter(shards.values())).sparkSession
    for role in SHARD_COLUMNS:
        # By the hash that deals buckets, so that each task writes one file.
        dealt = _one_per_id(valid_rows(role, shards[role], zone)).repartition(buckets, "trip_id")
        writer = dealt.write.mode("overwrite").bucketBy(buckets, "trip_id").sortBy("trip_id")
        writer.option("path", _folder(path, role, buckets)).saveAsTable(f"{name}_{role}")
    return {role: spark.table(f"{name}_{role}") for role in SHARD_COLUMNS}


def open_shard_tables(spark: SparkSession, path: str, name: str, buckets: int) -> dict[str, DataFrame]:
    """The tables below ``path`` in a session that does not know them yet; another number of buckets than theirs is an error."""
    for role in SHARD_COLUMNS:
        folder = _folder(path, role, buckets)
        spark.read.schema("trip_id string").parquet(folder)  # fails where there is none
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in table_schema(role))
        quoted = folder.replace("'", "\\'")
        spark.sql(
            f"create table if not exists {name}_{role} ({columns}) using parquet"
            f" clustered by (trip_id) sorted by (trip_id) into {buckets} buckets location '{quoted}'"
        )
    return {role: spark.table(f"{name}_{role}") for role in SHARD_COLUMNS}


def table_schema(role: str) -> StructType:
    return StructType([*[STAGING_SCHEMA[name] for name in ("trip_id", *PARTIAL_FIELDS[role])], COPIES])


def join_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Canonical events of the ids in every shard; no row is moved."""
    parts = [tables[role].drop("copies") for role in SHARD_COLUMNS]
    joined = reduce(lambda left, right: left.join(right, "trip_id"), parts)
    return joined.withColumn("event_timestamp", clock.iso_utc(F.col("event_timestamp"))).select(*EVENT_COLUMNS)


def repeated_ids(tables: dict[str, DataFrame]) -> DataFrame:
    """``role, trip_id, copies`` of ids that came more than once in a shard."""
    found = [
        tables[role].where("copies > 1").select(F.lit(role).alias("role"), "trip_id", "copies") for role in SHARD_COLUMNS
    ]
    return reduce(DataFrame.unionByName, found)


def orphans_of_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Ids absent from at least one shard, with a flag per shard.

    Each pair of shards is held against each other, since a full join forgets how its sides are dealt: an orphan is listed by the
    first shard that has it, and semi and anti joins keep the buckets.
    """
    ids = {role: tables[role].select("trip_id") for role in SHARD_COLUMNS}
    flag = {role: ids[role].withColumn(f"in_{role}", F.lit(True)) for role in SHARD_COLUMNS}
    roles = list(SHARD_COLUMNS)
    listed = []
    for place, role in enumerate(roles):
        own = ids[role]
        for earlier in roles[:place]:
            own = own.join(ids[earlier], "trip_id", "left_anti")
        for later in roles[place + 1 :]:
            own = own.join(flag[later], "trip_id", "left")
        present = [
            (F.lit(other == role) if roles.index(other) <= place else F.coalesce(f"in_{other}", F.lit(False))).alias(f"in_{other}")
            for other in roles
        ]
        listed.append(own.select("trip_id", *present))
    every = reduce(DataFrame.unionByName, listed)
    return every.where(~reduce(lambda a, b: a & b, [F.col(f"in_{role}") for role in roles]))
