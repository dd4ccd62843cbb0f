"""Split trips by column, and put them back together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import clock, text
from curbline.functions.identity import trip_id
from curbline.operators.merge import one_per_key
from curbline.operators.once import unpack_once
from curbline.schema import (
    EVENT_COLUMNS,
    ID_PREFIX,
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    PARTIAL_FIELDS,
    RAW_COLUMNS,
    SHARD_COLUMNS,
    SOURCE_ZONE,
)


def with_trip_id(rows: DataFrame, prefix: str = ID_PREFIX) -> DataFrame:
    """Raw rows with the raw-text id; bad rows get one too."""
    return rows.withColumn(
        "trip_id",
        trip_id(
            F.col("row_number"),
            *[text.strip(F.col(f"`{name}`")) for name in RAW_COLUMNS],
            prefix,
        ),
    )


def land_keyed(rows: DataFrame, folder: str, prefix: str = ID_PREFIX) -> DataFrame:
    """Raw rows with their id, written once: each id is hashed once, however often rows are read."""
    keyed = with_trip_id(rows, prefix)
    keyed.write.mode("overwrite").parquet(folder)
    return keyed.sparkSession.read.schema(keyed.schema).parquet(folder)


def split_columns(
    rows: DataFrame, prefix: str = ID_PREFIX, keep: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """One narrow frame per role, fields as in the source; ``keep`` columns go into each.

    Each shard is its own pruned scan: give rows of a columnar table, not of a CSV, and rows that
    have their id already, as ``land_keyed`` gives them, to hash it once for all shards.
    """
    keyed = rows if "trip_id" in rows.columns else with_trip_id(rows, prefix)
    return {
        role: keyed.select("trip_id", *[F.col(f"`{n}`") for n in names], *keep)
        for role, names in SHARD_COLUMNS.items()
    }


def parse_shard(
    role: str, shard: DataFrame, zone: str = SOURCE_ZONE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed fields of one shard with ``is_valid``, by the checks that role can make.

    The timestamp is an instant here; on the wire it is text.
    """
    stripped = shard.select(
        *[
            text.strip(F.col(f"`{name}`")).alias(name)
            for name in ("trip_id", *SHARD_COLUMNS[role])
        ],
        *keep,
    )
    if role == "datetime":
        stripped = stripped.withColumn("local", clock.parse_slash_date_time(F.col("`Date/Time`")))
        fields = {"event_timestamp": clock.local_to_instant(F.col("local"), zone)}
        sound = F.col("event_timestamp").isNotNull()
    elif role == "latitude":
        fields = {"pickup_latitude": text.number(F.col("Lat"))}
        sound = F.col("pickup_latitude").between(*LATITUDE_RANGE)
    else:
        fields = {"pickup_longitude": text.number(F.col("Lon")), "base": F.col("Base")}
        sound = F.col("pickup_longitude").between(*LONGITUDE_RANGE) & (F.col("base") != "")
    parsed = F.struct("trip_id", *[value.alias(name) for name, value in fields.items()])
    valid = F.coalesce(sound & (F.col("trip_id") != ""), F.lit(False))
    return unpack_once(stripped, parsed, keep).withColumn("is_valid", valid)


# What is wrong with a row that a role refuses, by the field to blame.
_REASONS = {"datetime": "bad time", "latitude": "bad latitude"}


def rejected_shard_rows(role: str, shard: DataFrame, zone: str = SOURCE_ZONE) -> DataFrame:
    """``trip_id`` and ``reason`` of the rows of one shard that its checks refuse."""
    refused = parse_shard(role, shard, zone).where(~F.col("is_valid"))
    no_id = F.coalesce(F.col("trip_id"), F.lit("")) == ""
    if role == "longitude_base":
        far = ~F.coalesce(F.col("pickup_longitude").between(*LONGITUDE_RANGE), F.lit(False))
        wrong = F.when(far, "bad longitude").otherwise("no base")
    else:
        wrong = F.lit(_REASONS[role])
    reason = F.when(no_id, "no id").otherwise(wrong)
    return refused.select("trip_id", reason.alias("reason"))


def valid_rows(role: str, shard: DataFrame, zone: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of one shard that pass its checks."""
    return parse_shard(role, shard, zone, keep).where("is_valid").drop("is_valid")


def _to_wire(typed: DataFrame) -> DataFrame:
    if "event_timestamp" not in typed.columns:
        return typed
    return typed.withColumn("event_timestamp", clock.iso_utc(F.col("event_timestamp")))


def partial_events(
    role: str, shard: DataFrame, zone: str = SOURCE_ZONE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Valid partial events of one shard."""
    return _to_wire(valid_rows(role, shard, zone, keep))


def project_partial(events: DataFrame, role: str) -> DataFrame:
    """The part of complete events that one role carries."""
    return events.select("trip_id", *PARTIAL_FIELDS[role])


def join_shards(shards: dict[str, DataFrame], unique_keys: bool = False) -> DataFrame:
    """Rows whose id is in every shard, one per id.

    Repeated ids in a shard are reduced to one row first, by a pre-aggregation that also
    lays the shard out for the join; a hot id then cannot multiply. Pass ``unique_keys``
    where the shards are known to hold each id once, to save that step.
    """
    parts = [shards[role] for role in SHARD_COLUMNS]
    if not unique_keys:
        parts = [one_per_key(part, "trip_id") for part in parts]
    return reduce(lambda left, right: left.join(right, "trip_id"), parts)


def merge_shards(
    shards: dict[str, DataFrame], zone: str = SOURCE_ZONE, unique_keys: bool = False
) -> DataFrame:
    """Canonical events from joined shards, each shard validated before the join.

    An id that fails in one shard drops out, as it would if checked after the join. Numbers
    and times are joined as such and not as text, which hashes them in place.
    """
    parts = {role: valid_rows(role, shards[role], zone) for role in SHARD_COLUMNS}
    return _to_wire(join_shards(parts, unique_keys)).select(*EVENT_COLUMNS)


def _tagged_ids(shards: dict[str, DataFrame]) -> DataFrame:
    tagged = [
        shards[role].select("trip_id", F.lit(1 << bit).alias("shard_bit"))
        for bit, role in enumerate(SHARD_COLUMNS)
    ]
    return reduce(DataFrame.unionByName, tagged)


def orphan_ids(shards: dict[str, DataFrame]) -> DataFrame:
    """Ids absent from at least one shard, with a flag per shard."""
    seen = _tagged_ids(shards).groupBy("trip_id").agg(F.bit_or("shard_bit").alias("seen"))
    return seen.where(F.col("seen") != (1 << len(SHARD_COLUMNS)) - 1).select(
        "trip_id",
        *[
            (F.col("seen").bitwiseAND(1 << bit) != 0).alias(f"in_{role}")
            for bit, role in enumerate(SHARD_COLUMNS)
        ],
    )


def reconcile(shards: dict[str, DataFrame]) -> DataFrame:
    """One row: rows per shard, distinct ids, ids complete in all shards, orphans."""
    full = (1 << len(SHARD_COLUMNS)) - 1
    per_id = (
        _tagged_ids(shards)
        .groupBy("trip_id")
        .agg(
            F.bit_or("shard_bit").alias("seen"),
            *[
                F.count_if(F.col("shard_bit") == 1 << bit).alias(f"{role}_rows")
                for bit, role in enumerate(SHARD_COLUMNS)
            ],
        )
    )
    return per_id.agg(
        *[F.coalesce(F.sum(f"{role}_rows"), F.lit(0)).alias(f"{role}_rows") for role in SHARD_COLUMNS],
        F.count(F.lit(1)).alias("distinct_ids"),
        F.count_if(F.col("seen") == full).alias("merged_ids"),
        F.count_if(F.col("seen") != full).alias("orphan_ids"),
    )
