"""Bloom filters beside the batches of a keyed table: which folders may hold which keys.

A filter is a table of lines of eight 64-bit words, ``KEYS_PER_LINE`` keys to a line on average; the number of lines is in its folder's name.
A key sets two bits in every word of the one line that it hashes to, so a look-up is one equi-join on (folder, bucket, line), and less than 1
in 10^5 keys that a folder has not seems to be there: its files are then read, and the keys compared exactly. All of it is built-in columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from curbline.streaming.batches import Folder, read_folders

KEYS_PER_LINE = 12
WORDS = [f"word{n}" for n in range(8)]
HASHES = ["hash1", "hash2"]
# Keys that are asked about first, of a batch that has many.
FIRST_ASKED = 100_000
FILTERS = StructType([StructField(n, LongType()) for n in ("bucket", "line", *WORDS, "lines")])


def filters_path(path: str) -> str:
    return f"{path}/_filters"


def hashes_of(key: str) -> list[Column]:
    """What tells the bits of a key; this much of it is moved, not the eight words."""
    return [F.xxhash64(F.lit(salt), key).alias(name) for salt, name in enumerate(HASHES, 1)]


def masks() -> list[Column]:
    """The bits of a key in each word, from its two hashes."""
    out = []
    for place in range(len(WORDS)):
        bits = [
            F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hash_, 7 * place).bitwiseAND(63).cast("int"))
            for hash_ in HASHES
        ]
        out.append(bits[0].bitwiseOR(bits[1]))
    return out


def line_of(key: str, lines: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), key), lines)


def write_filter(keys: DataFrame, path: str, name: str, rows: int, buckets: int, key: str = "trip_id") -> None:
    """Write the filter of a folder, before the folder itself: of ``keys`` (the key and ``bucket``), some ``rows`` of them."""
    lines = max(1, -(-rows // (buckets * KEYS_PER_LINE)))
    # A task has few keys of a line: gathering them by line first moves less than words filled in part.
    hashed = keys.select("bucket", line_of(key, F.lit(lines)).alias("line"), *hashes_of(key)).repartition("bucket", "line")
    filled = hashed.groupBy("bucket", "line").agg(*[F.bit_or(mask).alias(word) for word, mask in zip(WORDS, masks(), strict=True)])
    filled.sortWithinPartitions("bucket", "line").write.mode("overwrite").parquet(f"{filters_path(path)}/{name}/lines={lines}")


def may_hold(
    spark: SparkSession, path: str, keys: DataFrame, names: list[str], key: str = "trip_id", many: int = 0, buckets: int = 0
) -> tuple[list[str], list[int] | None]:
    """Those of the folders ``names`` that may hold one of ``keys`` (the key and ``bucket``), and the buckets to look in.

    Only names and bucket numbers come to the driver. A folder without a filter may hold anything, in any bucket (None).
    Of ``many`` keys, some are asked about first: one key tells of its bucket in a folder, and the others are asked
    about only where none has; ``buckets`` is how many a folder has, if known.
    """
    complete = Folder(spark, filters_path(path)).matches("run=*/batch=*/lines=*/_SUCCESS")
    lines_of = {found.rsplit("/", 2)[0]: int(found.rsplit("/", 2)[1].removeprefix("lines=")) for found in complete}
    known = [name for name in names if name in lines_of]
    unknown = [name for name in names if name not in lines_of]
    if not known:
        return unknown, None
    held: dict[str, set[int]] = {name: set() for name in known}
    shares = max(1, many // FIRST_ASKED)
    share = F.pmod(F.xxhash64(F.lit(4), key), F.lit(shares))
    for asked in (keys.where(share == 0), keys.where(share != 0)) if shares > 1 else (keys,):
        open_ = [name for name in known if not buckets or len(held[name]) < buckets]
        if open_:
            for place, bucket in _hits(spark, path, asked, {name: (lines_of[name], held[name]) for name in open_}, key):
                held[open_[place]].add(bucket)
    hits = sorted(name for name in known if held[name])
    return unknown + hits, None if unknown else sorted(set().union(*held.values()))


def _hits(
    spark: SparkSession, path: str, keys: DataFrame, folders: dict[str, tuple[int, set[int]]], key: str
) -> list[tuple[int, int]]:
    """Place among ``folders`` (its lines, and buckets not to ask about) and bucket of what may be held."""
    filters = read_folders(spark, filters_path(path), FILTERS, [f"{name}/lines={lines}" for name, (lines, _) in folders.items()])
    places = F.create_map(*[F.lit(part) for place, name in enumerate(folders) for part in (name, place)])
    placed = filters.withColumn("place", places[F.concat(F.lit("run="), "run", F.lit("/batch="), "batch")])
    asked = F.array(*[
        F.struct(F.lit(place).alias("place"), F.lit(lines).alias("lines"),
                 F.array(*[F.lit(bucket) for bucket in sorted(held)]).cast("array<bigint>").alias("held"))
        for place, (lines, held) in enumerate(folders.values())
    ])
    asking = (
        keys.select("bucket", key, F.explode(asked).alias("folder"))
        .where(~F.array_contains("folder.held", F.col("bucket")))
        .select("folder.place", "bucket", line_of(key, F.col("folder.lines")).alias("line"), *hashes_of(key))
    )
    hit = reduce(lambda a, b: a & b, [F.col(word).bitwiseAND(mask) == mask for word, mask in zip(WORDS, masks(), strict=True)])
    found = asking.join(placed, ["place", "bucket", "line"]).filter(hit).select("place", "bucket").distinct().collect()
    return [(row.place, row.bucket) for row in found]


def drop_filters(spark: SparkSession, path: str) -> None:
    """Delete the filters of folders that have been folded and deleted."""
    kept = {found.rpartition("/")[0] for found in Folder(spark, path).matches("run=*/batch=*/_SUCCESS")}
    filters = Folder(spark, filters_path(path))
    for name in filters.matches("run=*/batch=*"):
        if name not in kept:
            filters.delete(name)
