"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.session import work_dir

T = TypeVar("T")
#: Fixed value: a word, as the contracts of several operators define it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(frame: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that its lineage ends there.

    A lost executor then costs the reading of a file, and steps that use the frame several
    times do not work it out again.
    """
    path = work_dir(frame.sparkSession, label)
    writer = frame.write.partitionBy(*partition_by) if partition_by else frame.write
    writer.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_HELD: dict[tuple[str, str], object] = {}


def held(kind: str, key: str, make: Callable[[], T]) -> T:
    """The one large helper of this Python worker, such as a cache of words: others are let go first.

    Workers live on from stage to stage, and their memory would add up.
    """
    if (kind, key) not in _HELD:
        _HELD.clear()
        _HELD[kind, key] = make()
    return _HELD[kind, key]


def release() -> None:
    """Let go of the helper of an earlier stage, at the start of work that needs none."""
    _HELD.clear()


def word_count(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return [text or "" for text in column.to_pylist()]


def small_batches(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts together take about ``most_bytes``, or hold one row."""
    lengths = pc.binary_length(batch[column]).fill_null(0).to_pylist()
    start, taken = 0, 0
    for row, length in enumerate(lengths):
        if row > start and taken + length > most_bytes:
            yield batch.slice(start, row - start)
            start, taken = row, 0
        taken += length
    if len(lengths) > start:
        yield batch.slice(start)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row is in the fold that is not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample_per_label(labelled: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` rows of each label, those whose ``doc_id`` hashes lowest.

    Labels are counted first, so that only about as many rows as are wanted are sorted.
    """
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    sizes = labelled.groupBy(label).agg(F.count("*").alias("n")).collect()
    share = F.lit(0)
    for row in sizes:
        bound = int((1 << 30) * min(1.0, (1.2 * most + 200) / row["n"]))
        share = F.when(F.col(label) == row[label], bound).otherwise(share)
    order = Window.partitionBy(label).orderBy(hashed, "doc_id", F.xxhash64(*labelled.columns))
    few = labelled.filter(hashed < share)
    return few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """``node, component`` (its smallest node) for undirected ``a, b`` edges.

    Alternating large-star and small-star steps: every step is a grouped minimum, which is
    added up before the shuffle, and a join on the node that adaptive execution splits where
    a node is a hub. Each round is written to the shared folder, until every node has one edge and
    leads to a node without one; the driver sees nothing but that.
    Loops, repeated edges and nulls are allowed and ignored. Nodes without an edge are left out.
    """
    links = cut(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{label}-links",
    )
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # Large star: neighbours above a node go to the smallest one it knows.
        large = (
            links.select(F.col("b").alias("a"), F.col("a").alias("above"))
            .join(lowest, "a")
            .select(F.col("above").alias("a"), F.col("low").alias("b"))
            .filter("a != b")
            .distinct()
        )
        large = cut(large, f"{label}-large")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b")
        links = cut(moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct(), f"{label}-small")
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        open_ = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if open_.filter("out > 1 or (out > 0 and into > 0)").isEmpty():
            break
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
