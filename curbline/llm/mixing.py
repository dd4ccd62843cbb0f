"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, its source's target over its
source's size. The documents of a source stand in one order; the prefix sum of their expected
copies, shifted by one random offset per source, crosses integer boundaries, and a document is
emitted once for each boundary that falls into its stretch. The order runs by size, so that
the copies spread evenly over short and long documents and the words taken come near the target.

The prefix sum never needs a source in one task: rows are numbered inside chunks (source, size,
slice of the ids), whose number follows the rows; the counts of the chunks are added up over the
slices of a size and then over the sizes of a source.

Defined cases: a null text has size 0; a null source is a source of its own, ordered last; documents of
a source of size 0 are not taken, its target is 0; a null doc_id stands before all others; repeated rows
are sampled one by one; an empty table gives an empty result. The documents travel inside one
struct, so the names of further columns cannot clash with those worked with here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import cut, word_count

#: Fixed values of the mix: weights by rank of the source, and the most copies of its size.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Rows that a slice of a size holds at most, unless ids gather in it; and the fewest slices.
SLICE_ROWS = 50_000
LEAST_SLICES = 16

CHUNK = ("source_key", "size", "slice")


def source_key(source: Column) -> Column:
    """A key that is never null; keys sort as sources do, null last."""
    return F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source_key, source_size, target`` for one row ``source_key, source_size`` per source.

    A target is level * weight, or ``most`` times the size where that is less. Sources stand in order of
    the level at which they reach that cap; if all before a source are capped, the rest of the words over
    the rest of the weights is a level, and the first source that it leaves under its cap sets it for all
    behind. One row per source, so windows without a key stay small.
    """
    rank = (F.row_number().over(Window.orderBy("source_key")) - 1) % len(weights)
    by_rank = F.array(*[F.lit(weight).cast("long") for weight in weights])
    weighed = sizes.withColumn("weight", F.element_at(by_rank, rank + 1))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * most
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    levels = weighed.withColumn("level", left / F.sum("weight").over(behind)).withColumn(
        "open", F.col("level") * F.col("weight") <= cap
    )
    first = F.min_by("level", F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), "source_key")))
    return levels.withColumn("level", first.over(Window.partitionBy())).select(
        "source_key",
        "source_size",
        F.when(F.col("open"), F.col("level") * F.col("weight")).otherwise(cap.cast("double")).alias("target"),
    )


def source_offset(key: Column, seed: int) -> Column:
    """The one random offset of a source, in [0, 1): the same in every run with the same seed."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}/"), key)), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**32))


def with_copies(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 0
) -> DataFrame:
    """``row`` (the document) and ``mix`` (size, source_size, target, copies) for every document."""
    slices = max(LEAST_SLICES, docs.count() // SLICE_ROWS)
    sliced = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        source_key(F.col("source")).alias("source_key"),
        word_count(F.col("text")).alias("size"),
        F.coalesce(F.pmod("doc_id", F.lit(slices)), F.lit(-1)).alias("slice"),
    )
    counts = cut(sliced.groupBy(*CHUNK).agg(F.count("*").alias("n")), "mix-chunks")
    sizes = counts.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, weights, most)
    by_size = counts.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    smaller = Window.partitionBy("source_key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("source_key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    of_size = by_size.select("source_key", "size", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("before"))
    starts = (
        counts.select(*CHUNK, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("inside"))
        .join(of_size, ["source_key", "size"])
        .join(targets, "source_key")
        .select(*CHUNK, (F.col("before") + F.col("inside")).alias("start"), "source_size", "target")
    )
    place = Window.partitionBy(*CHUNK).orderBy("row.doc_id", F.xxhash64("row.text"))
    position = F.col("start") + F.row_number().over(place)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = source_offset(F.col("source_key"), seed)
    copies = F.floor(F.col("position") * rate + offset) - F.floor((F.col("position") - 1) * rate + offset)
    return (
        sliced.join(starts, list(CHUNK))
        .withColumn("position", position)
        .select("row", F.struct("size", "source_size", "target", copies.alias("copies")).alias("mix"))
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 0
) -> DataFrame:
    """The mixed corpus: each document once per boundary that it crosses, its columns unchanged."""
    drawn = with_copies(docs, weights, most, seed).filter("mix.copies > 0")
    times = F.array_repeat(F.lit(0), F.col("mix.copies").cast("int"))
    return drawn.select("row", F.explode(times)).select("row.*")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return with_copies(docs).select(
        "row.doc_id",
        "mix.size",
        "mix.source_size",
        "mix.target",
        (F.col("mix.copies") * F.col("mix.size")).alias("taken"),
    )


#: The offset and the order of a source are spelled out; positions come from one window per source.
OP10_SQL = rf"""
with sized as (
  select doc_id, text, case when source is null then '2' else '1' || source end as k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    coalesce(((doc_id % s.m) + s.m) % s.m, -1) as slice
  from documents, (select greatest({LEAST_SLICES}, count(*) // {SLICE_ROWS}) as m from documents) s
), totals as (
  select k, sum(size)::bigint as source_size,
    [5, 2, 1][(row_number() over (order by k) - 1) % 3 + 1] as weight
  from sized group by k
), levels as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (
      order by source_size / weight, k rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (order by source_size / weight, k rows between current row and unbounded following))::double
    as level
  from totals
), opened as (
  select *, level * weight <= 3 * source_size as open from levels
), targets as (
  select k, source_size, case when open then weight * (
      select level from opened where open order by source_size / weight, k limit 1)
    else 3.0::double * source_size end::double as target
  from opened
), placed as (
  select s.*, t.source_size, t.target,
    ('0x' || substr(md5('0/' || s.k), 1, 8))::bigint / 4294967296.0::double as u,
    case when t.source_size > 0 then t.target / t.source_size::double else 0 end as rate,
    row_number() over (partition by s.k order by size, slice, doc_id) as position
  from sized s join targets t using (k)
)
select doc_id, size, source_size, target,
  (floor(position * rate + u) - floor((position - 1) * rate + u))::bigint * size as taken
from placed
"""
