"""Records of CSV files with quoted line breaks, each file read by many tasks.

A task that reads a byte range cannot know whether it starts inside a quoted field. So each range is read under both
assumptions at once: a line maps the state before it (outside or inside quotes) to the state after it, these maps
compose, and after the first field that ends in both readings they agree. One row per range says where it ends from
either start; those rows, in order, tell how every range really begins, and with it which lines begin a record.

A quote opens a field only at its start; inside, two quotes are one, and a single one closes the field.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most bytes of one record. A quote that is never closed would make the rest of its file one field.
LONGEST_RECORD = 64 * 1024**2

BLOCK = ("src_file", "src_block")

_QUOTED = rb'[^"]*+(?:""[^"]*+)*+'
# A field that ends on its line, and one that is open at the end of it.
_FIELD = re.compile(rb'(?:"' + _QUOTED + rb'"[^,]*+|(?!")[^,]*+)(?:,|\Z)')
_OPEN = re.compile(rb'"' + _QUOTED + rb"\Z")
_REST = re.compile(_QUOTED + rb'(?:"[^,]*+(?:,|\Z)|\Z)')


def state_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open behind the line, given whether one was before it."""
    at = 0
    if inside:
        at = _REST.match(line).end()
        if at == len(line):
            # The field's end, or no closing quote at all: an odd one closes it.
            body = re.match(_QUOTED, line).end()
            return body == len(line)
    while at < len(line):
        if line[at] == 0x22 and _OPEN.match(line, at):
            return True
        at = _FIELD.match(line, at).end()
    return False


_LINES = (
    "src_file string, src_block long, src_seq long, value binary, "
    "starts array<boolean>, ahead array<long>, opens array<boolean>"
)


def _both_readings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds, for a range that begins outside quotes and one that begins inside, whether the line begins a record,
    how many records of the range begin before it, and whether a field is open behind it."""
    block: tuple | None = None
    state, count = [False, True], [0, 0]
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        lines = batch["value"]
        quoted = pc.greater(pc.count_substring(lines, b'"'), 0).to_numpy(zero_copy_only=False)
        blank = np.isin(pc.binary_length(lines).to_numpy(), (0, 1))
        blank[blank] = [x in (b"", b"\r") for x in lines.filter(pa.array(blank)).to_pylist()]
        # Rows of a range lie together, and rows between two with quotes share their state.
        starts_at = batch["src_block"].to_numpy()
        files = batch["src_file"].dictionary_encode()
        codes, names = files.indices.to_numpy(), files.dictionary.to_pylist()
        fresh = np.ones(rows, bool)
        fresh[1:] = (starts_at[1:] != starts_at[:-1]) | (codes[1:] != codes[:-1])
        before, after = np.zeros((rows, 2), bool), np.zeros((rows, 2), bool)
        stops = np.flatnonzero(fresh | quoted).tolist()
        totals = np.zeros((rows, 2), np.int64)
        borders = [0, *[x for x in stops if x], rows]
        for first, end in zip(borders, borders[1:], strict=False):
            name = (names[codes[first]], int(starts_at[first]))
            if fresh[first] and name != block:
                block, state, count = name, [False, True], [0, 0]
            before[first] = state
            if quoted[first]:
                line = lines[first].as_py().removesuffix(b"\r")
                one = state_after(line, state[0])
                state = [one, one if state[0] == state[1] else state_after(line, state[1])]
            before[first + 1 : end] = state
            after[first:end] = state
            begins = ~before[first:end] & ~blank[first:end, None]
            totals[first:end] = np.cumsum(begins, axis=0) - begins + count
            count = (totals[end - 1] + begins[-1]).tolist()
        offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * 2)
        pairs = (~before & ~blank[:, None], totals, after)
        added = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in pairs]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *added], [*batch.schema.names, "starts", "ahead", "opens"]
        )


def land_lines(spark: SparkSession, path: str, table: str) -> None:
    """The lines of a file or folder, read once, each with both readings; ``table`` is a shared work folder."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_seq"),
        F.col("value").cast("binary").alias("value"),
    )
    lines.mapInArrow(_both_readings, _LINES).write.parquet(f"{table}/lines")


def block_starts(lines: DataFrame) -> DataFrame:
    """``src_file, src_block, inside`` (0 or 1), ``in_file`` (records of the file that begin before the block) and ``files_before``
    (records but for headers of the files before).

    One row per byte range is ordered. A range either ends alike from both starts, or it keeps or turns the state.
    """
    ends = lines.groupBy(*BLOCK).agg(F.max_by(F.struct("opens", "ahead", "starts"), "src_seq").alias("end"))
    one, other = (F.col("end.opens")[n].cast("int") for n in (0, 1))
    total = F.zip_with("end.ahead", "end.starts", lambda ahead, starts: ahead + starts.cast("long"))
    before = Window.partitionBy("src_file").orderBy("src_block").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(((one == 1) & (other == 0)).cast("int")).over(before), F.lit(0))
    known = ends.select(*BLOCK, total.alias("total"), (one == other).alias("fixed"), one.alias("one"), turns.alias("turned"))
    fixed = F.last(F.when(F.col("fixed"), F.col("one") + F.col("turned")), ignorenulls=True).over(before)
    known = known.withColumn("inside", ((F.coalesce(fixed, F.lit(0)) + F.col("turned")) % 2).cast("int"))
    known = known.withColumn("rows", F.col("total")[F.col("inside")])
    earlier = Window.orderBy("src_file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        known.groupBy("src_file")
        .agg(F.greatest(F.sum("rows") - 1, F.lit(0)).alias("rows"))
        .select("src_file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("files_before"))
    )
    in_file = F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("in_file")
    return known.select(*BLOCK, "inside", in_file).join(files, "src_file")


def read_records(spark: SparkSession, path: str, table: str, longest: int = LONGEST_RECORD) -> DataFrame:
    """``src_file, place, row_number, record``: every record as text, its place in its file and, headers left out, among all.

    Both count from 1, so a header has place 1 and the number of the row before it. Blank lines between records count nowhere.
    Line breaks inside a field become ``\\n``. Files count in order of their path as text. A record above ``longest`` bytes, as a
    quote that is never closed makes it, is an error.
    """
    land_lines(spark, path, table)
    lines = spark.read.parquet(f"{table}/lines")
    block_starts(lines).write.parquet(f"{table}/blocks")
    starts, ahead, opens = (F.col(name)[F.col("inside")] for name in ("starts", "ahead", "opens"))
    # A line that begins no record is part of the last one that began, in whatever range.
    place = F.col("in_file") + ahead + starts.cast("long")
    key = ["src_file", "place", "row_number"]
    numbered = lines.join(spark.read.parquet(f"{table}/blocks"), list(BLOCK)).select(
        *BLOCK,
        "src_seq",
        place.alias("place"),
        (F.col("files_before") + place - 1).alias("row_number"),
        starts.alias("starts"),
        opens.alias("opens"),
        F.regexp_replace(F.col("value").cast("string"), "\\r$", "").alias("record"),
    )
    whole = numbered.filter("starts and not opens").select(*key, "record")
    # What neither begins a record nor leaves one open is the end of one, or a blank line outside quotes.
    parts = numbered.filter("opens or (not starts and record <> '')")
    longer = parts.groupBy(*key).agg(F.sum(F.octet_length("record")).alias("bytes")).filter(F.col("bytes") > longest)
    for row in longer.orderBy(*key).limit(1).collect():
        raise ValueError(f"{row.src_file}: record {row.place} has over {longest} bytes: is a quote left open?")
    ordered = F.sort_array(F.collect_list(F.struct("src_block", "src_seq", "record")))["record"]
    joined = parts.groupBy(*key).agg(F.array_join(ordered, "\n").alias("record"))
    return whole.unionByName(joined)
