"""Raw trip CSV with a 1-based source row number that counts bad rows too."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curbline.schema import RAW_COLUMNS
from curbline.sources.quoted_csv import read_records

_CHUNK = ("src_file", "src_block")


def header_schema(spark: SparkSession, path: str) -> StructType:
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    return StructType([StructField(name, StringType()) for name in header])


def _picked(schema: StructType, columns: tuple[str, ...], of: str = "") -> list[Column]:
    """Columns by header name; one the header lacks is null in every row."""
    return [
        (F.col(f"{of}`{name}`") if name in schema.names else F.lit(None).cast("string")).alias(name)
        for name in columns
    ]


def scan_csv(
    spark: SparkSession, path: str, columns: tuple[str, ...], multi_line: bool = True
) -> DataFrame:
    """Text columns picked by header name; one the header lacks is null in every row.

    Types are never inferred. All files must carry the same header. With ``multi_line``, one task reads a file.
    """
    schema = header_schema(spark, path)
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return rows.select(
        *_picked(schema, columns),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
    )


def land_csv(spark: SparkSession, path: str, table: str) -> None:
    """Copy a CSV of one line a row into Parquet, each row tagged with its file, block and sequence.

    Later reads cannot cut the files differently, since the tags are stored, and they
    read only the columns they need. One task reads a block from start to end, so
    ``src_seq`` is gapless and in file order within a block.
    """
    rows = scan_csv(spark, path, RAW_COLUMNS, multi_line=False)
    rows.withColumn("src_seq", F.monotonically_increasing_id()).write.mode("overwrite").parquet(
        f"{table}/rows"
    )


def number_landed(spark: SparkSession, table: str) -> DataFrame:
    """Turn (file, block, sequence) into a global row number without sorting any row.

    Only block counts are ordered: one row per file split. Their offsets are written
    out, so the planner knows the real size when it picks the join.
    """
    rows = spark.read.parquet(f"{table}/rows")
    blocks = rows.groupBy(*_CHUNK).agg(
        F.min("src_seq").alias("first_seq"), F.count(F.lit(1)).alias("block_rows")
    )
    before_file = Window.orderBy("src_file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        blocks.groupBy("src_file")
        .agg(F.sum("block_rows").alias("file_rows"))
        .select("src_file", F.coalesce(F.sum("file_rows").over(before_file), F.lit(0)).alias("ahead"))
    )
    before_block = (
        Window.partitionBy("src_file")
        .orderBy("src_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    in_file = F.coalesce(F.sum("block_rows").over(before_block), F.lit(0))
    blocks.join(files, "src_file").select(
        *_CHUNK, (F.col("ahead") + in_file + 1 - F.col("first_seq")).alias("shift")
    ).write.mode("overwrite").parquet(f"{table}/offsets")
    offsets = spark.read.parquet(f"{table}/offsets")
    return rows.join(offsets, list(_CHUNK)).select(
        (F.col("src_seq") + F.col("shift")).alias("row_number"),
        *[F.col(f"`{name}`") for name in RAW_COLUMNS],
    )


def land_records(spark: SparkSession, path: str, table: str) -> None:
    """Copy the CSV into Parquet with row numbers, quoted line breaks kept; every file is read by many tasks."""
    schema = header_schema(spark, path)
    records = read_records(spark, path, table).withColumn("row", F.from_csv("record", schema.json(), {"escape": '"'}))
    titles = [F.col(f"row.`{name}`") for name in schema.names]
    # The reader names an empty title by its position, and adds that to one that stands twice.
    same = [
        F.coalesce(F.lower(title) == name.lower(), F.lit(name == f"_c{at}")) | (F.concat(title, F.lit(str(at))) == name)
        for at, (title, name) in enumerate(zip(titles, schema.names, strict=True))
    ]
    known = reduce(Column.__and__, same)
    wrong = F.raise_error(F.concat(F.lit("another header than the first file's: "), F.col("src_file")))
    body = F.when(F.col("place") > 1, F.lit(True)).when(known, F.lit(False)).otherwise(wrong.cast("boolean"))
    rows = records.filter(body).select("row_number", *_picked(schema, RAW_COLUMNS, "row."))
    rows.write.mode("overwrite").parquet(f"{table}/rows")


def read_raw_csv(
    spark: SparkSession, path: str, table: str, multi_line: bool = True
) -> DataFrame:
    """Numbered raw rows of a CSV file or folder; ``table`` is a shared work folder.

    A quoted line break is part of its field. For files known to have none, ``multi_line=False`` saves the search for
    quotes. Many tasks share a file either way. Files count in order of their path as text: pad numbers in their names.
    """
    if multi_line:
        land_records(spark, path, table)
        return spark.read.parquet(f"{table}/rows")
    land_csv(spark, path, table)
    return number_landed(spark, table)
