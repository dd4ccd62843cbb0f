"""Tables that micro-batches write, a folder per run and batch, folded by size.

A folder is ``run=<id>/batch=<number>`` or, folded, ``batch=<first>-<last>``, and counts once its ``_SUCCESS`` stands. A fold
is written beside the folders it holds, which count no longer from the moment it is complete; they are deleted at the next
fold, so that readers who have listed them can finish. Readers see every stored row once at any time, whatever is cut short.

Folds are of like size: ``fan`` folders of one level make one of the next, so a row is written again once per level, and the
number of folders grows with the logarithm of the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RUN_COLUMNS = [StructField("run", StringType()), StructField("batch", StringType())]
Span = tuple[int, int]


class Folder:
    """A folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def matches(self, pattern: str) -> list[str]:
        """Paths below the folder that match, without it."""
        found = self.system.globStatus(self.jvm.org.apache.hadoop.fs.Path(self.path, pattern)) or []
        depth = pattern.count("/") + 1
        return ["/".join(str(status.getPath().toString()).split("/")[-depth:]) for status in found]

    def delete(self, name: str) -> None:
        self.system.delete(self.jvm.org.apache.hadoop.fs.Path(self.path, name), True)


def span_of(name: str) -> Span:
    first, _, last = name.removeprefix("batch=").partition("-")
    return int(first), int(last or first)


def name_of(span: Span) -> str:
    return f"batch={span[0]}" if span[0] == span[1] else f"batch={span[0]}-{span[1]}"


def _within(span: Span, other: Span) -> bool:
    return other != span and other[0] <= span[0] and span[1] <= other[1]


def live(spark: SparkSession, path: str) -> dict[str, list[Span]]:
    """The complete folders of each run that no other holds, in order."""
    spans: dict[str, list[Span]] = {}
    for found in Folder(spark, path).matches("run=*/batch=*/_SUCCESS"):
        run, name, _ = found.split("/")
        spans.setdefault(run, []).append(span_of(name))
    return {run: sorted(s for s in all_ if not any(_within(s, o) for o in all_)) for run, all_ in sorted(spans.items())}


def live_names(spark: SparkSession, path: str) -> list[str]:
    return [f"{run}/{name_of(span)}" for run, spans in live(spark, path).items() for span in spans]


def read_folders(spark: SparkSession, path: str, schema: StructType, names: list[str]) -> DataFrame:
    """The rows of some folders, with ``run`` and ``batch``."""
    schema = StructType([*schema.fields, *RUN_COLUMNS])
    if not names:
        # Known to be empty when a join with it is planned.
        return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{name}" for name in names])


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows, with ``run`` and ``batch``."""
    return read_folders(spark, path, schema, live_names(spark, path))


def level_of(span: Span, fan: int) -> int:
    length, level = span[1] - span[0] + 1, 0
    while length >= fan:
        length, level = length // fan, level + 1
    return level


def clear(spark: SparkSession, path: str) -> None:
    """Delete folders whose rows a fold holds, and folds that were cut short."""
    folder = Folder(spark, path)
    kept = set(live_names(spark, path))
    whole = {found.rpartition("/")[0] for found in folder.matches("run=*/batch=*/_SUCCESS")}
    for name in folder.matches("run=*/batch=*"):
        if name not in kept and (name in whole or "-" in name):
            folder.delete(name)


def fold(
    spark: SparkSession, path: str, fan: int, write: Callable[[str, list[str], str, bool], None]
) -> None:
    """Fold the committed folders of each run that are ``fan`` or more of one level.

    The last batch of a run may be replayed and stays apart. ``write(run, names, name, lowest)`` writes the rows of the folders
    ``names`` to the folder ``name``; ``lowest`` tells that no older folder is left. To be called by the one writer, between batches.
    """
    if fan < 2:
        raise ValueError("a fold takes two folders at least")
    runs = {run: spans[:-1] for run, spans in live(spark, path).items()}
    cleared = False
    for run, spans in runs.items():
        level = 0
        while spans and level <= max(level_of(span, fan) for span in spans):
            members = [span for span in spans if level_of(span, fan) == level]
            if len(members) >= fan:
                if not cleared:
                    clear(spark, path)
                    cleared = True
                whole = (members[0][0], members[-1][1])
                lowest = len(runs) == 1 and members[0] == spans[0]
                write(run, [f"{run}/{name_of(span)}" for span in members], f"{run}/{name_of(whole)}", lowest)
                spans = sorted([*[span for span in spans if span not in members], whole])
            level += 1
