"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# State on local disk, saved as change logs; one store per join partition instead of four.
DISK_BACKED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(
    app_name: str = "curbline", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution on. No result depends on its time zone."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (DISK_BACKED_STATE | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="curbline-")
    return f"{root.rstrip('/')}/curbline/{label}-{uuid4().hex}"


@contextmanager
def disk_backed_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Keep the state of queries started inside on local disk, not on the heap.

    State is cut into ``partitions`` for the life of a checkpoint, by default one per core.
    A running query holds its own copy of the settings, so the session gets its old values
    back at once.
    """
    cut = str(partitions or spark.sparkContext.defaultParallelism)
    settings = DISK_BACKED_STATE | {"spark.sql.shuffle.partitions": cut}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a Parquet table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
