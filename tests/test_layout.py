import random

import pytest
from helpers import rows_of, scan_details_of
from pyspark.sql import functions as F

from curbline.plans import layout
from curbline.schema import FACT_SCHEMA
from curbline.session import work_dir


def rows_scanned(frame):
    """Rows that the scan of a filter hands over, after row groups were skipped."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def fact(spark):
    """60,000 trips all over the map, and 20,000 in one cell."""
    spread = spark.range(60_000).select(
        "id",
        (F.pmod(F.xxhash64("id"), F.lit(18_000)) / 100 - 90).alias("lat"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(36_000)) / 100 - 180).alias("lon"),
    )
    hot = spark.range(60_000, 80_000).select("id", F.lit(40.75).alias("lat"), F.lit(-73.99).alias("lon"))
    known = {
        "trip_id": F.concat(F.lit("t"), "id"),
        "latitude_grid": F.col("lat"),
        "longitude_grid": F.col("lon"),
        "base": F.concat(F.lit("B"), F.col("id") % 3),
    }
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA]
    return spread.unionByName(hot).select(*columns)


@pytest.fixture(scope="module")
def clustered(spark, fact):
    path = work_dir(spark, "clustered")
    layout.write_clustered(fact, path, files=64, row_group_bytes=64 * 1024)
    return layout.read_clustered(spark, path)


def test_the_curve_interleaves_rows_and_columns(spark):
    random.seed(5)
    cells = [(0, 0), (18_000, 36_000)] + [(random.randrange(18_001), random.randrange(36_001)) for _ in range(200)]
    frame = spark.createDataFrame([(a, b) for a, b in cells], "a int, b int").withColumn(
        "place", layout.morton((F.col("a") / 100 - 90).cast("decimal(6,2)"), (F.col("b") / 100 - 180).cast("decimal(6,2)"))
    )
    for row in frame.collect():
        wanted = sum((row.a >> n & 1) << 2 * n | (row.b >> n & 1) << 2 * n + 1 for n in range(16))
        assert row.place == wanted


def test_clustering_keeps_every_trip(fact, clustered):
    assert clustered.count() == 80_000
    assert clustered.exceptAll(fact).count() == 0


def test_a_hot_cell_lies_in_several_files(clustered):
    hot = clustered.where("latitude_grid = 40.75 and longitude_grid = -73.99")
    assert hot.select(F.input_file_name()).distinct().count() >= 3


@pytest.mark.parametrize("base", [None, "B1"])
def test_a_window_gives_its_trips(fact, clustered, base):
    window = ((-20.0, 10.0), (100.0, 150.0))
    got = layout.in_window(clustered, *window, base)
    wanted = fact.where("latitude_grid between -20 and 10 and longitude_grid between 100 and 150")
    if base:
        wanted = wanted.where(F.col("base") == base)
    assert rows_of(got, "trip_id") == rows_of(wanted, "trip_id")
    assert got.count() > 0


def test_rows_read_fall_with_the_window(clustered):
    windows = [((-90, 90), (-180, 180)), ((-45, 0), (0, 90)), ((-12, -10), (20, 24))]
    read = [rows_scanned(layout.in_window(clustered, *w).select("trip_id")) for w in windows]
    assert read[0] == 80_000
    assert read[1] < read[0] / 4
    assert read[2] < read[1]
    details = scan_details_of(layout.in_window(clustered, *windows[2]).select("trip_id"))
    assert "GreaterThanOrEqual(latitude_grid" in details and "LessThanOrEqual(longitude_grid" in details


def test_an_empty_fact_has_an_empty_layout(spark, fact):
    path = work_dir(spark, "clustered-empty")
    layout.write_clustered(fact.limit(0), path)
    assert layout.in_window(layout.read_clustered(spark, path), (0, 1), (0, 1)).count() == 0
