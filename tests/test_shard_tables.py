import pytest
from helpers import VALID, plan_of, raw, rows_of
from pyspark.sql import functions as F

from curbline.operators import shards
from curbline.session import work_dir
from curbline.sources.shard_tables import (
    join_tables,
    open_shard_tables,
    orphans_of_tables,
    repeated_ids,
    write_shard_tables,
)

BUCKETS = 4


def shard_frames(spark, datetimes, latitudes, longitudes):
    return {
        "datetime": spark.createDataFrame(datetimes, "trip_id string, `Date/Time` string"),
        "latitude": spark.createDataFrame(latitudes, "trip_id string, Lat string"),
        "longitude_base": spark.createDataFrame(longitudes, "trip_id string, Lon string, Base string"),
    }


def fresh(spark, frames, label):
    folder = work_dir(spark, label)
    name = f"{label}_{folder.rpartition('-')[2]}"
    return folder, name, write_shard_tables(frames, folder, name, BUCKETS)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def mixed(spark):
    ids = [f"id{n}" for n in range(200)]
    hot = [("hot", VALID[0])] * 300
    return shard_frames(
        spark,
        hot + [(i, VALID[0]) for i in ids[:150]] + [(i, VALID[0]) for i in ids[:20]],
        [("hot", "40.5")] + [(i, "40.1") for i in ids[50:]] + [("id60", "95")],
        [("hot", "-73", "B1")] + [(i, "-73", "B2") for i in ids[::2]] + [("", "-73", "B2")],
    )


def test_tables_give_what_the_shuffled_operators_give(spark, mixed):
    _, _, tables = fresh(spark, mixed, "lie_together")
    assert rows_of(join_tables(tables)) == rows_of(shards.merge_shards(mixed))
    valid = {role: shards.partial_events(role, frame) for role, frame in mixed.items()}
    assert rows_of(orphans_of_tables(tables)) == rows_of(shards.orphan_ids(valid))
    repeated = [("datetime", "hot", 300), *[("datetime", f"id{n}", 2) for n in range(20)]]
    assert rows_of(repeated_ids(tables)) == sorted(repeated, key=repr)


@pytest.mark.parametrize("read", [join_tables, orphans_of_tables, repeated_ids])
def test_tables_are_read_without_an_exchange(spark, mixed, no_broadcast, read):
    _, _, tables = fresh(spark, mixed, "no_exchange")
    assert "Exchange" not in plan_of(read(tables))


def test_a_bucket_is_one_file(spark, mixed):
    _, _, tables = fresh(spark, mixed, "files")
    for table in tables.values():
        assert table.select(F.input_file_name()).distinct().count() <= BUCKETS


def test_tables_are_opened_again_with_their_own_number_of_buckets_only(spark, mixed, no_broadcast):
    folder, name, tables = fresh(spark, mixed, "opened")
    opened = open_shard_tables(spark, folder, f"{name}_again", BUCKETS)
    joined = join_tables(opened)
    assert "Exchange" not in plan_of(joined)
    assert rows_of(joined) == rows_of(join_tables(tables))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        open_shard_tables(spark, folder, f"{name}_other", BUCKETS * 2)


def test_empty_shards_make_empty_tables(spark):
    none = {role: frame.limit(0) for role, frame in shards.split_columns(raw(spark, VALID)).items()}
    _, _, tables = fresh(spark, none, "empty")
    assert join_tables(tables).count() == orphans_of_tables(tables).count() == repeated_ids(tables).count() == 0
