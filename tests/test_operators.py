import json
import random

import pytest
from helpers import VALID, plan_of, raw, rows_of
from pyspark.sql import functions as F

from curbline.operators import shards
from curbline.operators.canonical import canonical_events, rejected_rows
from curbline.operators.enrich import decode_events, transform_messages, valid_events
from curbline.operators.merge import insert_absent, one_per_key, upsert_latest
from curbline.operators.positions import take_range, with_position, with_slice
from curbline.operators.ranking import with_share_and_rank
from curbline.schema import SHARD_COLUMNS
from curbline.session import work_dir
from curbline.sources.shard_csv import read_shard_csv, write_shard_csv

EVENT = {
    "trip_id": "good",
    "event_timestamp": "2014-04-01T12:30:00+00:00",
    "pickup_latitude": 40.7,
    "pickup_longitude": -73.9,
    "base": "B02512",
}


def messages(spark, *values):
    texts = [v if isinstance(v, (str, type(None))) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


# Messages


def test_messages_are_validated_and_enriched(spark, any_zone):
    bad = dict(EVENT, trip_id="bad", pickup_latitude=95)
    got = transform_messages(messages(spark, EVENT, bad)).collect()
    assert [(r.trip_id, str(r.trip_date), r.pickup_hour, r.day_of_week) for r in got] == [
        ("good", "2014-04-01", 8, 2)
    ]


def test_calendar_follows_the_given_zone(spark):
    row = transform_messages(messages(spark, EVENT), "UTC").first()
    assert (row.pickup_hour, row.day_of_week) == (12, 2)


def test_message_bytes_are_read_as_utf8(spark):
    event = dict(EVENT, base="Bé")
    frame = messages(spark, json.dumps(event, ensure_ascii=False))
    assert decode_events(frame.select(F.col("value").cast("binary").alias("value"))).first().base == "Bé"


def test_unreadable_messages_drop_out(spark):
    def without(name):
        return {k: v for k, v in EVENT.items() if k != name}

    bad = [
        "not json", "", "[]", None, "{}",
        *[without(name) for name in EVENT],
        *[dict(EVENT, **{name: None}) for name in EVENT],
        dict(EVENT, pickup_longitude="-73.9"),
        dict(EVENT, pickup_latitude=float("nan")),
        dict(EVENT, pickup_longitude=-180.5),
        dict(EVENT, event_timestamp="noon"),
        dict(EVENT, base=""),
    ]
    blank = dict(EVENT, trip_id="blank", base="  ")
    got = valid_events(decode_events(messages(spark, *bad, EVENT, blank)))
    assert [r[0] for r in rows_of(got)] == ["blank", "good"]


def test_a_message_is_parsed_once(spark):
    plan = plan_of(transform_messages(messages(spark, EVENT).repartition(2)))
    assert plan.count("from_json(") == 1


# Column shards


def shard_frames(spark, datetimes, latitudes, longitudes):
    return {
        "datetime": spark.createDataFrame(datetimes, "trip_id string, `Date/Time` string"),
        "latitude": spark.createDataFrame(latitudes, "trip_id string, Lat string"),
        "longitude_base": spark.createDataFrame(longitudes, "trip_id string, Lon string, Base string"),
    }


def test_split_and_merge_give_the_canonical_events(spark):
    rows = raw(spark, VALID, ("bad", *VALID[1:]), (" 4/2/2014 1:02:03", "41", "-74 ", "B1"))
    folder = work_dir(spark, "shards")
    write_shard_csv(shards.split_columns(rows), folder)
    merged = shards.merge_shards(read_shard_csv(spark, folder))
    assert rows_of(merged) == rows_of(canonical_events(rows))


def test_shard_files_have_the_agreed_columns(spark):
    split = shards.split_columns(raw(spark, VALID))
    assert {role: tuple(frame.columns) for role, frame in split.items()} == {
        role: ("trip_id", *columns) for role, columns in SHARD_COLUMNS.items()
    }


def test_repeated_shard_rows_do_not_multiply(spark):
    frames = shard_frames(
        spark,
        [("a", VALID[0])] * 50 + [("b", VALID[0])],
        [("a", "40.1")] * 40 + [("a", "40.2"), ("b", "40.3")],
        [("a", "-73", "B1")] * 30 + [("b", "-73", "B2")],
    )
    got = rows_of(shards.merge_shards(frames), "trip_id", "pickup_latitude", "base")
    assert got == [("a", 40.1, "B1"), ("b", 40.3, "B2")]
    assert shards.join_shards(frames).count() == 2


def test_shard_checks_by_role(spark):
    frames = shard_frames(
        spark,
        [("a", VALID[0]), ("b", "bad"), ("", VALID[0]), (None, VALID[0]), ("c", None)],
        [("a", "40"), ("b", "90.5"), ("c", "x")],
        [("a", "-73", "B1"), ("b", "-73", " "), ("c", "-181", "B1"), ("d", "-73", None)],
    )
    valid = {role: shards.parse_shard(role, frame).where("is_valid").count() for role, frame in frames.items()}
    assert valid == {"datetime": 1, "latitude": 1, "longitude_base": 1}
    assert [r.trip_id for r in shards.merge_shards(frames).collect()] == ["a"]


def test_orphans_and_reconciliation(spark):
    frames = shard_frames(
        spark,
        [("a", "x"), ("b", "x"), ("b", "x")],
        [("a", "1"), ("c", "1")],
        [("a", "1", "B"), ("b", "1", "B")],
    )
    assert rows_of(shards.orphan_ids(frames)) == [("b", True, False, True), ("c", False, True, False)]
    assert tuple(shards.reconcile(frames).first()) == (3, 2, 2, 3, 1, 2)


def test_shard_join_shuffles_each_shard_once(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = plan_of(shards.merge_shards(shards.split_columns(raw(spark, VALID))))
    finally:
        spark.conf.set(key, before)
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("SortMergeJoin") == 2


# Positions


@pytest.fixture(scope="module")
def sparse(spark):
    random.seed(11)
    numbers = sorted(random.sample(range(1, 5000), 1200))
    frame = spark.createDataFrame([(n, f"id{n}") for n in numbers], "row_number bigint, trip_id string")
    return numbers, frame.repartition(5).cache()


def test_positions_are_gapless(sparse):
    numbers, frame = sparse
    got = with_position(frame, span_rows=64)
    assert [(r.row_number, r.position) for r in got.sort("row_number").collect()] == [
        (n, p) for p, n in enumerate(numbers, 1)
    ]


@pytest.mark.parametrize(
    "skip,limit", [(0, None), (0, 0), (0, 1), (0, 77), (500, None), (500, 64), (1199, 10), (1200, 5), (0, 9999)]
)
def test_ranges_of_positions(sparse, skip, limit):
    numbers, frame = sparse
    expected = numbers[skip : skip + limit] if limit else numbers[skip:]
    got = [r.row_number for r in take_range(frame, skip, limit).sort("position").collect()]
    assert got == expected
    small = with_position(frame, after=skip, upto=skip + limit if limit else None, span_rows=64)
    assert sorted(r.row_number for r in small.collect()) == expected


def test_bad_ranges_are_refused(sparse):
    for bad in ({"skip": -1}, {"limit": -1}):
        with pytest.raises(ValueError):
            take_range(sparse[1], **bad)
    with pytest.raises(ValueError):
        with_slice(sparse[1], slice_rows=0)


def test_slices(sparse):
    _, frame = sparse
    got = with_slice(with_position(frame), head_start=50, slice_rows=20)
    sizes = {r[0]: r[1] for r in got.groupBy("slice_no").count().collect()}
    assert sizes == {0: 50, **{n: 20 for n in range(1, 58)}, 58: 10}
    first = got.where("position = 51").first()
    assert first.slice_no == 1


# Ranking and merging


def test_share_and_rank_with_ties(spark):
    random.seed(2)
    counts = [random.randint(1, 40) for _ in range(500)] + [1] * 300
    frame = spark.createDataFrame([(f"c{n}", c) for n, c in enumerate(counts)], "cell string, trip_count bigint")
    ordered = sorted(counts, reverse=True)
    total = sum(counts)
    for row in with_share_and_rank(frame).collect():
        assert row["rank"] == ordered.index(row.trip_count) + 1
        # Half away from zero, in whole numbers.
        assert int(row.share_pct * 100) == (20000 * row.trip_count + total) // (2 * total)
    assert with_share_and_rank(frame).count() == 800


def test_one_per_key_takes_the_first_in_order(spark):
    frame = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q")], "k string, at int, v string"
    )
    assert rows_of(one_per_key(frame, "k")) == [("a", 1, "y"), ("b", None, "q")]
    assert rows_of(one_per_key(frame, "k", ("v",))) == [("a", 2, "x"), ("b", None, "q")]
    assert rows_of(one_per_key(frame, "k", copies="n")) == [("a", 1, "y", 3), ("b", None, "q", 1)]
    assert rows_of(one_per_key(frame.select("k", "v"), "k", copies="n")) == [("a", "x", 3), ("b", "q", 1)]


def test_insert_absent(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", 3)], "trip_id string, v int")
    existing = spark.createDataFrame([("a", 9), ("a", 8), ("z", 7)], "trip_id string, v int")
    got = insert_absent(batch, existing)
    assert rows_of(got) == [("b", 2), ("c", 3)]
    assert rows_of(insert_absent(batch.distinct(), existing, unique_keys=True)) == [("b", 2), ("c", 3)]


def test_a_small_batch_spares_the_big_table_the_shuffle(spark):
    big = spark.range(0, 10**9, 1, 8).select(F.col("id").cast("string").alias("trip_id"))
    batch = spark.range(10).select(F.col("id").cast("string").alias("trip_id"), F.lit(1).alias("v"))
    assert "BroadcastHashJoin" in plan_of(insert_absent(batch, big))


def test_upsert_keeps_the_latest(spark):
    columns = "batch_id bigint, records_received bigint, processed_at bigint"
    old = spark.createDataFrame([(0, 5, 10), (1, 6, 11), (2, 7, 12)], columns)
    new = spark.createDataFrame([(1, 60, 12), (2, 70, 12), (3, 80, 13)], columns)
    got = upsert_latest(old, new, ("batch_id",), "processed_at")
    assert rows_of(got, "batch_id", "records_received") == [(0, 5), (1, 60), (2, 70), (3, 80)]


def test_valid_and_rejected_rows_make_up_all_rows(spark):
    random.seed(4)
    pools = [
        ["4/1/2014 0:00:00", "13/1/2014 0:00:00", None], ["40.1", "-91", "x", ""],
        ["-73", "200", None], ["B1", "", " ", None],
    ]
    rows = raw(spark, *[tuple(random.choice(p) for p in pools) for _ in range(300)])
    valid = {r.row_number for r in canonical_events(rows, keep_row_number=True).collect()}
    rejected = {r.row_number for r in rejected_rows(rows).collect()}
    assert not valid & rejected and valid | rejected == set(range(1, 301))
    assert valid and rejected


def test_places_over_ranges_have_no_gaps_and_split_hot_values(spark):
    from curbline.operators.places import dealt_in_order, with_place

    rows = spark.range(5000).selectExpr("id", "if(id % 10 = 0, id, 7) as score")
    order = (F.desc("score"), F.asc("id"))
    got = [(r.place, r.id) for r in with_place(rows, *order).orderBy("place").collect()]
    wanted = sorted(((n if n % 10 == 0 else 7, n) for n in range(5000)), key=lambda r: (-r[0], r[1]))
    assert got == [(place, n) for place, (_, n) in enumerate(wanted, 1)]
    # Small ranges are merged; unmerged, the hot value lies in several.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = dealt_in_order(rows, *order).where("score = 7").select("part").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
    assert with_place(rows.limit(0), *order).count() == 0
