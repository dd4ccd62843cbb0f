import inspect
import json
from pathlib import Path

import pytest
from helpers import VALID, raw, rows_of
from pyspark.sql import functions as F

from curbline import registry
from curbline.operators import shards
from curbline.operators.canonical import canonical_events
from curbline.operators.enrich import add_calendar, arrival_of, transform_messages, valid_events
from curbline.plans import quality, serving
from curbline.schema import EVENT_COLUMNS, PARTIAL_FIELDS, SHARD_COLUMNS
from curbline.session import disk_backed_state, work_dir
from curbline.sources.messages import file_stream, message_payload
from curbline.streaming import assembly, batches, jobs, membership, sinks

DATES = ["4/1/2014", "4/2/2014", "4/3/2014"]


def trips(spark, numbers, base="B1"):
    rows = raw(spark, *[(f"{DATES[n % 3]} {n % 24}:00:00", "40.5", "-73.5", base) for n in range(60)])
    return canonical_events(rows, keep_row_number=True).where(F.col("row_number").isin(*numbers)).drop("row_number")


def send(spark, folder, number, events):
    """One more message file; files are taken in order of their number."""
    path = f"{folder}/{number:03d}"
    message_payload(events).coalesce(1).write.parquet(path)


@pytest.fixture()
def inbox(spark):
    return work_dir(spark, "inbox")


def messages(spark, inbox, **limits):
    limits = limits or {"max_files": 1}
    return file_stream(spark, f"{inbox}/*", "key string, value string", **limits)


def merge(spark, inbox, folder, checkpoint="first", **options):
    query = sinks.write_staging_stream(
        transform_messages(messages(spark, inbox)), f"{folder}/staging", f"{folder}/metrics",
        f"{folder}/checkpoint-{checkpoint}", "available", **options,
    )
    query.awaitTermination()
    return sinks.read_staging(spark, f"{folder}/staging"), sinks.read_batch_metrics(spark, f"{folder}/metrics")


def test_lake_is_partitioned_by_date_and_restarts_from_its_checkpoint(spark, inbox):
    folder = work_dir(spark, "lake")

    def run():
        stream = transform_messages(messages(spark, inbox))
        sinks.write_parquet_stream(stream, f"{folder}/lake", f"{folder}/checkpoint", "available").awaitTermination()
        return spark.read.parquet(f"{folder}/lake")

    send(spark, inbox, 1, trips(spark, range(1, 11)))
    assert run().count() == 10
    send(spark, inbox, 2, trips(spark, range(11, 16)))
    lake = run()
    assert lake.count() == 15
    assert dict(lake.dtypes)["trip_date"] == "date"
    one_day = lake.where("trip_date = date'2014-04-02'")
    one_day.collect()
    assert "PartitionFilters: [isnotnull(trip_date" in one_day._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("compact_every", [2, 50])
def test_merge_keeps_one_row_per_id_across_batches(spark, inbox, compact_every):
    send(spark, inbox, 1, trips(spark, range(1, 11)).union(trips(spark, range(5, 11))))
    send(spark, inbox, 2, trips(spark, range(8, 21)))
    send(spark, inbox, 3, trips(spark, range(1, 21)))
    staging, metrics = merge(spark, inbox, work_dir(spark, "merge"), compact_every=compact_every)
    expected = add_calendar(valid_events(trips(spark, range(1, 21))))
    assert rows_of(staging, "trip_id", "trip_date") == rows_of(expected, "trip_id", "trip_date")
    assert rows_of(metrics, "batch_id", "records_received") == [(0, 16), (1, 13), (2, 20)]
    assert not quality.contract_report(staging).where("violations > 0").count()
    health = serving.stream_health(metrics).first()
    assert tuple(health)[:3] == (2, 20, 3)


def test_first_writer_wins(spark, inbox):
    first, second = trips(spark, [1]), trips(spark, [1]).withColumn("base", F.lit("A0"))
    send(spark, inbox, 1, first)
    send(spark, inbox, 2, second)
    staging, _ = merge(spark, inbox, work_dir(spark, "first"))
    assert [r.base for r in staging.collect()] == ["B1"]


def test_an_id_may_not_come_back_under_another_date(spark, inbox):
    moved = trips(spark, [1]).withColumn("event_timestamp", F.lit("2015-01-01T12:00:00+00:00"))
    send(spark, inbox, 1, trips(spark, [1]))
    send(spark, inbox, 2, moved)
    staging, _ = merge(spark, inbox, work_dir(spark, "moved"))
    assert [str(r.trip_date) for r in staging.collect()] == ["2014-04-01"]


def test_a_new_run_over_the_same_messages_adds_nothing(spark, inbox):
    folder = work_dir(spark, "again")
    send(spark, inbox, 1, trips(spark, range(1, 11)))
    send(spark, inbox, 2, trips(spark, range(11, 21)))
    before = rows_of(merge(spark, inbox, folder)[0])
    staging, metrics = merge(spark, inbox, folder, checkpoint="again")
    assert rows_of(staging) == before
    assert metrics.count() == 4


def test_a_fresh_checkpoint_cannot_delete(spark, inbox):
    folder = work_dir(spark, "fresh")
    send(spark, inbox, 1, trips(spark, [1, 2, 3]))
    merge(spark, inbox, folder)
    other = work_dir(spark, "inbox")
    send(spark, other, 1, trips(spark, [4]))
    staging, metrics = merge(spark, other, folder, checkpoint="again")
    assert staging.count() == 4
    assert metrics.select("run").distinct().count() == 2


def test_the_first_arrival_stays_within_a_batch(spark, inbox):
    late = trips(spark, [1]).withColumn("base", F.lit("A0")).withColumn("timestamp", F.timestamp_seconds(F.lit(20)))
    first = trips(spark, [1]).withColumn("timestamp", F.timestamp_seconds(F.lit(10)))
    message_payload(late.union(first), keep=("timestamp",)).coalesce(1).write.parquet(f"{inbox}/001")
    stream = arrival_of(file_stream(spark, f"{inbox}/*", PARTIAL_MESSAGE, max_files=1))
    folder = work_dir(spark, "arrival")
    sinks.write_staging_stream(
        transform_messages(stream, keep=("arrival",)), f"{folder}/staging", f"{folder}/metrics",
        f"{folder}/checkpoint", "available",
    ).awaitTermination()
    assert [r.base for r in sinks.read_staging(spark, f"{folder}/staging").collect()] == ["B1"]


def written_bytes(path):
    return sum(p.stat().st_size for p in Path(path.removeprefix("file:")).rglob("*.parquet"))


def store(spark, folder, number, numbers, fan=None):
    batch = add_calendar(valid_events(trips(spark, numbers)))
    sinks.merge_batch(batch, number, "first", f"{folder}/staging", f"{folder}/metrics")
    if fan:
        sinks.compact_staging(spark, f"{folder}/staging", f"{folder}/metrics", fan)


def test_folders_stay_few_over_many_batches(spark, inbox):
    folder = work_dir(spark, "many")
    for number in range(12):
        send(spark, inbox, number, trips(spark, [number + 1, number + 2]))
    staging, metrics = merge(spark, inbox, folder, compact_every=3)
    assert staging.count() == 13 and metrics.count() == 12
    for table in ("staging", "metrics"):
        (spans,) = batches.live(spark, f"{folder}/{table}").values()
        # At most fan - 1 folders of each level, and the last batch.
        assert spans == [(0, 8), (9, 9), (10, 10), (11, 11)]


def test_bytes_written_grow_with_the_data_times_its_levels():
    """200 batches of one row each, by the fold's own rule: every row is written once per level."""
    fan, spans, written = 8, [], 0
    for number in range(200):
        spans.append((number, number))
        written += 1
        level, committed = 0, spans[:-1]
        while committed and level <= max(batches.level_of(s, fan) for s in committed):
            members = [s for s in committed if batches.level_of(s, fan) == level]
            if len(members) >= fan:
                whole = (members[0][0], members[-1][1])
                written += whole[1] - whole[0] + 1
                committed = sorted([*[s for s in committed if s not in members], whole])
            level += 1
        spans = [*committed, spans[-1]]
        assert len(spans) <= 3 * fan
    assert written <= 4 * 200


def test_readers_see_every_row_while_a_fold_is_cut_short(spark, monkeypatch):
    folder = work_dir(spark, "short")
    for number in range(5):
        store(spark, folder, number, [number + 1])
    staging = f"{folder}/staging"
    before = rows_of(sinks.read_staging(spark, staging))
    assert len(before) == 5

    # Cut short before the fold is complete: its folder stands without a mark.
    sinks.compact_staging(spark, staging, f"{folder}/metrics", 4)
    mark = Path(f"{staging}/run=first/batch=0-3/_SUCCESS".removeprefix("file:"))
    assert mark.exists()
    mark.unlink()
    assert batches.live(spark, staging)["run=first"] == [(n, n) for n in range(5)]
    assert rows_of(sinks.read_staging(spark, staging)) == before

    # Complete, and the folders that it holds are still there.
    sinks.compact_staging(spark, staging, f"{folder}/metrics", 4)
    assert batches.live(spark, staging)["run=first"] == [(0, 3), (4, 4)]
    assert Path(f"{staging}/run=first/batch=0".removeprefix("file:")).exists()
    assert rows_of(sinks.read_staging(spark, staging)) == before

    # They go with the next fold.
    batches.clear(spark, staging)
    assert not Path(f"{staging}/run=first/batch=0".removeprefix("file:")).exists()
    assert rows_of(sinks.read_staging(spark, staging)) == before


def test_a_batch_that_is_being_written_is_not_read(spark):
    folder = work_dir(spark, "writing")
    store(spark, folder, 0, [1, 2])
    store(spark, folder, 1, [3])
    Path(f"{folder}/staging/run=first/batch=1/_SUCCESS".removeprefix("file:")).unlink()
    assert sinks.read_staging(spark, f"{folder}/staging").count() == 2
    store(spark, folder, 1, [3])
    assert sinks.read_staging(spark, f"{folder}/staging").count() == 3


def ids_frame(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("uber-"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 20)).alias("trip_id"))


def test_new_ids_read_no_file(spark):
    """Filters tell 10,000 new ids from 20,000 stored ones; stored ones are all found."""
    path = work_dir(spark, "filters")
    schema = sinks.StructType([sinks.STAGING_FILES["trip_id"], sinks.STAGING_FILES["bucket"]])
    for number in range(2):
        sinks.write_bucketed(ids_frame(spark, number * 10_000, number * 10_000 + 10_000), path, f"run=a/batch={number}", 10_000)
    new = sinks.stored_rows(spark, path, schema, ids_frame(spark, 50_000, 60_000), "a", 9)
    assert len(new.inputFiles()) <= 1
    old = ids_frame(spark, 5_000, 15_000)
    found = sinks.stored_rows(spark, path, schema, old, "a", 9)
    assert found.join(old, "trip_id", "left_semi").count() == 10_000
    one = ids_frame(spark, 7, 8)
    assert len(sinks.stored_rows(spark, path, schema, one, "a", 9).inputFiles()) == 1
    # A batch does not meet its own folder.
    assert sinks.stored_rows(spark, path, schema, one, "a", 0).isEmpty()


def test_a_folder_without_a_filter_is_read(spark):
    folder = work_dir(spark, "unfiltered")
    store(spark, folder, 0, range(1, 9))
    Path(f"{folder}/staging/_filters/run=first/batch=0/lines=1/_SUCCESS".removeprefix("file:")).unlink()
    store(spark, folder, 1, range(1, 12))
    assert sinks.read_staging(spark, f"{folder}/staging").count() == 11


def test_of_many_keys_some_tell_for_the_others(spark, monkeypatch):
    """A bucket of a folder that is known to be met is not asked about again; what no early key tells is found all the same."""
    path, asked = work_dir(spark, "many-keys"), []
    for number in range(2):
        sinks.write_bucketed(ids_frame(spark, number * 10_000, number * 10_000 + 10_000), path, f"run=a/batch={number}", 10_000)
    hits = membership._hits
    monkeypatch.setattr(membership, "FIRST_ASKED", 2_500)
    monkeypatch.setattr(membership, "_hits", lambda *args: asked.append(list(args[3])) or hits(*args))
    keys = ids_frame(spark, 0, 10_000).withColumn("bucket", sinks.bucket_of())
    names = [f"run=a/batch={number}" for number in range(2)]
    found = membership.may_hold(spark, path, keys, names, many=10_000, buckets=sinks.STAGING_BUCKETS)
    assert asked == [names, names[1:]]
    assert found[0][0] == names[0] and found[1] == list(range(sinks.STAGING_BUCKETS))
    late = keys.where(F.pmod(F.xxhash64(F.lit(4), "trip_id"), F.lit(4)) != 0).limit(1).persist()
    first = late.first()
    assert membership.may_hold(spark, path, late, names, many=10_000, buckets=sinks.STAGING_BUCKETS) == (names[:1], [first.bucket])


def test_a_merged_batch_is_read_once(spark):
    folder, read = work_dir(spark, "read-once"), spark.sparkContext.accumulator(0)

    def seen(rows):
        for batch in rows:
            read.add(batch.num_rows)
            yield batch

    batch = add_calendar(valid_events(trips(spark, range(1, 9)).union(trips(spark, [8]))))
    counted = batch.mapInArrow(seen, batch.schema).coalesce(1)
    sinks.merge_batch(counted, 0, "first", f"{folder}/staging", f"{folder}/metrics")
    kept = [name for name in (r.trip_id for r in sinks.read_staging(spark, f"{folder}/staging").collect())]
    assert len(kept) == len(set(kept)) == 8 and read.value == 9
    assert sinks.read_batch_metrics(spark, f"{folder}/metrics").first().records_received == 9


def test_filters_follow_the_folds(spark):
    folder = work_dir(spark, "folded")
    for number in range(8):
        store(spark, folder, number, [number + 1, 20], fan=3)
    path = f"{folder}/staging"
    filters = batches.Folder(spark, membership.filters_path(path)).matches("run=*/batch=*")
    data = batches.Folder(spark, path).matches("run=*/batch=*")
    assert set(batches.live_names(spark, path)) <= set(filters) and set(filters) <= set(data)
    assert sinks.read_staging(spark, path).count() == 9


def test_a_replayed_batch_replaces_itself(spark):
    folder = work_dir(spark, "batch")
    paths = (f"{folder}/staging", f"{folder}/metrics")
    batches = [add_calendar(valid_events(trips(spark, numbers))) for numbers in (range(1, 9), range(5, 13))]
    for number, batch in enumerate(batches):
        sinks.merge_batch(batch, number, "first", *paths)
    before = rows_of(sinks.read_staging(spark, paths[0]))
    for number, batch in enumerate(batches):
        sinks.merge_batch(batch, number, "first", *paths)
    assert rows_of(sinks.read_staging(spark, paths[0])) == before
    assert len(before) == 12
    metrics = sinks.read_batch_metrics(spark, paths[1])
    assert rows_of(metrics, "batch_id", "records_received") == [(0, 8), (1, 8)]


def test_batches_without_valid_trips_leave_no_trace(spark, inbox):
    send(spark, inbox, 1, trips(spark, [1, 2], base="B1").withColumn("base", F.lit("")))
    folder = work_dir(spark, "empty")
    staging, metrics = merge(spark, inbox, folder)
    assert staging.count() == metrics.count() == 0
    assert serving.stream_health(metrics).first().latest_batch is None


def test_one_stream_feeds_two_sinks(spark, inbox):
    send(spark, inbox, 1, trips(spark, range(1, 11)))
    send(spark, inbox, 2, trips(spark, range(6, 16)))
    folder = work_dir(spark, "two")
    queries = jobs.start_trip_queries(
        messages(spark, inbox), f"{folder}/lake", f"{folder}/staging", f"{folder}/metrics",
        f"{folder}/checkpoints", trigger="available",
    )
    for query in queries:
        query.awaitTermination()
    assert len({q.id for q in queries}) == 2
    assert spark.read.parquet(f"{folder}/lake").count() == 20
    assert sinks.read_staging(spark, f"{folder}/staging").count() == 15


def test_valid_and_refused_messages_make_up_each_batch(spark, inbox):
    folder = work_dir(spark, "routed")
    for number in range(4):
        good, bad = trips(spark, [number + 1, number + 11]), trips(spark, [number + 21]).withColumn("base", F.lit(""))
        send(spark, inbox, number, good.union(bad).union(bad.withColumn("pickup_latitude", F.lit(99.0))))
    spark.createDataFrame([(None, "{broken")], "key string, value string").coalesce(1).write.parquet(f"{inbox}/009")
    for checkpoint in ("one", "one"):  # a restart has nothing left to do
        lake, staging = jobs.start_trip_queries(
            messages(spark, inbox), f"{folder}/lake", f"{folder}/staging", f"{folder}/metrics",
            f"{folder}/{checkpoint}", trigger="available", rejects_path=f"{folder}/rejects",
        )
        lake.awaitTermination()
        staging.awaitTermination()
    refused = sinks.read_rejects(spark, f"{folder}/rejects")
    assert rows_of(refused.groupBy("batch").count()) == [("0", 2), ("1", 2), ("2", 2), ("3", 2), ("4", 1)]
    reasons = {r.reason: r["count"] for r in refused.groupBy("reason").count().collect()}
    assert reasons["no base"] == 4 and reasons["bad latitude, no base"] == 4 and sum(reasons.values()) == 9
    assert sinks.read_staging(spark, f"{folder}/staging").count() == 8
    metrics = sinks.read_batch_metrics(spark, f"{folder}/metrics")
    assert rows_of(metrics, "batch_id", "records_received") == [(n, 2) for n in range(4)]


def test_waiting_ends_with_the_first_query(spark, inbox):
    """The job waits for any query, and a trigger by time keeps the others running."""
    send(spark, inbox, 1, trips(spark, [1, 2]))
    folder = work_dir(spark, "timed")
    stream = transform_messages(messages(spark, inbox))
    timed = sinks.write_parquet_stream(stream, f"{folder}/lake", f"{folder}/timed", "1 second")
    spark.streams.resetTerminated()
    done = sinks.write_parquet_stream(stream, f"{folder}/other", f"{folder}/done", "available")
    jobs.run_until_one_ends(spark)
    assert not done.isActive and timed.isActive
    timed.processAllAvailable()
    timed.stop()
    assert spark.read.parquet(f"{folder}/lake").count() == 2


def test_limits_bound_a_micro_batch(spark, inbox):
    for number in range(1, 5):
        send(spark, inbox, number, trips(spark, [number]))
    for limits, batches in (({"max_files": 3}, [3, 1]), ({"max_bytes": 10**9}, [4])):
        stream = messages(spark, inbox, **limits)
        query = sinks.start_writer(stream.writeStream.format("noop"), work_dir(spark, "limits"), "available")
        query.awaitTermination()
        assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == batches
    for bad in ({"max_files": 0}, {"max_bytes": -1}, {"max_files": 1, "max_bytes": 1}):
        with pytest.raises(ValueError):
            messages(spark, inbox, **bad)


# Assembly


PARTIAL_MESSAGE = "key string, value string, timestamp timestamp"


def part_stream(spark, inbox, max_files=1):
    return assembly.decode_partials(file_stream(spark, f"{inbox}/*", PARTIAL_MESSAGE, max_files=max_files))


def assemble(spark, folder, inbox, **options):
    query = assembly.write_assembly_stream(
        part_stream(spark, inbox), f"{folder}/staging", f"{folder}/metrics", f"{folder}/pending",
        f"{folder}/checkpoint", trigger="available", **options,
    )
    query.awaitTermination()
    return sinks.read_staging(spark, f"{folder}/staging"), assembly.read_pending(spark, f"{folder}/pending")


def send_part(spark, inbox, number, role, events, minute):
    part = shards.project_partial(events, role).withColumn(
        "timestamp", F.expr(f"timestamp'2014-04-01 00:00:00Z' + make_interval(0, 0, 0, 0, 0, {minute})")
    )
    payload = message_payload(part, ("trip_id", *PARTIAL_FIELDS[role]), ("timestamp",))
    payload.coalesce(1).write.parquet(f"{inbox}/{number:03d}")


@pytest.fixture()
def parts(spark, inbox):
    """Ids 1-20 complete, of which 5-10 and 15 come twice; 21 lacks its latitude, 22 its base; the
    latitude of 20 comes hours later."""
    number = 0
    for role in SHARD_COLUMNS:
        numbers = set(range(1, 23)) - {{"latitude": 21, "longitude_base": 22}.get(role)}
        if role == "latitude":
            numbers -= {20}
        for minute, chosen in ((0, sorted(numbers)), (5, [5, 6, 7, 8, 9, 10, 15])):
            send_part(spark, inbox, number, role, trips(spark, chosen), minute)
            number += 1
    send_part(spark, inbox, number, "latitude", trips(spark, [20]), 300)
    return inbox


@pytest.mark.parametrize("compact_every", [2, 50])
def test_late_parts_complete_a_trip_and_the_others_wait(spark, parts, compact_every):
    folder = work_dir(spark, "parts")
    staging, pending = assemble(spark, folder, parts, compact_every=compact_every)
    assert rows_of(staging, "trip_id") == rows_of(trips(spark, range(1, 21)), "trip_id")
    wanted = rows_of(add_calendar(valid_events(trips(spark, range(1, 21)))), "trip_id", "base", "pickup_latitude")
    assert rows_of(staging, "trip_id", "base", "pickup_latitude") == wanted
    assert rows_of(pending, "trip_id") == rows_of(trips(spark, [21, 22]), "trip_id")
    held = {r.trip_id: (r.pickup_latitude is None, r.base is None) for r in pending.collect()}
    ids = [r.trip_id for r in trips(spark, [21, 22]).collect()]
    assert sorted(held.values()) == [(False, True), (True, False)] and set(held) == set(ids)


def test_a_trip_is_stored_with_the_batch_of_its_last_part(spark, inbox):
    """No heartbeat: the topic falls silent, and all that is complete is there, batch by batch."""
    folder = work_dir(spark, "once")
    send_part(spark, inbox, 0, "datetime", trips(spark, [1, 2]), 0)
    send_part(spark, inbox, 1, "latitude", trips(spark, [1, 2]), 1)
    assert assemble(spark, folder, inbox)[0].count() == 0
    send_part(spark, inbox, 2, "longitude_base", trips(spark, [1]), 2)
    staging, pending = assemble(spark, folder, inbox)
    assert rows_of(staging, "trip_id") == rows_of(trips(spark, [1]), "trip_id")
    send_part(spark, inbox, 3, "longitude_base", trips(spark, [2]), 60 * 24 * 30)
    staging, pending = assemble(spark, folder, inbox)
    assert staging.count() == 2 and pending.isEmpty()
    metrics = sinks.read_batch_metrics(spark, f"{folder}/metrics")
    assert rows_of(metrics, "batch_id", "records_received") == [(2, 1), (3, 1)]


def test_a_part_sent_again_hours_later_loses_nothing(spark, inbox):
    send_part(spark, inbox, 0, "datetime", trips(spark, [1]), 0)
    send_part(spark, inbox, 1, "datetime", trips(spark, [1]), 180)
    send_part(spark, inbox, 2, "latitude", trips(spark, [1]), 180)
    send_part(spark, inbox, 3, "longitude_base", trips(spark, [1]), 180)
    staging, _ = assemble(spark, work_dir(spark, "later"), inbox)
    assert rows_of(staging, "trip_id") == rows_of(trips(spark, [1]), "trip_id")


def test_parts_of_a_stored_trip_are_dropped_and_a_wrong_value_can_be_mended(spark, inbox):
    bad = trips(spark, [2]).withColumn("pickup_latitude", F.lit(95.0))
    for number, role in enumerate(SHARD_COLUMNS):
        both = trips(spark, [1]).union(bad if role == "latitude" else trips(spark, [2]))
        send_part(spark, inbox, number, role, both, number)
    folder = work_dir(spark, "mended")
    staging, pending = assemble(spark, folder, inbox)
    assert rows_of(staging, "trip_id") == rows_of(trips(spark, [1]), "trip_id")
    assert rows_of(pending, "trip_id") == rows_of(trips(spark, [2]), "trip_id")
    send_part(spark, inbox, 3, "latitude", trips(spark, [1, 2]), 9)
    staging, pending = assemble(spark, folder, inbox)
    assert rows_of(staging, "trip_id") == rows_of(trips(spark, [1, 2]), "trip_id")
    assert pending.isEmpty()


def test_a_replayed_assembly_batch_changes_nothing(spark):
    folder = work_dir(spark, "replayed")
    paths = [f"{folder}/{name}" for name in ("staging", "metrics", "pending")]
    event = trips(spark, [1, 2, 3]).withColumn("arrival", F.timestamp_seconds(F.lit(5)))
    empty = [F.lit(None).cast("bigint").alias(name) for name in ("partition", "offset")]
    fields = [F.col(n) if n != "base" else F.lit(None).cast("string").alias("base") for n in EVENT_COLUMNS]
    first = event.select(*fields, "arrival", *empty)
    second = event.where("base = 'B1'").select("trip_id", *[
        F.lit(None).cast(dict(event.dtypes)[n]).alias(n) if n != "base" else F.col(n) for n in EVENT_COLUMNS[1:]
    ], "arrival", *empty).limit(2)
    second = second.persist()
    for _ in range(2):
        assembly.assemble_batch(first, 0, "r", *paths)
    for _ in range(2):
        assembly.assemble_batch(second, 1, "r", *paths)
        # As if the stop had come between the two tables.
        Path(f"{paths[2]}/run=r/batch=1/_SUCCESS".removeprefix("file:")).unlink()
    assembly.assemble_batch(second, 1, "r", *paths)
    assert sinks.read_staging(spark, paths[0]).count() == 2
    assert assembly.read_pending(spark, paths[2]).count() == 1
    assert rows_of(sinks.read_batch_metrics(spark, paths[1]), "batch_id", "records_received") == [(1, 2)]


def test_a_batch_meets_both_tables_in_one_pass(spark):
    """Parts are judged row by row: the batch's ids are not moved again, and nothing is joined to tell what still waits."""
    folder = work_dir(spark, "one-pass")
    paths = [f"{folder}/{name}" for name in ("staging", "metrics", "pending")]
    empty = [F.lit(None).cast("bigint").alias(name) for name in ("partition", "offset")]
    whole = trips(spark, range(1, 9)).withColumn("arrival", F.timestamp_seconds(F.lit(5)))
    some = whole.withColumn("base", F.when(F.col("pickup_latitude") > 90, F.col("base")))
    assembly.assemble_batch(whole.limit(3).select("*", *empty), 0, "r", *paths)
    assembly.assemble_batch(some.select("*", *empty), 1, "r", *paths)
    own = assembly.assemble(whole.select("*", *empty)).persist()
    assert own.count() == 8
    stored = sinks.stored_rows(spark, paths[0], sinks.STAGING_FILES, own, "r", 2)
    waiting = sinks.stored_rows(spark, paths[2], assembly._PENDING_FILES, own, "r", 2)
    judged = assembly._judged(own, stored, waiting, "America/New_York")
    assert rows_of(judged, "is_valid", "waited") == [(True, True)] * 5
    assert judged._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 4


def test_files_of_a_part_grow_with_its_rows():
    sizes = [registry._part_files(rows) for rows in (0, 100_000, 1_000_000, 1_000_001, 36_000_000)]
    assert sizes == [4, 4, 4, 5, 144]


def test_a_later_part_replaces_an_earlier_one_whatever_the_row_order(spark):
    rows = [
        ("a", None, 41.0, None, None, 2, 0, 7), ("a", None, 40.0, None, None, 2, 0, 6),
        ("a", None, 43.0, None, None, 1, 1, 9), ("a", None, None, -73.0, "B1", 1, 0, 0),
        ("a", "2014-04-01T04:00:00+00:00", None, None, None, 3, 0, 0), ("b", None, 40.0, None, None, 1, 0, 0),
        ("c", None, 40.0, None, None, 1, None, None), ("c", None, 41.0, None, None, 1, None, None),
        ("c", "2014-04-01T04:00:00+00:00", None, -73.0, "B1", 1, None, None),
    ]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(
            order,
            "trip_id string, event_timestamp string, pickup_latitude double, pickup_longitude double,"
            " base string, second int, partition bigint, offset bigint",
        ).withColumn("arrival", F.timestamp_seconds("second"))
        events = assembly.complete_events(assembly.assemble(frame))
        assert rows_of(events) == [
            ("a", "2014-04-01T04:00:00+00:00", 41.0, -73.0, "B1"),
            ("c", "2014-04-01T04:00:00+00:00", 41.0, -73.0, "B1"),
        ]


def test_state_settings_are_given_back(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.streaming.join.stateFormatVersion"]
    before = [spark.conf.get(key) for key in keys]
    with disk_backed_state(spark, 77):
        assert spark.conf.get(keys[0]) == "77"
    assert [spark.conf.get(key) for key in keys] == before


# The relational sink, up to the connection


class Recorder:
    def __init__(self, fail_at=None):
        self.calls, self.fail_at = [], fail_at

    def __call__(self):
        self.calls.append("connect")
        return self

    def cursor(self):
        return self

    def execute(self, statement, values=None):
        if len(self.calls) == self.fail_at:
            raise RuntimeError("lost connection")
        self.calls.append((statement, values))

    def commit(self):
        self.calls.append("commit")

    def close(self):
        self.calls.append("close")


def test_relational_merge_is_one_transaction():
    statements = sinks.merge_statements("staging.ingest", "staging.trips", "analytics.batches")
    recorder = Recorder()
    sinks.apply_merge(recorder, statements, 7, 123)
    assert recorder.calls == [
        "connect", (statements[0], None), (statements[1], None), (statements[2], (7, 123)), "commit", "close",
    ]
    assert "on conflict (trip_id) do nothing" in statements[0]
    assert statements[1] == "truncate table staging.ingest"
    assert "on conflict (batch_id) do update" in statements[2]


def test_a_failed_merge_commits_nothing():
    recorder = Recorder(fail_at=2)
    with pytest.raises(RuntimeError):
        sinks.apply_merge(recorder, sinks.merge_statements("a", "b", "c"), 1, 1)
    assert "commit" not in recorder.calls and recorder.calls[-1] == "close"


def test_relational_sink_signature():
    parameters = list(inspect.signature(sinks.write_jdbc_stream).parameters)
    assert parameters[:7] == [
        "stream", "jdbc_url", "ingest_table", "target_table", "user", "password", "checkpoint_path",
    ]


def test_payload_of_a_role_holds_its_fields_only(spark):
    event = canonical_events(raw(spark, VALID))
    for role, fields in PARTIAL_FIELDS.items():
        part = shards.project_partial(event, role)
        value = message_payload(part, ("trip_id", *fields)).first().value
        assert tuple(json.loads(value)) == ("trip_id", *fields)
