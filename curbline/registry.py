"""Every query of the package over the driver's ``events`` table: name -> (spark, sf_dir) -> frame.

Streams run until the table is used up and write below ``work_dir``; their query returns a
batch read of what they wrote. Instants leave as ISO text and decimals as doubles, so that
values compare across engines and session time zones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from curbline.functions import clock
from curbline.operators import canonical, enrich, merge, positions, shards
from curbline.plans import aggregates, layout, models, quality, serving, trips
from curbline.schema import EVENT_COLUMNS, PARTIAL_FIELDS, RAW_COLUMNS, SHARD_COLUMNS
from curbline.session import work_dir
from curbline.sources import event_table, json_lines, messages, raw_csv, shard_csv, shard_tables
from curbline.streaming import assembly, jobs, sinks
from curbline.streaming.batches import read_batches

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Upper bounds of one micro-batch of the file streams.
BATCH_BYTES = 256 * 1024**3
BATCH_FILES = 1_000


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _iso(instant: str) -> Column:
    return clock.iso_utc(F.col(instant))


def comparable(frame: DataFrame) -> DataFrame:
    columns = []
    for field in frame.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = _iso(field.name)
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_table.raw_rows(event_table.read_events(spark, sf_dir))


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_table.staging_source(event_table.read_events(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trip_fact(trips.staging_trips(_source(spark, sf_dir)))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.message_payload(
        event_table.wire_events(event_table.read_events(spark, sf_dir))
    )


def _event_stream(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    limits = limits or {"max_bytes": BATCH_BYTES}
    path = event_table.table_path(sf_dir)
    return messages.file_stream(spark, path, event_table.TABLE_SCHEMA, **limits)


def _message_stream(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    events = _event_stream(spark, sf_dir, **limits)
    return messages.message_payload(event_table.wire_events(events))


MESSAGE = "key string, value string, timestamp timestamp"
# Parts, and so micro-batches, that the table is sent in, and the files of each: at least so many, and more for many rows.
SLICES = 12
PART_FILES = 4
FILE_ROWS = 250_000


def _part_files(rows: int) -> int:
    """The files of parts of about so many rows."""
    return max(PART_FILES, -(-rows // FILE_ROWS))


def _inbox(parts: list[DataFrame], folder: str, files: int = PART_FILES) -> str:
    """``files`` files per part, in this order: with so many files at a time, a part is a micro-batch."""
    for number, part in enumerate(parts):
        part.repartition(files).write.parquet(f"{folder}/{number:03d}")
    return f"{folder}/*"


def _sliced(spark: SparkSession, sf_dir: str) -> tuple[list[DataFrame], int]:
    """The messages in slices by event id, each a minute later than the one before, and the files of each."""
    events = event_table.read_events(spark, sf_dir)
    slices = [
        messages.message_payload(
            event_table.wire_events(events.where(F.col("event_id") % SLICES == number)).withColumn(
                "timestamp", F.timestamp_seconds(F.lit(1_400_000_000 + 60 * number))
            ),
            keep=("timestamp",),
        )
        for number in range(SLICES)
    ]
    return slices, _part_files(events.count() // SLICES)


def _part_stream(spark: SparkSession, path: str, parts: int = 1, files: int = PART_FILES) -> DataFrame:
    """An inbox as a stream, so many parts at a time."""
    return messages.file_stream(spark, path, MESSAGE, max_files=parts * files)


def _slice_stream(spark: SparkSession, sf_dir: str, folder: str, parts: int = 1) -> DataFrame:
    slices, files = _sliced(spark, sf_dir)
    return _part_stream(spark, _inbox(slices, f"{folder}/inbox", files), parts, files)


def _landed(rows: DataFrame, folder: str) -> DataFrame:
    """Rows written once, for what reads them several times."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


# Ingest


@query
def canonical_events(spark, sf_dir):
    return canonical.canonical_events(_raw(spark, sf_dir))


@query
def csv_canonical_events(spark, sf_dir):
    """The same through CSV files: written, read by header, numbered, parsed.

    Written in order, as a source has it, for the numbers to be those of the table however
    its files are cut; the reader sorts no rows.
    """
    folder = work_dir(spark, "csv")
    ordered = _raw(spark, sf_dir).sort("row_number").select(*RAW_COLUMNS)
    ordered.write.option("header", True).csv(f"{folder}/raw")
    rows = raw_csv.read_raw_csv(spark, f"{folder}/raw", f"{folder}/landed")
    return canonical.canonical_events(rows, keep_row_number=True)


@query
def trip_ids_raw_text(spark, sf_dir):
    events = canonical.canonical_events(_raw(spark, sf_dir), keep_row_number=True)
    return events.select("row_number", "trip_id")


@query
def trip_ids_numeric(spark, sf_dir):
    """Ids over parsed numbers: padding the coordinate text with zeros changes none."""
    padded = _raw(spark, sf_dir).withColumns(
        {name: F.concat(F.col(name), F.lit("00")) for name in ("Lat", "Lon")}
    )
    events = canonical.canonical_events(padded, numeric_id=True, keep_row_number=True)
    return events.select("row_number", "trip_id")


@query
def rejected_rows(spark, sf_dir):
    return canonical.rejected_rows(_raw(spark, sf_dir))


@query
def first_n(spark, sf_dir):
    events = canonical.canonical_events(_raw(spark, sf_dir), keep_row_number=True)
    return positions.take_range(events, limit=500).select("position", "row_number", "trip_id")


@query
def resume_from_position(spark, sf_dir):
    events = canonical.canonical_events(_raw(spark, sf_dir), keep_row_number=True)
    return positions.take_range(events, skip=600).select("position", "row_number", "trip_id")


def _slices(spark, sf_dir, **sizes) -> DataFrame:
    events = canonical.canonical_events(_raw(spark, sf_dir), keep_row_number=True)
    sliced = positions.with_slice(positions.with_position(events), **sizes)
    return sliced.groupBy("slice_no").agg(
        F.count(F.lit(1)).alias("slice_rows"),
        F.min("row_number").alias("first_row"),
        F.max("row_number").alias("last_row"),
    )


@query
def replay_slices(spark, sf_dir):
    return _slices(spark, sf_dir)


@query
def replay_slices_short_head(spark, sf_dir):
    return _slices(spark, sf_dir, head_start=300)


# Column shards


def _split(spark, sf_dir) -> dict[str, DataFrame]:
    return shards.split_columns(shards.land_keyed(_raw(spark, sf_dir), work_dir(spark, "keyed")))


def _partials(spark, sf_dir) -> dict[str, DataFrame]:
    split = _split(spark, sf_dir)
    return {role: shards.partial_events(role, split[role]) for role in SHARD_COLUMNS}


@query
def shard_split_counts(spark, sf_dir):
    """Row count and first and last id of each shard, as read back from its CSV."""
    folder = work_dir(spark, "shards")
    shard_csv.write_shard_csv(_split(spark, sf_dir), folder)
    counts = [
        shard.agg(
            F.count(F.lit(1)).alias("shard_rows"),
            F.min("trip_id").alias("first_id"),
            F.max("trip_id").alias("last_id"),
        ).select(F.lit(role).alias("shard"), "*")
        for role, shard in shard_csv.read_shard_csv(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def shard_join(spark, sf_dir):
    return shards.merge_shards(_split(spark, sf_dir))


@query
def shard_join_unchecked(spark, sf_dir):
    """All shard rows put together as text, before any check."""
    return shards.join_shards(_split(spark, sf_dir)).withColumnRenamed("Date/Time", "event_time")


@query
def merged_count(spark, sf_dir):
    """Rows of the merged table, counted from what was written."""
    folder = work_dir(spark, "merged")
    shards.merge_shards(_split(spark, sf_dir)).write.mode("overwrite").parquet(folder)
    return shard_csv.read_merged(spark, folder).agg(F.count(F.lit(1)).alias("merged_rows"))


@query
def merged_sample(spark, sf_dir):
    merged = shards.merge_shards(_split(spark, sf_dir))
    return merged.orderBy("trip_id").limit(5)


@query
def shard_validation(spark, sf_dir):
    split = _split(spark, sf_dir)
    counts = [
        shards.parse_shard(role, split[role])
        .agg(
            F.count_if("is_valid").alias("valid_rows"),
            F.count_if(~F.col("is_valid")).alias("skipped_rows"),
        )
        .select(F.lit(role).alias("shard"), "*")
        for role in SHARD_COLUMNS
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def shard_orphans(spark, sf_dir):
    return shards.orphan_ids(_partials(spark, sf_dir))


@query
def shard_reconciliation(spark, sf_dir):
    return shards.reconcile(_partials(spark, sf_dir))


# Buckets of a shard's table in these queries; set so that a bucket has some 100 MB.
SHARD_BUCKETS = 16


def _tables(spark, sf_dir, again: bool = False) -> dict[str, DataFrame]:
    """The shards as bucketed tables, the times of every tenth id three times if ``again``."""
    folder = work_dir(spark, "shard_tables")
    keyed = shards.land_keyed(_raw(spark, sf_dir), work_dir(spark, "keyed"))
    split = shards.split_columns(keyed)
    if again:
        copies = F.when(F.col("row_number") % 10 == 0, 3).otherwise(1)
        thrice = keyed.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        split["datetime"] = shards.split_columns(thrice)["datetime"]
    return shard_tables.write_shard_tables(split, folder, f"shard_{folder.rpartition('-')[2]}", SHARD_BUCKETS)


@query
def shard_tables_join(spark, sf_dir):
    """Events put together from bucketed tables, without an exchange."""
    return shard_tables.join_tables(_tables(spark, sf_dir))


@query
def shard_tables_orphans(spark, sf_dir):
    """Ids that are not in all bucketed tables, without an exchange."""
    return shard_tables.orphans_of_tables(_tables(spark, sf_dir))


@query
def shard_tables_repeats(spark, sf_dir):
    """Ids that came more than once in a shard, kept once by its table."""
    return shard_tables.repeated_ids(_tables(spark, sf_dir, again=True))


# Messages


@query
def kafka_payload(spark, sf_dir):
    return _messages(spark, sf_dir)


@query
def json_roundtrip(spark, sf_dir):
    return enrich.decode_events(_messages(spark, sf_dir))


@query
def jsonl_export(spark, sf_dir):
    folder = work_dir(spark, "jsonl")
    json_lines.write_json_lines(canonical.canonical_events(_raw(spark, sf_dir)), folder)
    return json_lines.read_json_lines(spark, folder)


@query
def stream_valid_events(spark, sf_dir):
    return comparable(enrich.valid_events(enrich.decode_events(_messages(spark, sf_dir))))


@query
def stream_enriched(spark, sf_dir):
    return comparable(enrich.transform_messages(_messages(spark, sf_dir)))


# Models


@query
def stg_trips(spark, sf_dir):
    return comparable(trips.staging_trips(_source(spark, sf_dir)))


@query
def fct_trips(spark, sf_dir):
    return comparable(_fact(spark, sf_dir))


@query
def trips_by_date(spark, sf_dir):
    return comparable(aggregates.trips_by_date(_fact(spark, sf_dir))).orderBy("trip_date")


@query
def trips_by_hour(spark, sf_dir):
    return comparable(aggregates.trips_by_hour(_fact(spark, sf_dir))).orderBy("pickup_hour")


@query
def trips_by_base(spark, sf_dir):
    return comparable(aggregates.trips_by_base(_fact(spark, sf_dir)))


@query
def trips_by_day_type(spark, sf_dir):
    return comparable(aggregates.trips_by_day_type(_fact(spark, sf_dir)))


@query
def trips_by_time_of_day(spark, sf_dir):
    return comparable(aggregates.trips_by_time_of_day(_fact(spark, sf_dir)))


@query
def day_hour_heatmap(spark, sf_dir):
    return aggregates.day_hour_heatmap(_fact(spark, sf_dir))


@query
def trips_by_base_hour(spark, sf_dir):
    return aggregates.trips_by_base_hour(_fact(spark, sf_dir))


@query
def geo_grid(spark, sf_dir):
    return comparable(aggregates.geo_grid(_fact(spark, sf_dir)))


@query
def kpis(spark, sf_dir):
    return comparable(aggregates.kpis(_fact(spark, sf_dir)))


@query
def model_run(spark, sf_dir):
    """Build every model as a table, then count rows and trips of each."""
    folder = work_dir(spark, "models")
    models.build_models(_source(spark, sf_dir), folder)
    counts = []
    for name in ("trip_fact", *models.AGGREGATES):
        table = models.read_model(spark, folder, name)
        weight = F.lit(1)
        if "trip_count" in table.columns:
            weight = F.col("trip_count")
        elif name == "kpis":
            weight = F.col("total_trips")
        counts.append(
            table.agg(
                F.count(F.lit(1)).alias("model_rows"),
                F.coalesce(F.sum(weight), F.lit(0)).alias("trips"),
            ).select(F.lit(name).alias("model"), "*")
        )
    return reduce(DataFrame.unionByName, counts)


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of models built without the afternoons of the fifteenths, and then brought up to date for those dates."""
    folder = work_dir(spark, "refresh")
    source = _source(spark, sf_dir)
    local = clock.instant_to_local(F.col("event_timestamp"))
    late = (F.dayofmonth(local) == 15) & (F.hour(local) >= 12)
    models.build_models(source.where(~late), folder, view="stg_trips_refresh")
    # One row per date.
    dates = source.where(late).select(F.to_date(local).alias("day")).distinct().collect()
    models.refresh_models(source, folder, [row.day for row in dates])
    return folder


@query
def model_refresh(spark, sf_dir):
    """Daily trips after some dates have grown and were refreshed."""
    return comparable(models.read_model(spark, _refreshed(spark, sf_dir), "trips_by_date"))


@query
def model_refresh_cells(spark, sf_dir):
    """Cells after the same refresh."""
    return comparable(models.read_model(spark, _refreshed(spark, sf_dir), "geo_grid"))


# Serving


@query
def heatmap_pivot(spark, sf_dir):
    return serving.heatmap_pivot(aggregates.day_hour_heatmap(_fact(spark, sf_dir)))


@query
def base_hour_filter(spark, sf_dir):
    return serving.base_hours(aggregates.trips_by_base_hour(_fact(spark, sf_dir)), "purchase")


@query
def top_grid_cells(spark, sf_dir):
    return comparable(serving.top_cells(aggregates.geo_grid(_fact(spark, sf_dir))))


@query
def map_points(spark, sf_dir):
    cells = serving.top_cells(aggregates.geo_grid(_fact(spark, sf_dir)))
    return comparable(serving.map_points(cells))


@query
def kpi_ratios(spark, sf_dir):
    return serving.kpi_ratios(aggregates.kpis(_fact(spark, sf_dir)))


def _built(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the models, built from the table as it is."""
    folder = work_dir(spark, "serving")
    models.build_models(_source(spark, sf_dir), folder, view="stg_trips_serving")
    return folder


def _serving_read(name: str) -> Query:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _built(spark, sf_dir)
        return comparable(serving.serving_table(spark, folder, name))

    read.__doc__ = f"The model {name} as a dashboard reads it: built, in display order."
    return read


QUERIES["serving_tables"] = _serving_read("trips_by_base")
for _name in models.AGGREGATES:
    QUERIES[f"serving_{_name}"] = _serving_read(_name)


@query
def serving_trip_fact(spark, sf_dir):
    """All columns of the fact as built."""
    folder = _built(spark, sf_dir)
    return comparable(models.read_model(spark, folder, "trip_fact"))


@query
def map_window(spark, sf_dir):
    """Trips of one base in a window of the map, from a fact in Morton order."""
    folder = work_dir(spark, "clustered")
    layout.write_clustered(_fact(spark, sf_dir), folder)
    found = layout.in_window(layout.read_clustered(spark, folder), (-30.0, 45.0), (-75.0, 60.0), "purchase")
    return comparable(found.select("trip_id", "trip_date", "latitude_grid", "longitude_grid"))


# Streams


def _lake(spark: SparkSession, messages_: DataFrame) -> DataFrame:
    folder = work_dir(spark, "lake")
    stream = enrich.transform_messages(messages_)
    sinks.write_parquet_stream(
        stream, f"{folder}/lake", f"{folder}/checkpoint", "available"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/lake").select(*stream.columns)


@query
def stream_parquet_append(spark, sf_dir):
    return comparable(_lake(spark, _message_stream(spark, sf_dir)))


@query
def rate_limited_stream(spark, sf_dir):
    """Trips per date of a lake filled from a bounded number of files at a time."""
    lake = _lake(spark, _message_stream(spark, sf_dir, max_files=BATCH_FILES))
    return lake.groupBy("trip_date").agg(F.count(F.lit(1)).alias("trip_count"))


def _merge_stream(
    spark: SparkSession, messages_: DataFrame, folder: str, checkpoint: str = "first", **options
) -> None:
    sinks.write_staging_stream(
        enrich.transform_messages(enrich.arrival_of(messages_), keep=("arrival",)),
        f"{folder}/staging",
        f"{folder}/metrics",
        f"{folder}/checkpoint-{checkpoint}",
        "available",
        **options,
    ).awaitTermination()


@query
def stream_idempotent_merge(spark, sf_dir):
    """Every message is delivered twice; each trip is stored once."""
    folder = work_dir(spark, "merge")
    twice = _message_stream(spark, sf_dir).withColumn(
        "delivery", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    _merge_stream(spark, twice, folder)
    return comparable(sinks.read_staging(spark, f"{folder}/staging"))


@query
def stream_first_trip_stays(spark, sf_dir):
    """Ids come again with another base, in the same batch and later, and under another date:
    the trip that arrived first is the one stored."""
    folder = work_dir(spark, "moved")
    events = event_table.read_events(spark, sf_dir)
    files = _part_files(events.count())
    wire = _landed(event_table.wire_events(events.repartition(files)).where("base <> ''"), f"{folder}/wire")

    def sent(events: DataFrame, second: int) -> DataFrame:
        at = F.timestamp_seconds(F.lit(1_400_000_000 + second))
        return messages.message_payload(events.withColumn("timestamp", at), keep=("timestamp",))

    renamed = wire.withColumn("base", F.lit("A0"))
    moved = wire.withColumn("event_timestamp", F.lit("2030-01-01T12:00:00+00:00"))
    parts = [sent(renamed, 1).unionByName(sent(wire, 0)), sent(moved, 60), sent(renamed, 120)]
    stream = _part_stream(spark, _inbox(parts, f"{folder}/inbox", files), files=files)
    _merge_stream(spark, stream, folder, compact_every=2)
    return comparable(sinks.read_staging(spark, f"{folder}/staging"))


@query
def stream_replay_merge(spark, sf_dir):
    """The whole source is read twice, cut into other batches by a fresh checkpoint; the table
    stays as it was."""
    folder = work_dir(spark, "replay")
    slices, files = _sliced(spark, sf_dir)
    path = _inbox(slices, f"{folder}/inbox", files)
    for checkpoint, parts in (("first", 5), ("again", 4)):
        _merge_stream(spark, _part_stream(spark, path, parts, files), folder, checkpoint)
    staging = sinks.read_staging(spark, f"{folder}/staging")
    return staging.groupBy("trip_date").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.min("trip_id").alias("first_id"),
        F.max("trip_id").alias("last_id"),
    )


def _metrics(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """The metrics of a stream that takes the table in slices, folded along the way."""
    folder = work_dir(spark, label)
    _merge_stream(spark, _slice_stream(spark, sf_dir, folder), folder, compact_every=5)
    return sinks.read_batch_metrics(spark, f"{folder}/metrics")


@query
def stream_batch_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, "metrics").select("batch_id", "records_received")


@query
def stream_health(spark, sf_dir):
    return serving.stream_health(_metrics(spark, sf_dir, "health")).drop("last_processed")


@query
def recent_batches(spark, sf_dir):
    """The last ten of twelve batches, latest first."""
    recent = serving.recent_batches(_metrics(spark, sf_dir, "recent"))
    return recent.select("batch_id", "records_received")


@query
def stream_two_sinks(spark, sf_dir):
    """One stream definition into lake and staging table; the trips in each."""
    folder = work_dir(spark, "sinks")
    started = jobs.start_trip_queries(
        _slice_stream(spark, sf_dir, folder, parts=4),
        f"{folder}/lake",
        f"{folder}/staging",
        f"{folder}/metrics",
        f"{folder}/checkpoints",
        trigger="available",
    )
    for running in started:
        running.awaitTermination()
    staging = sinks.read_staging(spark, f"{folder}/staging")
    lake = spark.read.parquet(f"{folder}/lake").select(*staging.columns)
    named = [t.withColumn("sink", F.lit(n)) for n, t in (("lake", lake), ("staging", staging))]
    return comparable(named[0].unionByName(named[1]))


def _routed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a stream that sends valid events and refused messages to two tables."""
    folder = work_dir(spark, "routed")
    judged = enrich.judged_messages(enrich.arrival_of(_slice_stream(spark, sf_dir, folder, parts=4)), keep=("arrival",))
    paths = [f"{folder}/{name}" for name in ("staging", "metrics", "rejects", "checkpoint")]
    sinks.write_routed_stream(judged, *paths, trigger="available").awaitTermination()
    return folder


@query
def stream_routed_rejects(spark, sf_dir):
    """What a running stream refused, with the reason."""
    return sinks.read_rejects(spark, f"{_routed(spark, sf_dir)}/rejects").select("value", "reason")


@query
def stream_routed_balance(spark, sf_dir):
    """Per batch the valid and the refused messages, which are all that it received."""
    folder = _routed(spark, sf_dir)
    valid = sinks.read_batch_metrics(spark, f"{folder}/metrics").select("batch_id", F.col("records_received").alias("valid"))
    refused = sinks.read_rejects(spark, f"{folder}/rejects").groupBy(F.col("batch").cast("bigint").alias("batch_id"))
    return valid.join(refused.agg(F.count(F.lit(1)).alias("refused")), "batch_id").select(
        "batch_id", "valid", "refused", (F.col("valid") + F.col("refused")).alias("received")
    )


@query
def metrics_upsert(spark, sf_dir):
    """Batch metrics written again for the same batch: one batch per date, its size first
    with all rows, then, where the date has valid afternoon trips, with those only."""
    source = _source(spark, sf_dir)
    day = F.to_date(clock.instant_to_local(F.col("event_timestamp")))

    def metrics(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.unix_date(day).cast("bigint").alias("batch_id")).agg(
            F.count(F.lit(1)).alias("records_received"),
            F.max("event_timestamp").alias("processed_at"),
        )

    hour = F.hour(clock.instant_to_local(F.col("event_timestamp")))
    old, new = metrics(source), metrics(source.where(enrich.is_valid_event() & (hour >= 12)))
    later = F.timestamp_add("DAY", F.lit(1), F.col("processed_at"))
    new = new.withColumn("processed_at", later)
    merged = merge.upsert_latest(old, new, ("batch_id",), "processed_at")
    return merged.select("batch_id", "records_received")


def _assemble(spark: SparkSession, sf_dir: str) -> str:
    """The folder of staging and pending table, of parts that come in four files.

    Minutes after the first file: 0 the times, and the latitudes of every fifth id, wrong; 10 the
    right latitudes of all but every seventh id; 20 longitudes and bases, and the times of every
    third id again; 180 the late latitudes, and the times of every eleventh id again.
    """
    folder = work_dir(spark, "assembly")
    events = event_table.read_events(spark, sf_dir)
    files = _part_files(events.count())
    rows = event_table.raw_rows(events.repartition(files), ("event_id",))
    split = shards.split_columns(shards.land_keyed(rows, f"{folder}/keyed"), keep=("event_id",))
    typed = {
        role: shards.partial_events(role, split[role], keep=("event_id",)) for role in PARTIAL_FIELDS
    }

    def sent(role: str, condition: str, minute: int, change: Column | None = None) -> DataFrame:
        part = typed[role].where(condition)
        if change is not None:
            part = part.withColumn("pickup_latitude", change)
        at = F.timestamp_seconds(F.lit(1_400_000_000 + 60 * minute))
        fields = ("trip_id", *PARTIAL_FIELDS[role])
        return messages.message_payload(part.withColumn("timestamp", at), fields, ("timestamp",))

    parts = [
        sent("datetime", "true", 0).unionByName(
            sent("latitude", "event_id % 5 = 0 and event_id % 7 <> 0", 0, F.lit(1.5))
        ),
        sent("latitude", "event_id % 7 <> 0", 10),
        sent("longitude_base", "true", 20).unionByName(sent("datetime", "event_id % 3 = 0", 20)),
        sent("latitude", "event_id % 7 = 0", 180).unionByName(
            sent("datetime", "event_id % 11 = 0", 180)
        ),
    ]
    assembly.write_assembly_stream(
        assembly.decode_partials(_part_stream(spark, _inbox(parts, f"{folder}/inbox", files), files=files)),
        f"{folder}/staging",
        f"{folder}/metrics",
        f"{folder}/pending",
        f"{folder}/checkpoint",
        trigger="available",
    ).awaitTermination()
    return folder


@query
def stream_assembly_agg(spark, sf_dir):
    """Assembled trips, those with late parts included."""
    folder = _assemble(spark, sf_dir)
    return comparable(sinks.read_staging(spark, f"{folder}/staging"))


@query
def stream_assembly_join(spark, sf_dir):
    """Wire events of the ids that the last file completes, hours after their other parts."""
    folder = _assemble(spark, sf_dir)
    late = read_batches(spark, f"{folder}/staging", sinks.STAGING_FILES).where("batch = '3'")
    return late.withColumn("event_timestamp", _iso("event_timestamp")).select(*EVENT_COLUMNS)


@query
def stream_assembly_rejects(spark, sf_dir):
    """Ids that wait for parts that never come, with the fields that each has."""
    folder = _assemble(spark, sf_dir)
    waiting = assembly.read_pending(spark, f"{folder}/pending")
    held = [F.col(name).isNotNull().alias(f"has_{role}") for role, (name, *_) in PARTIAL_FIELDS.items()]
    return waiting.select("trip_id", *held)


@query
def partial_payloads(spark, sf_dir):
    """Key and value of each partial event, by role."""
    payloads = [
        messages.message_payload(part, ("trip_id", *PARTIAL_FIELDS[role])).withColumn("role", F.lit(role))
        for role, part in _partials(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, payloads)


@query
def shard_rejects(spark, sf_dir):
    """Shard rows that their role's checks refuse, with the reason."""
    split = _split(spark, sf_dir)
    refused = [
        shards.rejected_shard_rows(role, split[role]).withColumn("role", F.lit(role))
        for role in SHARD_COLUMNS
    ]
    return reduce(DataFrame.unionByName, refused)


@query
def stream_rejects(spark, sf_dir):
    """Messages that the stream refuses, with the reason."""
    return enrich.rejected_messages(_messages(spark, sf_dir))


# Data quality, over rows that have not been filtered


def _unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.add_calendar(_source(spark, sf_dir))


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfiltered rows, those of one base twice."""
    rows = _unfiltered(spark, sf_dir)
    copies = F.when(F.col("base") == "purchase", 2).otherwise(1)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


@query
def dq_not_null(spark, sf_dir):
    """Null counts with an empty base read as null."""
    rows = _unfiltered(spark, sf_dir).withColumn("base", F.nullif("base", F.lit("")))
    names = quality.NOT_NULL["staging_trips"]
    return quality.count_violations(rows, {f"{n}_not_null": F.col(n).isNull() for n in names})


@query
def dq_unique(spark, sf_dir):
    return quality.duplicates(_redelivered(spark, sf_dir), "trip_id")


@query
def dq_coordinates(spark, sf_dir):
    rows = _unfiltered(spark, sf_dir).where(quality.bad_coordinates())
    return rows.select("trip_id", "pickup_latitude", "pickup_longitude")


@query
def dq_hours(spark, sf_dir):
    """Hours moved to UTC by addition without wrapping round at midnight."""
    moved = _unfiltered(spark, sf_dir).withColumn("pickup_hour", F.col("pickup_hour") + 5)
    return moved.where(quality.bad_hour()).select("trip_id", "pickup_hour")


@query
def dq_dates(spark, sf_dir):
    """Dates taken in UTC, held against the source zone."""
    rows = enrich.add_calendar(_source(spark, sf_dir), "UTC").where(quality.bad_date())
    return rows.select("trip_id", "trip_date")


@query
def dq_contract(spark, sf_dir):
    return quality.contract_report(_redelivered(spark, sf_dir))


@query
def dq_contract_rows(spark, sf_dir):
    return comparable(quality.satisfies_contract(_unfiltered(spark, sf_dir)))


@query
def dq_model_tests(spark, sf_dir):
    """The data tests on the view and the tables of a model run."""
    folder = _built(spark, sf_dir)
    built = {name: models.read_model(spark, folder, name) for name in ("trip_fact", "kpis")}
    return quality.model_report({"staging_trips": trips.staging_trips(_source(spark, sf_dir)), **built})


@query
def dq_summary(spark, sf_dir):
    return quality.quality_summary(_redelivered(spark, sf_dir))
