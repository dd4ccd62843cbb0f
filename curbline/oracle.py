"""Independent SQL for each query of the registry, in DuckDB's dialect over ``events``.

Percentages use whole numbers: DuckDB divides decimals as doubles, which rounds ties wrongly.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_RAW = """
raw as (
  select event_id + 1 as row_number, ts,
    strftime(ts, '%-m/%-d/%Y %-H:%M:%S') as date_text,
    case when event_id % 89 = 0 then 95.0::double
         else (405000 + round_even(value * 100, 0)::bigint % 4000)::double / 10000 end as lat,
    (-742000 + (user_id * 37 + event_id) % 5000)::double / 10000 as lon,
    case when event_id % 97 = 0 then '' else event_type end as base
  from events),
typed as (
  select *,
    'uber-' || sha256(concat_ws('|', row_number, date_text, lat, lon, base))[1:20] as trip_id,
    timezone('UTC', timezone('America/New_York', ts)) as utc
  from raw),
wire as (
  select row_number, ts, trip_id, strftime(utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' as event_timestamp,
    lat as pickup_latitude, lon as pickup_longitude, base, lat <= 90 and base <> '' as ok
  from typed)
"""

_FACT = (
    _RAW
    + """,
rich as (
  select *, ts::date as trip_date, hour(ts)::int as pickup_hour, isodow(ts)::int as day_of_week,
    strftime(ts, '%a') as day_name, isodow(ts) >= 6 as is_weekend,
    case when hour(ts) >= 5 and hour(ts) < 12 then 'Morning'
         when hour(ts) >= 12 and hour(ts) < 17 then 'Afternoon'
         when hour(ts) >= 17 and hour(ts) < 21 then 'Evening' else 'Night' end as time_of_day,
    hour(ts) in (7, 8, 9, 10, 17, 18, 19, 20) as is_peak_hour,
    round(pickup_latitude::decimal(16, 13), 2)::double as latitude_grid,
    round(pickup_longitude::decimal(16, 13), 2)::double as longitude_grid
  from wire),
fact as (select * from rich where ok)
"""
)

_EVENT = "trip_id, event_timestamp, pickup_latitude, pickup_longitude, base"
_STAGED = _EVENT + ", trip_date, pickup_hour, day_of_week"
_FACT_COLUMNS = (
    _STAGED
    + ", day_name, is_weekend, time_of_day, is_peak_hour, latitude_grid, longitude_grid"
)


def _with(ctes: str, select: str) -> str:
    return f"with {ctes.strip()}\n{select.strip()}"


def _ratio(part: str, whole: str, scale: int = 100) -> str:
    """round(scale * part / whole, 2), half away from zero, in whole numbers."""
    p, w = f"({part})::hugeint", f"nullif(({whole})::hugeint, 0)"
    return f"(sign({part}) * ((200 * {scale} * abs({p}) + {w}) // (2 * {w})) / 100.0)::double"


def _counted(keys: str, names: str) -> str:
    return f"c as (select {keys}, count(*) as trip_count from fact group by {names})"


_SHARE = _ratio("trip_count", "sum(trip_count) over ()") + " as share_pct"
_RANK = "rank() over (order by trip_count desc) as rank"

# Ingest

ORACLE["canonical_events"] = _with(_RAW, f"select {_EVENT} from wire where ok")
ORACLE["csv_canonical_events"] = _with(_RAW, f"select row_number, {_EVENT} from wire where ok")
ORACLE["trip_ids_raw_text"] = _with(_RAW, "select row_number, trip_id from wire where ok")
ORACLE["trip_ids_numeric"] = ORACLE["trip_ids_raw_text"]
ORACLE["rejected_rows"] = _with(
    _RAW,
    """select row_number, case when base = '' then 'empty_base' else 'latitude_out_of_range' end
       as reason from wire where not ok""",
)
_POSITIONED = _RAW + ", placed as (select *, row_number() over (order by row_number) as position from wire where ok)"
ORACLE["first_n"] = _with(
    _POSITIONED, "select position, row_number, trip_id from placed where position <= 500"
)
ORACLE["resume_from_position"] = _with(
    _POSITIONED, "select position, row_number, trip_id from placed where position > 600"
)


def _slices(head: int) -> str:
    return _with(
        _POSITIONED,
        f"""select slice_no, count(*) as slice_rows, min(row_number) as first_row,
              max(row_number) as last_row
            from (select *, case when position <= {head} then 0
                    else 1 + (position - 1 - {head}) // 20 end as slice_no from placed)
            group by slice_no""",
    )


ORACLE["replay_slices"] = _slices(50_000)
ORACLE["replay_slices_short_head"] = _slices(300)

# Column shards

ORACLE["shard_split_counts"] = _with(
    _RAW,
    """select shard, count(*) as shard_rows, min(trip_id) as first_id, max(trip_id) as last_id
       from wire, (values ('datetime'), ('latitude'), ('longitude_base')) as s(shard)
       group by shard""",
)
ORACLE["shard_join"] = _with(
    _RAW,
    f"""select {_EVENT} from (select trip_id, event_timestamp from wire)
        join (select trip_id, pickup_latitude from wire where pickup_latitude between -90 and 90)
          using (trip_id)
        join (select trip_id, pickup_longitude, base from wire where base <> '') using (trip_id)""",
)
ORACLE["shard_join_unchecked"] = _with(
    _RAW,
    """select trip_id, date_text as event_time, lat::varchar as "Lat", lon::varchar as "Lon",
         base as "Base" from typed""",
)
ORACLE["merged_count"] = _with(_RAW, "select count(*) as merged_rows from wire where ok")
ORACLE["merged_sample"] = _with(
    _RAW, f"select {_EVENT} from wire where ok order by trip_id limit 5"
)
ORACLE["shard_validation"] = _with(
    _RAW,
    """select 'datetime' as shard, count(*) as valid_rows, 0::bigint as skipped_rows from wire
       union all select 'latitude', count(*) filter (pickup_latitude <= 90),
         count(*) filter (pickup_latitude > 90) from wire
       union all select 'longitude_base', count(*) filter (base <> ''),
         count(*) filter (base = '') from wire""",
)
ORACLE["shard_orphans"] = _with(
    _RAW,
    """select trip_id, true as in_datetime, pickup_latitude <= 90 as in_latitude,
         base <> '' as in_longitude_base from wire where not ok""",
)
ORACLE["shard_reconciliation"] = _with(
    _RAW,
    """select count(*) as datetime_rows,
         count(*) filter (pickup_latitude <= 90) as latitude_rows,
         count(*) filter (base <> '') as longitude_base_rows, count(distinct trip_id) as distinct_ids,
         count(*) filter (ok) as merged_ids, count(*) filter (not ok) as orphan_ids from wire""",
)

ORACLE["shard_tables_join"] = ORACLE["shard_join"]
ORACLE["shard_tables_orphans"] = ORACLE["shard_orphans"]
ORACLE["shard_tables_repeats"] = _with(
    _RAW,
    "select 'datetime' as role, trip_id, 3::bigint as copies from wire where row_number % 10 = 0",
)

# Messages

_VALUE = """'{"trip_id":"' || trip_id || '","event_timestamp":"' || event_timestamp ||
         '","pickup_latitude":' || pickup_latitude || ',"pickup_longitude":' || pickup_longitude ||
         ',"base":"' || base || '"}'"""
ORACLE["kafka_payload"] = _with(_RAW, f"select trip_id as key, {_VALUE} as value from wire")
ORACLE["json_roundtrip"] = _with(_RAW, f"select {_EVENT} from wire")
ORACLE["jsonl_export"] = ORACLE["canonical_events"]
ORACLE["stream_valid_events"] = ORACLE["canonical_events"]
ORACLE["stream_enriched"] = _with(_FACT, f"select {_STAGED} from fact")

# Models

ORACLE["stg_trips"] = _with(_FACT, f"select {_FACT_COLUMNS} from fact")
ORACLE["fct_trips"] = ORACLE["stg_trips"]
_BY_DATE = _FACT + ", " + _counted("trip_date", "trip_date")
ORACLE["trips_by_date"] = _with(
    _BY_DATE,
    f"""select trip_date, trip_count, {_SHARE},
          {_ratio("sum(trip_count) over ()", "count(*) over ()", 1)} as avg_daily_trips,
          {_ratio("sum(trip_count) over w", "count(*) over w", 1)} as rolling_7d_avg,
          {_ratio(
              "trip_count - lag(trip_count) over (order by trip_date)",
              "lag(trip_count) over (order by trip_date)",
          )} as pct_change
        from c window w as (order by trip_date rows between 6 preceding and current row)
        order by trip_date""",
)
ORACLE["trips_by_hour"] = _with(
    _FACT + ", " + _counted("pickup_hour, any_value(is_peak_hour) as is_peak_hour", "pickup_hour"),
    f"select pickup_hour, trip_count, {_SHARE}, {_RANK}, is_peak_hour from c order by pickup_hour",
)
ORACLE["trips_by_base"] = _with(
    _FACT + ", " + _counted("base", "base"),
    f"select base, trip_count, {_SHARE}, {_RANK} from c order by trip_count desc",
)
ORACLE["trips_by_day_type"] = _with(
    _FACT + ", " + _counted("if(is_weekend, 'Weekend', 'Weekday') as day_type", "1"),
    f"select day_type, trip_count, {_SHARE} from c order by trip_count desc",
)
ORACLE["trips_by_time_of_day"] = _with(
    _FACT + ", " + _counted("time_of_day", "time_of_day"),
    f"select time_of_day, trip_count, {_SHARE} from c order by trip_count desc",
)
_HEATMAP = _FACT + ", " + _counted("day_of_week, day_name, pickup_hour", "1, 2, 3")
ORACLE["day_hour_heatmap"] = _with(_HEATMAP, "select * from c order by day_of_week, pickup_hour")
_BASE_HOUR = _FACT + ", " + _counted("base, pickup_hour", "1, 2")
ORACLE["trips_by_base_hour"] = _with(_BASE_HOUR, "select * from c order by base, pickup_hour")
_CELLS = _FACT + ", " + _counted("latitude_grid, longitude_grid", "1, 2")
ORACLE["geo_grid"] = _with(
    _CELLS, f"select latitude_grid, longitude_grid, trip_count, {_SHARE}, {_RANK} from c"
)
# Grouping sets hold the counts by date, hour and base side by side; every figure is an
# aggregate over the rows of its set.
ORACLE["kpis"] = _with(
    _FACT
    + """,
counts as (
  select grouping_id(trip_date, pickup_hour, base) as level, trip_date, pickup_hour, base, count(*) as n,
    count(*) filter (is_peak_hour) as peak, count(*) filter (is_weekend) as weekend
  from fact group by grouping sets ((trip_date), (pickup_hour), (base)))
""",
    f"""select coalesce(sum(n) filter (level = 3), 0)::bigint as total_trips,
          count(*) filter (level = 6 and base is not null) as active_bases,
          count(*) filter (level = 3) as unique_dates, count(*) filter (level = 5) as unique_hours,
          {_ratio("(sum(n) filter (level = 3))", "(count(*) filter (level = 3))", 1)} as avg_daily_trips,
          (median(n) filter (level = 3))::double as median_daily_trips,
          arg_max(pickup_hour, n * 100 - pickup_hour) filter (level = 5) as busiest_hour,
          arg_min(pickup_hour, n * 100 + pickup_hour) filter (level = 5) as quietest_hour,
          (min({{'least': -n, 'base': base}}) filter (level = 6)).base as top_base,
          max(n) filter (level = 6) as top_base_trips,
          coalesce(sum(peak) filter (level = 3), 0)::bigint as peak_trips,
          coalesce(sum(weekend) filter (level = 3), 0)::bigint as weekend_trips
       from counts""",
)
_MODEL_KEYS = {
    "trips_by_date": "trip_date",
    "trips_by_hour": "pickup_hour",
    "trips_by_base": "base",
    "trips_by_day_type": "is_weekend",
    "trips_by_time_of_day": "time_of_day",
    "day_hour_heatmap": "day_of_week, pickup_hour",
    "trips_by_base_hour": "base, pickup_hour",
    "geo_grid": "latitude_grid, longitude_grid",
}
ORACLE["model_run"] = _with(
    _FACT,
    "select 'trip_fact' as model, count(*) as model_rows, count(*) as trips from fact\n"
    "union all select 'kpis', 1, count(*) from fact\n"
    + "\n".join(
        f"union all select '{model}', count(*), sum(n)::bigint from"
        f" (select count(*) as n from fact group by {keys})"
        for model, keys in _MODEL_KEYS.items()
    ),
)

# Serving

ORACLE["heatmap_pivot"] = _with(
    _FACT,
    "select day_name, "
    + ", ".join(f"count(*) filter (pickup_hour = {h}) as hour_{h:02d}" for h in range(24))
    + " from fact group by day_name",
)
ORACLE["base_hour_filter"] = _with(_BASE_HOUR, "select * from c where base = 'purchase'")
_TOP = "order by trip_count desc, latitude_grid, longitude_grid limit 250"
ORACLE["top_grid_cells"] = _with(
    _CELLS, f"select latitude_grid, longitude_grid, trip_count, {_SHARE}, {_RANK} from c {_TOP}"
)
ORACLE["map_points"] = _with(
    _CELLS, f"select latitude_grid as lat, longitude_grid as lon from c {_TOP}"
)
ORACLE["map_window"] = _with(
    _FACT,
    """select trip_id, trip_date, latitude_grid, longitude_grid from fact
       where latitude_grid between -30 and 45 and longitude_grid between -75 and 60 and base = 'purchase'""",
)
ORACLE["kpi_ratios"] = _with(
    _FACT,
    """select coalesce(count(*) filter (is_peak_hour)::double / nullif(count(*)::double, 0) * 100, 0)
         as peak_share,
       coalesce(count(*) filter (is_weekend)::double / nullif(count(*)::double, 0) * 100, 0)
         as weekend_share from fact""",
)
ORACLE["model_refresh"] = ORACLE["trips_by_date"]
ORACLE["model_refresh_cells"] = ORACLE["geo_grid"]
ORACLE["serving_tables"] = ORACLE["trips_by_base"]
for _model in (*_MODEL_KEYS, "kpis"):
    ORACLE[f"serving_{_model}"] = ORACLE[_model]
ORACLE["serving_trip_fact"] = ORACLE["fct_trips"]

# Streams

ORACLE["stream_parquet_append"] = ORACLE["stream_enriched"]
ORACLE["rate_limited_stream"] = _with(_BY_DATE, "select trip_date, trip_count from c")
ORACLE["stream_idempotent_merge"] = ORACLE["stream_enriched"]
ORACLE["stream_replay_merge"] = _with(
    _FACT,
    """select trip_date, count(*) as trip_count, min(trip_id) as first_id, max(trip_id) as last_id
       from fact group by trip_date""",
)
ORACLE["stream_first_trip_stays"] = ORACLE["stream_enriched"]
_BATCHES = (
    _RAW
    + """, sizes as (select ((row_number - 1) % 12)::bigint as batch_id, count(*) as records_received
         from wire where ok group by 1)"""
)
ORACLE["stream_batch_metrics"] = _with(_BATCHES, "select * from sizes")
ORACLE["recent_batches"] = _with(_BATCHES, "select * from sizes order by batch_id desc limit 10")
ORACLE["stream_health"] = _with(
    _BATCHES,
    """select max(batch_id) as latest_batch, arg_max(records_received, batch_id) as latest_batch_size,
         least(count(*), 10)::bigint as batches_recorded from sizes""",
)
ORACLE["stream_two_sinks"] = _with(
    _FACT, f"select sink, {_STAGED} from fact, (values ('lake'), ('staging')) as s(sink)"
)
ORACLE["metrics_upsert"] = _with(
    _FACT,
    """select date_diff('day', date '1970-01-01', trip_date) as batch_id,
         case when count(*) filter (ok and pickup_hour >= 12) > 0
              then count(*) filter (ok and pickup_hour >= 12) else count(*) end as records_received
       from rich group by trip_date""",
)
ORACLE["stream_assembly_join"] = _with(
    _RAW, f"select {_EVENT} from wire where ok and (row_number - 1) % 7 = 0"
)
ORACLE["stream_assembly_rejects"] = _with(
    _RAW,
    """select trip_id, true as has_datetime, lat <= 90 as has_latitude, base <> '' as has_longitude_base
         from typed where not (lat <= 90 and base <> '')""",
)
ORACLE["partial_payloads"] = _with(
    _RAW,
    """select 'datetime' as role, trip_id as key, '{"trip_id":"' || trip_id || '","event_timestamp":"' ||
         event_timestamp || '"}' as value from wire
       union all select 'latitude', trip_id, '{"trip_id":"' || trip_id || '","pickup_latitude":' ||
         pickup_latitude || '}' from wire where pickup_latitude <= 90
       union all select 'longitude_base', trip_id, '{"trip_id":"' || trip_id ||
         '","pickup_longitude":' || pickup_longitude || ',"base":"' || base || '"}' from wire where base <> ''""",
)
ORACLE["shard_rejects"] = _with(
    _RAW,
    """select 'latitude' as role, trip_id, 'bad latitude' as reason from wire where pickup_latitude > 90
       union all select 'longitude_base', trip_id, 'no base' from wire where base = ''""",
)
ORACLE["stream_rejects"] = _with(
    _RAW,
    f"""select {_VALUE} as value, concat_ws(', ', case when pickup_latitude > 90 then 'bad latitude' end,
         case when base = '' then 'no base' end) as reason
       from wire where not ok""",
)
ORACLE["stream_routed_rejects"] = ORACLE["stream_rejects"]
ORACLE["stream_routed_balance"] = _with(
    _RAW,
    """select (row_number - 1) % 12 // 4 as batch_id, count(*) filter (ok) as valid, count(*) filter (not ok) as refused,
         count(*) as received from wire group by batch_id""",
)
ORACLE["stream_assembly_agg"] = ORACLE["stream_enriched"]

# Data quality

ORACLE["dq_not_null"] = _with(
    _RAW,
    """select rule, case when rule = 'base_not_null' then count(*) filter (base = '') else 0 end
         as violations
       from wire, (values ('trip_id_not_null'), ('event_timestamp_not_null'),
         ('pickup_latitude_not_null'), ('pickup_longitude_not_null'), ('base_not_null')) as r(rule)
       group by rule""",
)
ORACLE["dq_unique"] = _with(
    _RAW, "select trip_id, 2::bigint as copies from wire where base = 'purchase'"
)
ORACLE["dq_coordinates"] = _with(
    _RAW,
    """select trip_id, pickup_latitude, pickup_longitude from wire
       where pickup_latitude not between -90 and 90 or pickup_longitude not between -180 and 180""",
)
ORACLE["dq_hours"] = _with(
    _FACT, "select trip_id, pickup_hour + 5 as pickup_hour from rich where pickup_hour >= 19"
)
ORACLE["dq_dates"] = _with(
    _RAW,
    "select trip_id, utc::date as trip_date from typed where utc::date <> ts::date",
)
_CONTRACT_RULES = [
    "trip_id_not_null",
    "event_timestamp_not_null",
    "pickup_latitude_not_null",
    "pickup_longitude_not_null",
    "base_not_null",
    "trip_date_not_null",
    "pickup_hour_not_null",
    "day_of_week_not_null",
    "trip_id_at_most_32",
    "base_at_most_32",
    "longitude_in_range",
    "hour_in_range",
    "weekday_in_range",
]
ORACLE["dq_contract"] = _with(
    _RAW + ", sent as (select * from wire union all select * from wire where base = 'purchase')",
    "select 'latitude_in_range' as rule, count(*) filter (pickup_latitude > 90) as violations from sent\n"
    "union all select 'base_not_empty', count(*) filter (base = '') from sent\n"
    "union all select 'trip_id_unique', count(*) from wire where base = 'purchase'\n"
    + "\n".join(f"union all select '{rule}', 0" for rule in _CONTRACT_RULES),
)
ORACLE["dq_contract_rows"] = ORACLE["stream_enriched"]
_MODEL_RULES = {
    "staging_trips": "trip_id_not_null event_timestamp_not_null pickup_latitude_not_null "
    "pickup_longitude_not_null base_not_null coordinates_in_range trip_id_unique",
    "trip_fact": "trip_id_not_null pickup_hour_not_null hour_in_range date_of_timestamp trip_id_unique",
    "kpis": "total_trips_not_null",
}
ORACLE["dq_model_tests"] = _with(
    _FACT
    + ", dup as (select model, count(*) as violations from (select model, trip_id from fact,"
    " (values ('staging_trips'), ('trip_fact'), ('kpis')) as m(model) group by 1, 2"
    " having count(*) > 1) group by 1)",
    "select r.model, rule, coalesce(if(rule = 'trip_id_unique', violations, 0), 0)::bigint"
    " as violations from (values "
    + ", ".join(
        f"('{model}', '{rule}')" for model, rules in _MODEL_RULES.items() for rule in rules.split()
    )
    + ") as r(model, rule) left join dup using (model)",
)
ORACLE["dq_summary"] = _with(
    _RAW + ", sent as (select * from wire union all select * from wire where base = 'purchase')",
    """select count(*) as row_count, count(*) filter (pickup_latitude <= 90) as valid_coordinates,
         count(distinct trip_id) as unique_ids, count(*) - count(distinct trip_id) as duplicate_rows
       from sent""",
)
