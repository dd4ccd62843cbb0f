"""Data-quality checks; a check holds when it finds no violation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import clock
from curbline.schema import LATITUDE_RANGE, LONGITUDE_RANGE, SOURCE_ZONE, STAGING_COLUMNS

# Columns that must hold a value, by model.
NOT_NULL = {
    "staging_trips": ("trip_id", "event_timestamp", "pickup_latitude", "pickup_longitude", "base"),
    "trip_fact": ("trip_id", "pickup_hour"),
    "kpis": ("total_trips",),
}
# The column that must hold no value twice, by model.
UNIQUE = {"staging_trips": "trip_id", "trip_fact": "trip_id"}


def bad_coordinates() -> Column:
    return ~F.col("pickup_latitude").between(*LATITUDE_RANGE) | ~F.col(
        "pickup_longitude"
    ).between(*LONGITUDE_RANGE)


def bad_hour() -> Column:
    return ~F.col("pickup_hour").between(0, 23)


def bad_date(zone: str = SOURCE_ZONE) -> Column:
    """The date is absent, or not the date of the timestamp on the clocks of ``zone``."""
    local = clock.instant_to_local(F.col("event_timestamp"), zone)
    return F.col("trip_date").isNull() | (F.to_date(local) != F.col("trip_date"))


def contract() -> dict[str, Column]:
    """Violation of each row rule of the staging table; its key rule is ``duplicates``."""
    rules = {f"{name}_not_null": F.col(name).isNull() for name in STAGING_COLUMNS}
    rules |= {
        "trip_id_at_most_32": F.length("trip_id") > 32,
        "base_at_most_32": F.length("base") > 32,
        "latitude_in_range": ~F.col("pickup_latitude").between(*LATITUDE_RANGE),
        "longitude_in_range": ~F.col("pickup_longitude").between(*LONGITUDE_RANGE),
        "base_not_empty": F.col("base") == "",
        "hour_in_range": bad_hour(),
        "weekday_in_range": ~F.col("day_of_week").between(1, 7),
    }
    return rules


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` held by more than one row, with the number of rows."""
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def count_violations(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) of all row rules, counted in one pass without a shuffle of rows."""
    counts = rows.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def count_all(rows: DataFrame, rules: Mapping[str, Column], key: str | None) -> DataFrame:
    """(rule, violations) of all row rules and, with a ``key``, of its uniqueness.

    One scan and one grouping by the key: each group carries its rows' violations along.
    """
    if key is None:
        return count_violations(rows, rules)
    per_key = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.count_if(broken).alias(rule) for rule, broken in rules.items()],
    )
    repeated = F.col(key).isNotNull() & (F.col("copies") > 1)
    totals = per_key.agg(
        *[F.coalesce(F.sum(rule), F.lit(0)).alias(rule) for rule in rules],
        F.count_if(repeated).alias(f"{key}_unique"),
    )
    return totals.unpivot([], [*rules, f"{key}_unique"], "rule", "violations")


def contract_report(staging: DataFrame) -> DataFrame:
    """Every rule of the staging table with its number of violations."""
    return count_all(staging, contract(), "trip_id")


def satisfies_contract(rows: DataFrame) -> DataFrame:
    """Rows that break no row rule of the staging table."""
    broken = F.lit(False)
    for violation in contract().values():
        broken = broken | F.coalesce(violation, F.lit(False))
    return rows.where(~broken)


def model_report(models: Mapping[str, DataFrame], zone: str = SOURCE_ZONE) -> DataFrame:
    """(model, rule, violations) of all data tests on the given models, one scan for each."""
    reports = []
    for model, rows in models.items():
        rules = {f"{name}_not_null": F.col(name).isNull() for name in NOT_NULL.get(model, ())}
        if model == "staging_trips":
            rules["coordinates_in_range"] = bad_coordinates()
        if model == "trip_fact":
            rules |= {"hour_in_range": bad_hour(), "date_of_timestamp": bad_date(zone)}
        if rules:
            report = count_all(rows, rules, UNIQUE.get(model))
            reports.append(report.withColumn("model", F.lit(model)))
    if not reports:
        raise ValueError("no known model given")
    return reduce(DataFrame.unionByName, reports).select("model", "rule", "violations")


def quality_summary(rows: DataFrame) -> DataFrame:
    """Row count, rows with valid coordinates, distinct ids, surplus rows of repeated ids."""
    valid = F.coalesce(~bad_coordinates(), F.lit(False))
    per_id = rows.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(valid).alias("valid")
    )
    return per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("valid_coordinates"),
        F.count("trip_id").alias("unique_ids"),
        F.coalesce(F.sum(F.when(F.col("trip_id").isNotNull(), F.col("copies") - 1)), F.lit(0)).alias(
            "duplicate_rows"
        ),
    )
