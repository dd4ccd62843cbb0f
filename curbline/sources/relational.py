"""The staging table of a relational database as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_staging_table(
    spark: SparkSession,
    jdbc_url: str,
    table: str,
    user: str,
    password: str,
    dates: list[str],
    driver: str = "org.postgresql.Driver",
) -> DataFrame:
    """The rows from ``dates[0]`` on, up to before ``dates[-1]``, one task per span between
    two of the dates; the table's index on ``trip_date`` serves each."""
    spans = [
        f"trip_date >= date '{first}' and trip_date < date '{last}'"
        for first, last in zip(dates, dates[1:])
    ]
    if not spans:
        raise ValueError("give at least two dates")
    options = {"user": user, "password": password, "driver": driver}
    return spark.read.jdbc(jdbc_url, table, predicates=spans, properties=options)
