import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from curbline.schema import RAW_SCHEMA

VALID = ("4/1/2014 00:11:05", "40.769", "-73.954", "B02512")


def raw(spark, *rows):
    """Raw rows numbered from 1."""
    return spark.createDataFrame([(n, *row) for n, row in enumerate(rows, 1)], RAW_SCHEMA)


def staging_source(spark, rows):
    """(id, local time text, latitude, longitude, base) rows as typed trips."""
    from curbline.functions import clock

    frame = spark.createDataFrame(
        rows, "trip_id string, local string, pickup_latitude double, pickup_longitude double, base string"
    )
    return frame.select(
        "trip_id",
        clock.local_to_instant(F.col("local").cast("timestamp_ntz")).alias("event_timestamp"),
        "pickup_latitude",
        "pickup_longitude",
        "base",
    )


def rows_of(frame, *columns):
    """Rows as a sorted list of tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scan_details_of(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()
