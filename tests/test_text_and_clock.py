import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from curbline.functions import clock, text

NEW_YORK = ZoneInfo("America/New_York")


def test_strip_removes_what_python_strips(spark):
    values = ["  a ", "\t b c\r\n", " x　", "\x1c\x85y ", "", "   ", "z"]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in frame.select(text.strip(F.col("t"))).collect()]
    assert got == [v.strip() for v in values]


def _python_float(value):
    try:
        number = float(value)
    except ValueError:
        return None
    return number if abs(number) < 1e9 else None


def test_number_takes_what_python_takes(spark):
    values = [
        "40.769", "+40.7", "-0", "1e1", "1E-3", ".5", "5.", "00.5", "4_0.7_5", "1e1_0", "_4", "4_",
        "4__0", "4_.5", "1.5d", "1.5f", "0x10", "1,5", "", "-", "+-1", "1 2", "e5", "nan", "inf",
        "-Infinity", "abc", "1e", "--1", "1.2.3",
    ]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    got = {r[0]: r[1] for r in frame.select("t", text.number(F.col("t"))).collect()}
    for value in values:
        expected = _python_float(value)
        if value in ("nan", "1e1_0"):
            expected = None if value == "nan" else 1e10
        assert got[value] == expected, value


def test_shortest_float_text_is_pythons_repr(spark):
    random.seed(3)
    values = [f"{random.uniform(-180, 180):.{random.randint(0, 12)}f}" for _ in range(400)]
    values += [
        "40.7690", "40", "-0.0", "0", "-0", "0.0005", "0.00005", "-0.000012", "1e-5", "1.25e-7",
        "4.07e1", "+12.50", "007.10", "0.001", "100", "179.99999999999997", "-73.95490000000001",
        "4_0.7_0", "0.00012345678901234567",
    ]
    frame = spark.createDataFrame([(v, float(v)) for v in values], "t string, v double")
    got = frame.select("t", text.shortest_float_text(F.col("t"), F.col("v"))).collect()
    for source, shortest in got:
        assert shortest == str(float(source)), source


def _python_parse(value):
    try:
        return datetime.strptime(value, "%m/%d/%Y %H:%M:%S")
    except ValueError:
        return None


def test_parse_slash_date_time_is_strptime(spark, any_zone):
    values = [
        "4/1/2014 0:11:00", "04/01/2014 00:11:05", "4/1/2014 0:1:5", "4/1/2014   0:11:00",
        "12/31/2014 23:59:59", "2/29/2012 1:0:0", "3/9/2014 2:30:00", "11/2/2014 1:30:00",
        "13/1/2014 0:00:00", "0/1/2014 0:00:00", "2/29/2014 0:00:00", "4/1/14 0:00:00",
        "4/1/2014 24:00:00", "4/1/2014 0:60:00", "4/1/2014", "4/1/2014T0:00:00", "bad", "",
        "2014-04-01 00:00:00", "2014", "004/1/2014 0:00:00", "4/1/20145 0:00:00",
        "4/1/2014 0:11:00 PM", "4/1/0000 0:00:00", "12/30/2011 3:00:00", "=4/1/2014 0:11:00",
    ]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    parsed = frame.select("t", clock.parse_slash_date_time(F.col("t")).cast("string"))
    for value, got in parsed.collect():
        expected = _python_parse(value)
        assert got == (expected and expected.isoformat(" ")), value


def _wall_clock_times():
    edges = [
        datetime(2014, 3, 9, 1, 59, 59), datetime(2014, 3, 9, 2, 30), datetime(2014, 3, 9, 3, 0),
        datetime(2014, 11, 2, 0, 59, 59), datetime(2014, 11, 2, 1, 30), datetime(2014, 11, 2, 2, 0),
        datetime(2011, 12, 30, 12, 0), datetime(1950, 6, 1, 1, 30), datetime(2014, 4, 1, 0, 11, 5),
    ]
    random.seed(5)
    start = datetime(2013, 1, 1)
    return edges + [start + timedelta(seconds=random.randint(0, 94_608_000)) for _ in range(200)]


def test_zone_conversions_match_zoneinfo_in_any_session_zone(spark, any_zone):
    times = _wall_clock_times()
    frame = spark.createDataFrame([(t.isoformat(" "),) for t in times], "t string")
    instant = clock.local_to_instant(F.col("t").cast("timestamp_ntz"))
    got = frame.select(
        "t",
        clock.iso_utc(instant),
        F.unix_seconds(instant),
        clock.instant_to_local(instant).cast("string"),
    ).collect()
    for value, iso, seconds, back in got:
        moment = datetime.fromisoformat(value).replace(tzinfo=NEW_YORK)
        as_utc = moment.astimezone(timezone.utc)
        assert iso == as_utc.isoformat(), value
        assert seconds == as_utc.timestamp(), value
        assert back == as_utc.astimezone(NEW_YORK).replace(tzinfo=None).isoformat(" "), value


def test_micros_survive_the_way_to_an_instant(spark, any_zone):
    frame = spark.sql("select timestamp_ntz'2014-03-09 02:30:00.123456' as t")
    instant = clock.local_to_instant(F.col("t"), "UTC")
    assert frame.select(F.unix_micros(instant)).first()[0] == 1_394_332_200_123_456


def test_parse_instant(spark, any_zone):
    cases = {
        "2014-04-01T12:30:00+00:00": "2014-04-01T12:30:00+00:00",
        "2014-04-01T12:30:00Z": "2014-04-01T12:30:00+00:00",
        "2014-04-01 12:30:00-04:00": "2014-04-01T16:30:00+00:00",
        "2014-04-01T12:30:00": "2014-04-01T16:30:00+00:00",
        "2014-03-09T02:30:00Z": "2014-03-09T02:30:00+00:00",
        "2014-04-01": "2014-04-01T04:00:00+00:00",
        "12:30:00Z": None,
        "T12:30": None,
        "yesterday": None,
        "2014-13-01T00:00:00Z": None,
        "": None,
    }
    frame = spark.createDataFrame([(v,) for v in cases], "t string")
    instant = clock.parse_instant(F.col("t"))
    got = frame.select("t", clock.iso_utc(instant)).collect()
    assert {row[0]: row[1] for row in got} == cases


def test_calendar_parts(spark):
    frame = spark.sql("select explode(sequence(date'2014-03-31', date'2014-04-06')) as d")
    got = frame.select(
        clock.iso_weekday(F.col("d")), clock.day_name(F.col("d")), clock.is_weekend(F.col("d"))
    ).collect()
    names = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert [tuple(r) for r in got] == [(n, name, n > 5) for n, name in enumerate(names, 1)]


def test_day_parts_and_peak_hours(spark):
    frame = spark.range(24).select(F.col("id").cast("int").alias("h"))
    got = frame.select("h", clock.time_of_day(F.col("h")), clock.is_peak_hour(F.col("h"))).collect()
    parts = ["Night"] * 5 + ["Morning"] * 7 + ["Afternoon"] * 5 + ["Evening"] * 4 + ["Night"] * 3
    peak = {7, 8, 9, 10, 17, 18, 19, 20}
    assert [tuple(r) for r in got] == [(h, parts[h], h in peak) for h in range(24)]
