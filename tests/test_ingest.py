import hashlib
import json
import random

import pytest
from helpers import VALID, raw, rows_of
from pyspark.sql import functions as F

from curbline.functions.identity import trip_id
from curbline.operators.canonical import canonical_events, rejected_rows
from curbline.schema import EVENT_COLUMNS, ID_PREFIX, RAW_COLUMNS
from curbline.session import work_dir
from curbline.sources import quoted_csv
from curbline.sources.json_lines import read_json_lines, write_json_lines
from curbline.sources.messages import message_payload
from curbline.sources.quoted_csv import read_records
from curbline.sources.raw_csv import read_raw_csv, scan_csv


def test_golden_id(spark):
    columns = [F.lit(v) for v in ("4/1/2014 0:11:00", "40.769", "-73.9549", "B02512")]
    got = spark.range(1).select(trip_id(F.lit(1), *columns)).first()[0]
    assert got == f"{ID_PREFIX}3d7b142f0c24e77ba450"


def test_canonical_event(spark, any_zone):
    event = canonical_events(raw(spark, VALID)).first()
    assert tuple(event.asDict()) == EVENT_COLUMNS
    digest = hashlib.sha256(b"1|4/1/2014 00:11:05|40.769|-73.954|B02512").hexdigest()
    assert tuple(event) == (
        ID_PREFIX + digest[:20], "2014-04-01T04:11:05+00:00", 40.769, -73.954, "B02512",
    )
    assert event == canonical_events(raw(spark, VALID)).first()


def test_clock_changes(spark):
    rows = raw(spark, *[(t, *VALID[1:]) for t in ("3/9/2014 2:30:00", "11/2/2014 1:30:00")])
    got = [r.event_timestamp for r in canonical_events(rows, keep_row_number=True).sort("row_number").collect()]
    assert got == ["2014-03-09T07:30:00+00:00", "2014-11-02T05:30:00+00:00"]


def test_blanks_are_trimmed_before_the_id(spark):
    padded = tuple(f" {value}\t" for value in VALID)
    plain = rows_of(canonical_events(raw(spark, VALID)))
    assert rows_of(canonical_events(raw(spark, padded))) == plain


def test_numeric_id_ignores_the_spelling_of_numbers(spark):
    spelled = (VALID[0], "40.7690", "-073.954", VALID[3])
    numeric = [
        canonical_events(raw(spark, row), numeric_id=True).first().trip_id for row in (VALID, spelled)
    ]
    as_text = [canonical_events(raw(spark, row)).first().trip_id for row in (VALID, spelled)]
    assert numeric[0] == numeric[1] == as_text[0] != as_text[1]


def test_rejected_rows_have_number_and_reason(spark):
    date, lat, lon, base = VALID
    rows = raw(
        spark,
        VALID,
        (date, "91", lon, base),
        (date, lat, "181", base),
        (date, lat, lon, ""),
        (date, lat, lon, "  "),
        ("bad", lat, lon, base),
        (date, "NaN", lon, base),
        (date, lat, "inf", base),
        (date, None, lon, base),
        ("bad", "not-a-number", "0", "BAD"),
        (date, "-90", "180", base),
    )
    assert rows_of(rejected_rows(rows)) == sorted(
        [
            (2, "latitude_out_of_range"),
            (3, "longitude_out_of_range"),
            (4, "empty_base"),
            (5, "empty_base"),
            (6, "bad_timestamp"),
            (7, "bad_latitude"),
            (8, "bad_longitude"),
            (9, "missing_field"),
            (10, "bad_latitude"),
        ],
        key=repr,
    )
    assert [r[0] for r in rows_of(canonical_events(rows, keep_row_number=True))] == [1, 11]


def test_messages_carry_all_five_fields(spark):
    key, value = message_payload(canonical_events(raw(spark, VALID))).first()
    event = json.loads(value)
    assert event["trip_id"] == key and tuple(event) == EVENT_COLUMNS


def _numbered(spark, path, **options):
    return read_raw_csv(spark, str(path), work_dir(spark, "csv"), **options)


def test_csv_rows_are_numbered_with_bad_ones(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text(
        "Date/Time,Lat,Lon,Base\n4/1/2014 00:11:05,40.769,-73.954,B02512\n"
        "bad,not-a-number,0,BAD\n\n4/1/2014 0:12:00,1\n"
        '"4/1/2014 0:13:00",41,-74,"B,""x"""\n4/1/2014 0:14:00,41,-74,B1,more\n',
        encoding="utf-8",
    )
    rows = _numbered(spark, path)
    events = canonical_events(rows, keep_row_number=True).sort("row_number").collect()
    assert [(e.row_number, e.base) for e in events] == [(1, "B02512"), (4, 'B,"x"'), (5, "B1")]
    assert rows_of(rejected_rows(rows)) == [(2, "bad_latitude"), (3, "missing_field")]


def test_csv_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text("Base,Extra,Lon,Lat,Date/Time\nB1,x,-73.954,40.769,4/1/2014 0:11:05\n")
    assert tuple(_numbered(spark, path).first())[1:] == ("4/1/2014 0:11:05", "40.769", "-73.954", "B1")


def test_csv_without_a_column_rejects_every_row(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text("Date/Time,Lat,Lon\n4/1/2014 0:11:05,40.769,-73.954\n")
    assert rows_of(rejected_rows(_numbered(spark, path))) == [(1, "missing_field")]


def test_csv_files_must_share_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date/Time,Lat,Lon,Base\n1,2,3,4\n")
    (tmp_path / "b.csv").write_text("Lat,Date/Time,Lon,Base\n1,2,3,4\n")
    with pytest.raises(Exception, match="header"):
        scan_csv(spark, str(tmp_path), RAW_COLUMNS).collect()


def test_csv_numbers_follow_files_and_blocks(spark, tmp_path):
    """Files cut into many blocks, packed into tasks by size and not by place."""
    sizes = {"a.csv": 40, "b.csv": 3000, "c.csv": 1, "d.csv": 900}
    expected = []
    for name, size in sizes.items():
        bases = [f"{name}-{n}" for n in range(size)]
        body = "".join(f"4/1/2014 0:11:05,40.769,-73.954,{base}\n" for base in bases)
        (tmp_path / name).write_text("Date/Time,Lat,Lon,Base\n" + body)
        expected += bases
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "8192")
    try:
        rows = _numbered(spark, tmp_path).collect()
    finally:
        spark.conf.set(key, before)
    assert {r.row_number: r.Base for r in rows} == dict(enumerate(expected, 1))
    assert len(rows) == len(expected)


def test_quoted_line_breaks_are_part_of_their_field(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text('Date/Time,Lat,Lon,Base\n4/1/2014 0:11:05,40.769,-73.954,"B\n1"\n' + ",".join(VALID) + "\n")
    rows = _numbered(spark, path).collect()
    assert sorted((r.row_number, r.Base) for r in rows) == [(1, "B\n1"), (2, "B02512")]


def _blocks_of(spark, monkeypatch, size):
    """Source files are cut into byte ranges of this size."""
    land = quoted_csv.land_lines
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"}

    def landed(*args):
        before = {key: spark.conf.get(key) for key in settings}
        for key, value in settings.items():
            spark.conf.set(key, str(value))
        try:
            land(*args)
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)

    monkeypatch.setattr(quoted_csv, "land_lines", landed)


def _field(draw):
    """A field, quoted where it must be or by chance; inch marks inside plain fields are text."""
    text = "".join(draw.choice(['a', 'b', ' ', ',', '"', '\n', 'xyz']) for _ in range(draw.choice((1, 2, 5, 40))))
    if draw.random() < 0.5:
        return '"' + text.replace('"', '""') + '"'
    return "p" + text.replace(",", "").replace("\n", "")


@pytest.mark.parametrize("size", [61, 500, 1 << 20])
def test_csv_ranges_read_as_one_task_does(spark, tmp_path, monkeypatch, size):
    """Quotes, doubled and stray ones, and line breaks across byte ranges: the same rows in the same order."""
    draw = random.Random(size)
    for name in "abc":
        lines = ["Date/Time,Lat,Lon,Base"]
        lines += [",".join(_field(draw) for _ in range(draw.choice((3, 4, 4, 5)))) for _ in range(30)]
        if name == "b":
            lines.insert(7, "")
        (tmp_path / f"{name}.csv").write_bytes("\n".join(lines).encode() + b"\n" * (name != "c"))
    once = scan_csv(spark, str(tmp_path), RAW_COLUMNS)
    order = once.withColumn("seq", F.monotonically_increasing_id()).sort("src_file", "seq").collect()
    _blocks_of(spark, monkeypatch, size)
    rows = _numbered(spark, tmp_path).sort("row_number").collect()
    assert [tuple(r) for r in rows] == [(n, *tuple(r)[:4]) for n, r in enumerate(order, 1)]
    assert len(rows) == 90


def test_one_csv_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    path = tmp_path / "trips.csv"
    path.write_text("Date/Time,Lat,Lon,Base\n" + '4/1/2014 0:11:05,40.769,-73.954,"B\n1"\n' * 2000)
    folder = work_dir(spark, "csv")
    _blocks_of(spark, monkeypatch, 8192)
    rows = read_raw_csv(spark, str(path), folder)
    assert spark.read.parquet(f"{folder}/lines").select("src_block").distinct().count() > 4
    assert rows.agg(F.count_distinct("row_number"), F.max("row_number"), F.count_if(F.col("Base") == "B\n1")).first() == (2000,) * 3


def test_windows_line_ends_and_empty_files(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_bytes(b'Date/Time,Lat,Lon,Base\r\nx,1,2,"B\r\n1"\r\n\r\ny,1,2,"B2"\r\n')
    (tmp_path / "b.csv").write_bytes(b"")
    (tmp_path / "c.csv").write_bytes(b"Date/Time,Lat,Lon,Base\r\n")
    (tmp_path / "d.csv").write_bytes(b"Date/Time,Lat,Lon,Base\r\nz,,2,B3")
    _blocks_of(spark, monkeypatch, 9)
    rows = _numbered(spark, tmp_path).sort("row_number").collect()
    assert [tuple(r) for r in rows] == [
        (1, "x", "1", "2", "B\n1"), (2, "y", "1", "2", "B2"), (3, "z", None, "2", "B3"),
    ]


def test_a_quote_left_open_is_an_error(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text('Date/Time,Lat,Lon,Base\n1,2,3,"B\n' + "1,2,3,4\n" * 50)
    with pytest.raises(ValueError, match="record 2 has over 99 bytes"):
        read_records(spark, str(path), work_dir(spark, "csv"), longest=99)


def test_another_header_fails_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date/Time,Lat,Lon,Base\n1,2,3,4\n")
    (tmp_path / "b.csv").write_text("Lat,Date/Time,Lon,Base\n1,2,3,4\n")
    with pytest.raises(Exception, match="header"):
        _numbered(spark, tmp_path)


def test_json_lines_keep_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    event = spark.createDataFrame(
        [("a", None, 40.5, -73.0, "B1")],
        "trip_id string, event_timestamp string, pickup_latitude double, pickup_longitude double, base string",
    )
    write_json_lines(event, path)
    line = spark.read.text(path).first()[0]
    assert json.loads(line) == {
        "trip_id": "a", "event_timestamp": None, "pickup_latitude": 40.5,
        "pickup_longitude": -73.0, "base": "B1",
    }
    assert rows_of(read_json_lines(spark, path)) == rows_of(event)
