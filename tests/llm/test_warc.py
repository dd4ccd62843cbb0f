import gzip
import hashlib
import io
import random

import pytest

from curbline.llm import warc
from curbline.session import work_dir

SCHEMA = "page_id long, url string, html string, path string, record_type int"


def expected(rows, small=100):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= small:
            first[data] = min(first.get(data, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        keep = first.get(data, page)
        kind = "response" if keep == page else "revisit"
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, keep if kind == "revisit" else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    big = ["é" * n for n in (49, 50, 51, 300)] + ["x\r\n\r\nWARC/1.1\r\n" * 30, "y" * 2_000_000]
    rows = [(n, f"http://h/{n}", draw.choice(big)) for n in range(200)]
    return rows + [(300, None, None), (301, "http://a\r\nX: y%0A", ""), (302, "u", "z" * 99), (303, "u", "z" * 99)]


def digest(headers):
    found = warc.with_originals(headers)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(map(tuple, found.select(*columns).collect()), key=repr)


def frame_of(spark, rows):
    return spark.createDataFrame([(*row, "p", 1) for row in rows], SCHEMA).repartition(3)


def test_round_trip_equals_brute_force(spark, rows):
    raw = warc.write_pages(frame_of(spark, rows), work_dir(spark, "t"))
    index = warc.deduplicate_archives(raw, work_dir(spark, "t"))
    headers = warc.read_headers(index)
    assert digest(headers) == expected(rows)
    urls = {r.page_id: r.url for r in headers.collect()}
    assert urls == {page: url for page, url, _ in rows}


def test_files_are_valid_and_revisits_have_no_payload(spark, rows):
    raw = warc.write_pages(frame_of(spark, rows), work_dir(spark, "t"))
    index = warc.deduplicate_archives(raw, work_dir(spark, "t"))
    html = {page: (text or "").encode() for page, _, text in rows}
    seen = 0
    for path in {r.path for r in index.select("path").distinct().collect()}:
        data = gzip.open(path.removeprefix("file:")).read()
        for head, fields, http, payload in warc.from_stream(io.BytesIO(data)):
            seen += 1
            assert http.startswith(b"HTTP/1.1 200 OK")
            assert payload == (b"" if head["record_type"] == "revisit" else html[head["page_id"]])
            assert ("warc-profile" in fields) == (head["record_type"] == "revisit")
    assert seen == len(rows)


def test_files_roll(spark, rows, monkeypatch):
    raw = warc.write_pages(frame_of(spark, rows * 3).coalesce(1), work_dir(spark, "t"))
    assert raw.select("path").distinct().count() > 1


def test_revisits_in_the_input_find_their_original(spark, rows):
    folder = work_dir(spark, "t")
    once = warc.deduplicate_archives(warc.write_pages(frame_of(spark, rows), folder), work_dir(spark, "t"))
    more = warc.write_pages(frame_of(spark, [(900, "u", "y" * 2_000_000)]), folder)
    again = warc.deduplicate_archives(once.unionByName(more), work_dir(spark, "t"))
    assert digest(warc.read_headers(again)) == expected([*rows, (900, "u", "y" * 2_000_000)])


def test_other_records_and_lost_originals_stay(spark, tmp_path):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    lost = (
        b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <b>\r\nWARC-Refers-To: <gone>\r\n"
        b"WARC-Payload-Digest: sha1:XYZ\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    )
    (tmp_path / "x.warc").write_bytes(info + lost)
    paths = spark.createDataFrame([(str(tmp_path / "x.warc"),)], "path string")
    index = warc.deduplicate_archives(paths, work_dir(spark, "t"))
    got = {r.record_id: (r.record_type, r.refers_to_record, r.payload_bytes) for r in warc.read_headers(index).collect()}
    assert got == {"a": ("warcinfo", None, 3), "b": ("revisit", "gone", None)}


def test_repeated_and_null_ids(spark):
    page = "p" * 200
    raw = warc.write_pages(frame_of(spark, [(5, "a", page), (5, "b", page), (None, "c", page)]), work_dir(spark, "t"))
    got = digest(warc.read_headers(warc.deduplicate_archives(raw, work_dir(spark, "t"))))
    assert [(r[0], r[3], r[4]) for r in got] == [(5, "response", None), (5, "revisit", 5), (None, "revisit", 5)]


def test_empty_table(spark):
    raw = warc.write_pages(spark.createDataFrame([], SCHEMA), work_dir(spark, "t"))
    assert digest(warc.read_headers(warc.deduplicate_archives(raw, work_dir(spark, "t")))) == []
