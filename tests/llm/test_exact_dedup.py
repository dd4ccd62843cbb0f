import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import exact_dedup as dedup

SCHEMA = "doc_id long, text string, group string, text_hash int, kept string"


def slow(data, point, prime):
    out = 0
    for byte in data:
        out = (out * point + byte) % prime
    return out


def expected(rows):
    texts = {}
    for row in rows:
        texts.setdefault(row[1] or "", []).append(row[0])
    keeps = {text: max((i for i in ids if i is not None), default=None) for text, ids in texts.items()}
    return sorted(
        (
            (i, keeps[t or ""], len(texts[t or ""]), i == keeps[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
            for i, t, *_ in rows
        ),
        key=repr,
    )


def marked(frame):
    return sorted(
        map(tuple, frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr
    )


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    long = "".join(draw.choice("aé\n🙂 ") for _ in range(150_000))
    texts = [None, "", "a", "a", "A", "a ", "é", "é", "\x00a", "x" * 70_000, "x" * 70_000, "x" * 69_999 + "y"]
    texts += [long, long, long[:-1] + "!", "a"]
    return [(n, t, "g", n, "k") for n, t in enumerate(texts)]


def test_fingerprint_is_the_polynomial_of_the_bytes(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = docs.select("doc_id", dedup.fingerprint(F.col("text")).alias("fp")).collect()
    for row in got:
        data = (rows[row.doc_id][1] or "").encode()
        assert tuple(row.fp) == tuple(slow(data, p, dedup.PRIME) for p in dedup.POINTS)


def test_fingerprints_combine():
    point = dedup.POINTS[0]
    left, right = b"some bytes", b" and more\x00"
    both = dedup.combine(slow(left, point, dedup.PRIME), slow(right, point, dedup.PRIME), len(right), point)
    assert both == slow(left + right, point, dedup.PRIME)


def test_parts_in_parallel_give_the_whole(spark):
    data = np.random.default_rng(1).integers(0, 256, 40_000, np.uint8).tobytes()
    cuts = [0, 1, 5000, 5000, 23_456, 40_000]
    parts = [(7, n, data[a:b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))] + [(8, 0, None), (8, 1, b"z")]
    frame = spark.createDataFrame(parts, "doc_id long, part int, bytes binary").repartition(4)
    got = {r.doc_id: (r.fp_a, r.fp_b, r.n_bytes) for r in dedup.join_parts(frame).collect()}
    assert got[7] == (*(slow(data, p, dedup.PRIME) for p in dedup.POINTS), len(data))
    assert got[8] == (ord("z"), ord("z"), 1)


def test_marks_equal_brute_force(spark, rows):
    assert marked(dedup.mark_duplicates(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_colliding_fingerprints_are_told_apart(spark):
    rows = [(n, f"{n % 13:04d}", "g", n, "k") for n in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert marked(dedup.mark_duplicates(docs, points=(3, 5), prime=7)) == expected(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a", None, 1, None), (1, "a", "g", 2, None), (1, "b", "g", 3, None), (None, "c", "g", 4, None)]
    rows += [(None, "b", "g", 5, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert marked(dedup.mark_duplicates(docs)) == expected(rows)
    kept = dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "c"), (1, "a"), (1, "b")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert dedup.mark_duplicates(docs).collect() == []
    assert dedup.deduplicate(docs).collect() == []
