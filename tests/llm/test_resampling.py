import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curbline.llm import resampling

SCHEMA = "doc_id long, text string"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def grams_of(text, longest, buckets):
    words = words_of(text)
    runs = (" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
    return [zlib.crc32(run.encode()) % buckets for run in runs]


def brute(docs, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    here = Counter(g for _, text in docs for g in grams_of(text, longest, buckets))
    there = Counter(g for text in target for g in grams_of(text, longest, buckets))
    s_all, t_all = sum(here.values()), sum(there.values())

    def gain(bucket):
        up = (there[bucket] + 1.0) * (s_all + buckets)
        return math.floor(1000 * math.log(up / ((here[bucket] + 1.0) * (t_all + buckets))))

    rows = []
    for doc_id, text in docs:
        grams = grams_of(text, longest, buckets)
        weight = sum(gain(g) for g in grams)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(words_of(text)), len(grams), weight, score))
    able = [row for row in rows if row[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = able[: percent * len(able) // 100]
    ranked = [(d, n, w, s, place) for place, (d, _, n, w, s) in enumerate(drawn, 1)]
    rest = [(d, n, w, s, None) for d, _, n, w, s in able[len(drawn) :] + [r for r in rows if r[1] < least]]
    return sorted(ranked + rest, key=repr)


def run(spark, docs, target, **settings_):
    frame = resampling.resample(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(t,) for t in target], "text string"), **settings_
    )
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBz9 -_\n\tßé語\U0001f600", max_size=60), st.integers(1, 4))
def test_crcs_of_runs_equal_those_of_their_text(text, longest):
    words = words_of(text)
    wanted = [
        zlib.crc32(" ".join(words[i : i + n]).encode()) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]
    crcs, many = resampling.run_crcs(text, longest)
    assert crcs.tolist() == wanted
    assert many == len(words)


def test_words_longer_than_the_short_tables():
    text = "a" * 63 + " " + "b" * 64 + " " + "c" * 70_001 + " ü" * 3
    crcs, _ = resampling.run_crcs(text, 2)
    words = text.split()
    assert crcs.tolist() == [zlib.crc32(w.encode()) for w in words] + [
        zlib.crc32(f"{a} {b}".encode()) for a, b in zip(words, words[1:])
    ]


DOCS = [
    (1, "the Cat sat on the mat " * 5),
    (2, "the Cat sat on the mat " * 5),
    (2, "the Cat sat on the mat " * 5),
    (3, None),
    (4, ""),
    (5, "-- !! \n"),
    (6, "one two"),
    (None, "null id words " * 10),
    (None, "null id words " * 10),
    (7, "näive ÄÖ 漢字 " * 2_000),
    (8, "long-word" * 3_000 + " x" * 25),
    *[(n, f"word{n % 3} other{n} and the rest of it " * 4) for n in range(10, 60)],
]
TARGET = ["the cat and the rest", None, "", "word1 word1 漢字"]


@pytest.mark.parametrize("longest", [1, 3])
@pytest.mark.parametrize("percent", [10, 50, 100])
def test_draw_equals_brute_force(spark, longest, percent):
    got = run(spark, DOCS, TARGET, longest=longest, percent=percent, buckets=97)
    assert got == brute(DOCS, TARGET, longest=longest, percent=percent, buckets=97)


def test_one_hot_document_text_and_ties_of_scores(spark):
    docs = [(n, "same words here " * 8) for n in range(300)] + [(7, "same words here " * 8)] * 5
    got = run(spark, docs, TARGET, percent=40)
    assert got == brute(docs, TARGET, percent=40)
    ranks = sorted(row[4] for row in got if row[4])
    assert ranks == list(range(1, 305 * 40 // 100 + 1))


def test_empty_tables(spark):
    assert run(spark, [], TARGET) == []
    assert run(spark, DOCS[:7], []) == brute(DOCS[:7], [])


def test_further_columns_do_not_clash(spark):
    names = ("grams", "bucket", "n", "part", "place", "row_id", "at", "eligible", "n_words")
    docs = spark.createDataFrame(DOCS, SCHEMA)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    wide = docs.selectExpr("*", *[f"'x' as {name}" for name in names])
    got = resampling.resample(wide, target.selectExpr("*", "'y' as doc_id"))
    assert sorted((tuple(row) for row in got.collect()), key=repr) == brute(DOCS, TARGET)
