import random
import re

import pytest

from curbline.llm import mixing

SCHEMA = "doc_id long, text string, source string, row string, size int, mix int, target string"


def refilled(sizes, weights=(5, 2, 1)):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % 3] for n, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 3 * sizes[s] + 1e-9}
        if not over:
            target |= {s: share * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(5)
    rows = []
    for n in range(3000):
        source = draw.choice(["src0"] * 9 + ["a", "é", "Z", None, "tiny", "tiny2"] * 2)
        if source in ("tiny", "tiny2") and draw.random() < 0.9:
            source = "src0"
        words = draw.choice([0, 1, 5, 5, 40, draw.randrange(300)])
        rows.append((n, None if n % 97 == 0 else "w \t" * words, source, "r", 1, 2, None))
    rows += [(9000, "the same words", "a", "r", 1, 2, None)] * 40
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_are_those_of_resharing(docs):
    out = mixing.with_copies(docs).select("row.source", "mix.*").distinct().collect()
    sizes = {r.source: r.source_size for r in out}
    wanted = refilled(sizes)
    assert all(r.target == pytest.approx(wanted[r.source]) for r in out)
    assert sum(wanted.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_come_near_the_target(docs):
    rows = mixing.with_copies(docs).select("row.*", mixing.F.col("mix").alias("drawn")).collect()
    assert len(rows) == 3040
    taken, longest = {}, {}
    for r in rows:
        assert r.drawn.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert 0 <= r.drawn.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.drawn.copies * r.drawn.size
        longest[r.source] = max(longest.get(r.source, 0), r.drawn.size)
    for r in rows:
        assert abs(taken[r.source] - r.drawn.target) <= 2 * longest[r.source]


def test_one_emission_per_boundary_and_reruns_agree(docs):
    emitted = mixing.mix_sources(docs)
    assert emitted.columns == docs.columns
    first = sorted((r.doc_id, r.source or "") for r in emitted.collect())
    again = sorted((r.doc_id, r.source or "") for r in mixing.mix_sources(docs.repartition(7)).collect())
    assert first == again
    copies = sum(r.copies for r in mixing.with_copies(docs).select("mix.copies").collect())
    assert copies == len(first)


def test_positions_cross_slices_without_a_gap(spark):
    frame = spark.createDataFrame([(n, "a b", "s") for n in range(500)], "doc_id long, text string, source string")
    rows = mixing.with_copies(frame).collect()
    assert sum(r.mix.copies for r in rows) == 500
    assert {r.mix.copies for r in rows} == {1}


def test_empty_table_and_only_empty_texts(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix_sources(spark.createDataFrame([], schema)).collect() == []
    rows = mixing.with_copies(spark.createDataFrame([(1, None, "a"), (None, "", None)], schema)).collect()
    assert [(r.mix.size, r.mix.target, r.mix.copies) for r in rows] == [(0, 0.0, 0)] * 2
