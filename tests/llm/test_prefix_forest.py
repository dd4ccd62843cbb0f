import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import prefix_forest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every=10, wanted=5):
    kept = {}
    for vec_id, vector in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=repr):
        if any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        own = tuple(float(np.float32(x)) for x in vector)
        kept[vec_id] = min(own, kept.get(vec_id, own))
    out = {}
    for query in kept:
        if query % every:
            continue
        scores = []
        for other, vector in kept.items():
            if other != query:
                dot = sum(x * y for x, y in zip(kept[query], vector, strict=False))
                norm = math.sqrt(sum(x * x for x in vector)) * math.sqrt(sum(x * x for x in kept[query]))
                scores.append((-round(dot / norm, 12), other))
        out[query] = [(other, -score) for score, other in sorted(scores)[:wanted]]
    return {query: near for query, near in out.items() if near}


def run(spark, rows, every=10, **settings):
    frame = spark.createDataFrame(rows, SCHEMA)
    out = {}
    for row in prefix_forest.nearest(frame, F.col("vec_id") % every == 0, **settings).orderBy("query_id", "rank").collect():
        near = out.setdefault(row["query_id"], [])
        near.append((row["vec_id"], round(row["score"], 12)))
        assert row["rank"] == len(near)
    return out


def cloud(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.standard_normal(dim).tolist()) for i in range(n)]


@pytest.mark.parametrize("array_rows", [4096, 32, 4])
def test_full_recall_on_all_queries_is_brute_force(spark, array_rows):
    """All queries are audited here, so the stop that finds all of their nearest gives exactly those."""
    rows = cloud(400)
    assert run(spark, rows, recall=1.0, trees=12, array_rows=array_rows) == brute(rows)


def test_recall_is_reached_with_fewer_candidates(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 24))
    rows = [(i, (centres[i % 40] + 0.3 * rng.standard_normal(24)).tolist()) for i in range(2000)]
    wanted = brute(rows, every=20)
    got = run(spark, rows, every=20, trees=16, array_rows=64)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    scores = {(q, v): s for q, near in brute(rows, every=20, wanted=2000).items() for v, s in near}
    assert all(scores[q, v] == s for q, near in got.items() for v, s in near)


def test_hot_copies_and_near_copies_split_arrays(spark):
    rng = random.Random(2)
    rows = cloud(150, dim=8)
    rows += [(1000 + i, [1.0, 2.0, 0.5, 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(90)]
    rows += [(2000 + i, [1.0 + rng.random() / 1e4, 2.0, 0.5, 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(90)]
    rows += rows[150:200]
    got, wanted = run(spark, rows, recall=1.0, trees=8, array_rows=8), brute(rows)
    assert {q: [v for v, _ in near] for q, near in got.items() if 1000 <= q < 2000} == {
        q: [v for v, _ in near] for q, near in wanted.items() if 1000 <= q < 2000
    }
    assert got.keys() == wanted.keys()
    # Near copies differ by less than the rounding here, so their scores are compared and not their ids.
    for query, near in wanted.items():
        assert [score for _, score in got[query]] == pytest.approx([score for _, score in near], abs=1e-11)


def test_values_that_take_no_part_and_uneven_lengths(spark):
    rows = cloud(40, dim=4)
    rows += [
        (None, [1.0, 1.0, 1.0, 1.0]),
        (100, None),
        (110, []),
        (120, [0.0, 0.0, -0.0]),
        (130, [1.0, None]),
        (140, [1.0, float("nan")]),
        (150, [1.0, float("-inf")]),
        (160, [1.0, 2.0]),
        (170, [1.0, 1.0, 1.0, 1.0, 5.0]),
        (180, [3e38, 3e38, 1e38, 0.0]),
        (190, [1e-38, 1e-38, 0.0, 0.0]),
        (20, [1.0, 2.0, 3.0, 4.0]),
    ]
    assert run(spark, rows, recall=1.0, trees=6, array_rows=8) == brute(rows)


def test_few_rows_and_none(spark):
    assert run(spark, []) == {}
    assert run(spark, [(10, [1.0, 0.0])]) == {}
    assert run(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0])]) == {}
    rows = [(10, [1.0, 0.0]), (11, [1.0, 0.0]), (20, [-1.0, 0.5])]
    assert run(spark, rows) == brute(rows)


def test_shared_bits_and_ranges():
    strings = np.sort(np.array([0, 1, 2, 3, 1 << 63, (1 << 63) + 5, (1 << 64) - 1], np.uint64))
    own = np.array([(1 << 63) + 4], np.uint64)
    bits = prefix_forest.common_bits(strings, own[0])
    for level in range(65):
        first, end = prefix_forest.range_at(strings, own, np.array([level]))
        assert end[0] - first[0] == (bits >= level).sum()


def test_further_columns_do_not_clash(spark):
    rows = cloud(60, dim=4)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' as tree", "'x' as hash", "'x' as block", "'x' as node", "'x' as vector", "'x' as rank", "'x' as key"
    )
    got = prefix_forest.nearest(frame, F.col("vec_id") % 10 == 0, recall=1.0, trees=6)
    assert {(r["query_id"], r["vec_id"]) for r in got.collect()} == {(q, v) for q, near in brute(rows).items() for v, _ in near}
