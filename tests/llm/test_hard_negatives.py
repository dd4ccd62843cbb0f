import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def quantised(vector):
    values = [float(np.float32(x)) * 256 for x in vector]
    return [math.floor(x) for x in values]


def brute(rows, every=10, positives=5, negatives=5, floor=80, cap=100):
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if all(abs(float(np.float32(x)) * 256) < 1 << 26 for x in vector):
            kept.append((vec_id, label, tuple(quantised(vector))))
    first = {}
    for row in sorted(kept):
        first.setdefault(row[0], row)
    kept = list(first.values())

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2], strict=False))

    out = []
    for anchor in kept:
        if anchor[0] % every:
            continue
        others = sorted((-score(anchor, b), b[0], b[1]) for b in kept if b[0] != anchor[0])
        for high, positive, _ in [o for o in others if o[2] == anchor[1]][:positives]:
            window = [o for o in others if o[2] != anchor[1] and floor * -high <= cap * -o[0] <= cap * -high]
            for rank, (low, negative, _) in enumerate(window[:negatives], 1):
                out.append((anchor[0], positive, rank, negative, -high, -low))
    return sorted(out)


def run(spark, rows, every=10, **settings):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(row) for row in hard_negatives.mine(frame, F.col("vec_id") % every == 0, **settings).collect())


def cloud(n, dim=6, labels=3, seed=1, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.3, spread) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("slab_rows, page", [(16_384, 128), (40, 4), (7, 3)])
def test_equals_brute_force(spark, slab_rows, page):
    rows = cloud(300)
    assert run(spark, rows, slab_rows=slab_rows, page=page) == brute(rows)


def test_ties_copies_and_a_hot_vector(spark):
    rng = random.Random(5)
    small = [(i, [rng.randrange(3) / 256 * 16 for _ in range(3)], rng.randrange(3)) for i in range(200)]
    hot = [(1000 + i, [0.25, 0.25, 0.125], i % 2) for i in range(150)]
    rows = small + hot + hot[:40] + [(1000, [0.5, 0.5, 0.5], 1), (1000, [0.25, 0.25, 0.125], 2)]
    assert run(spark, rows, slab_rows=60, page=4) == brute(rows)


def test_values_that_take_no_part_and_uneven_lengths(spark):
    rows = cloud(60, dim=4)
    rows += [
        (None, [1.0, 1.0, 1.0, 1.0], 1),
        (100, None, 1),
        (110, [1.0, None, 1.0, 1.0], 1),
        (120, [1.0, float("nan"), 1.0, 1.0], 1),
        (130, [1.0, float("inf"), 1.0, 1.0], 1),
        (140, [1.0, 1e30, 1.0, 1.0], 1),
        (150, [1.0, 1.0, 1.0, 1.0], None),
        (160, [], 1),
        (161, [0.0, 0.0], 2),
        (170, [1.0, 1.0], 1),
        (180, [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 3.0], 2),
    ]
    assert run(spark, rows, slab_rows=30, page=4) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-200_000, 200_000) for _ in range(8)], i % 2) for i in range(80)]
    assert run(spark, rows, slab_rows=30, page=4) == brute(rows)


def test_tight_groups_let_boxes_be_dropped():
    """Boxes of far groups are never opened."""
    rng = np.random.default_rng(3)
    centres = np.eye(8) * 4
    points = np.floor(256 * (np.repeat(centres, 64, axis=0) + rng.normal(0, 0.05, (512, 8)))).astype(np.int64)
    tiles = list(hard_negatives.packed(points, np.arange(512), 32))
    assert sorted(np.concatenate(tiles).tolist()) == list(range(512))
    made = [
        {"slab": 0, "ids": tile, "labels": np.zeros(len(tile), int), "points": points[tile].ravel(),
         "lo": points[tile].min(0), "hi": points[tile].max(0), "label_lo": 0, "label_hi": 0,
         "least": int(tile.min()), "many": len(tile)}
        for tile in tiles
    ]
    import pyarrow as pa

    columns = {name: [page[name] for page in made] for name in hard_negatives.PAGE_SCHEMA.names}
    tree = hard_negatives.Tree(pa.table(columns, schema=hard_negatives.PAGE_SCHEMA), 8, points)
    anchor = points[5].astype(tree.kind)
    found = tree.search(anchor, 0, True, (-np.inf, np.inf), 5, None)
    scores = sorted(((int(s), -i) for i, s in enumerate(points @ points[5])), reverse=True)[:5]
    assert sorted(found, reverse=True) == scores
    assert len(tree.scores) <= len(tiles) // 2


def test_empty_tables_and_clashing_names(spark):
    assert run(spark, []) == []
    assert run(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == []
    rows = cloud(80)
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' as slab", "'x' as probe", "'x' as q", "'x' as score", "1 as rank", "'x' as cap", "'x' as block", "'x' as key"
    )
    got = hard_negatives.mine(wide, F.col("vec_id") % 10 == 0, slab_rows=30, page=4)
    assert sorted(tuple(row) for row in got.collect()) == brute(rows)
