import math
import random

import numpy as np
import pytest

from curbline.llm import nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, node int"


def valid(vector):
    return (
        vector is not None
        and len(vector) > 0
        and all(x is not None and math.isfinite(x) for x in vector)
        and any(x != 0 for x in vector)
    )


def expected(rows, least=0.93):
    links = [0] * len(rows)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i], rows[j]
            if a[2] is None or a[2] != b[2] or not valid(a[1]) or not valid(b[1]) or len(a[1]) != len(b[1]):
                continue
            x, y = (np.array(v, np.float32).astype(float) for v in (a[1], b[1]))
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                links[j] += 1
                group = [group[i] if g == group[j] else g for g in group]
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        first = min(ids, default=None)
        out.append((row[0], links[i], first, row[0] == first))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*row, "u", 1) for row in rows], SCHEMA)
    return sorted((tuple(r) for r in nn_descent.link_vectors(frame).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(6)
    rows = []
    for label in (0, 1, None):
        for _ in range(60):
            base = draw.standard_normal(24)
            rows.append((len(rows), base, label))
            for _ in range(draw.integers(0, 3)):
                rows.append((len(rows), base + draw.standard_normal(24) * draw.choice([0.05, 0.2, 0.3]), label))
    tight, loose = draw.standard_normal((2, 24))
    rows += [(len(rows) + n, tight + draw.standard_normal(24) * 0.08, 0) for n in range(40)]
    rows += [(len(rows) + n, loose + draw.standard_normal(24) * 0.26, 1) for n in range(60)]
    return [(n, [float(x) for x in v], label) for n, v, label in rows]


def test_links_equal_brute_force(spark, rows):
    assert found(spark, rows) == expected(rows)


def test_small_tiles_and_leaves_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(nn_descent, "TILE", 16)
    monkeypatch.setattr(nn_descent, "HOT_LEAF", 30)
    monkeypatch.setattr(nn_descent, "BLOCK", 24)
    assert found(spark, rows) == expected(rows)


def test_bad_vectors_repeats_and_lengths(spark):
    v = [1.0, 2.0, 3.0]
    bad = [None, [], [0.0, 0.0, 0.0], [1.0, None, 3.0], [1.0, float("nan"), 3.0], [float("inf"), 2.0, 3.0]]
    rows = [(n, b, 1) for n, b in enumerate(bad)]
    rows += [(10, v, 1), (10, v, 1), (11, [2.0, 4.0, 6.0], 1), (12, v, 2), (13, v, None), (None, v, 1), (None, v, 2)]
    rows += [(14, [1.0, 2.0, 3.0, 0.0], 1), (15, [-1.0, -2.0, -3.0], 1), (16, [1e-38, 2e-38, 3e-38], 1)]
    assert found(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_hot_group_of_equal_vectors(spark):
    draw = random.Random(1)
    rows = [(n, [1.0, 0.0, 0.0] if n % 3 else [draw.random(), draw.random(), draw.random()], 0) for n in range(300)]
    assert found(spark, rows) == expected(rows)


def around(draw, centre, cosine):
    """A vector of length 1 at this cosine to a centre of length 1."""
    side = draw.standard_normal(len(centre))
    side -= (side @ centre) * centre
    return cosine * centre + math.sqrt(1 - cosine * cosine) * side / np.linalg.norm(side)


def two_groups(draw, first, label, dim=64):
    """Two groups with some 0.97 inside and 0.945 across: nearer neighbours fill all lists."""
    middle = draw.standard_normal(dim)
    middle /= np.linalg.norm(middle)
    centres = [around(draw, middle, math.sqrt(0.987)), None]
    centres[1] = 2 * (centres[0] @ middle) * middle - centres[0]
    vectors = [around(draw, centre, math.sqrt(0.97)) for centre in centres for _ in range(40)]
    return [(first + n, [float(x) for x in v], label) for n, v in enumerate(vectors)]


def test_links_between_saturated_groups(spark):
    draw = np.random.default_rng(3)
    rows = two_groups(draw, 0, 0) + two_groups(draw, 100, 1) + two_groups(draw, 200, 1)
    rows += [(300 + n, [float(x) for x in draw.standard_normal(64)], n % 2) for n in range(40)]
    wanted = expected(rows)
    assert len({w[2] for w in wanted if w[0] < 80}) == 1
    assert found(spark, rows) == wanted


def test_recall_counts_each_node_alike(spark):
    """A hot group whose links are all found does not hide that no pair is."""
    draw = np.random.default_rng(4)
    hot = draw.standard_normal(16)
    rows = [(n, hot + draw.standard_normal(16) * 0.02, 0) for n in range(100)]
    for label in (0, 1):
        for _ in range(12):
            one = draw.standard_normal(16)
            rows += [(len(rows), one, label), (len(rows) + 1, one + draw.standard_normal(16) * 0.05, label)]
    units = [(n, label, 16, 1, [float(x) for x in v / np.linalg.norm(v)]) for n, v, label in rows]
    nodes = spark.createDataFrame(units, "node long, label int, dim int, m long, unit array<double>")
    got = spark.createDataFrame([(n, 99) for n in range(100)] + [(n, 1) for n in range(124, 148)], "node long, links long")
    queries = nn_descent.audited(nodes)
    lists = queries.selectExpr("-1 - node as a", "node as b", "cast(0.93 as float) as s")
    recall = {r.label: r.recall for r in nn_descent.recall_of(nodes, got, 0.93, queries, lists).collect()}
    assert recall == {0: 0.0, 1: 1.0}


def scattered(count, pairs, label, seed):
    """Vectors far from each other but for so many pairs just above the threshold."""
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(64) for _ in range(count - pairs)]
    for n in range(pairs):
        own = rows[n] / np.linalg.norm(rows[n])
        across = rng.standard_normal(64)
        across -= (across @ own) * own
        rows.append(0.94 * own + math.sqrt(1 - 0.94**2) * across / np.linalg.norm(across))
    return [(label * 100_000 + n, [float(x) for x in v], label) for n, v in enumerate(rows)]


def test_rare_links_are_measured_by_planted_partners(spark, monkeypatch):
    """A search that finds nothing is not taken for good where the sample holds no link."""
    rows = scattered(900, 2, 0, 1)
    assert found(spark, rows) == expected(rows)
    first = nn_descent.first_lists
    monkeypatch.setattr(nn_descent, "first_lists", lambda *options: first(*options).limit(0))
    monkeypatch.setattr(nn_descent, "MOST_TRIES", 1)
    monkeypatch.setattr(nn_descent, "AUDIT", 32)
    assert found(spark, rows) == expected(rows)


def test_partners_stand_at_the_threshold(spark):
    units = [(n, 0, 3, 1, [1.0, 0.0, 0.0]) for n in range(4)] + [(9, 0, 1, 1, [1.0])]
    nodes = spark.createDataFrame(units, "node long, label int, dim int, m long, unit array<double>")
    cosines = {r.node: (r.unit[0], r.m) for r in nn_descent.partners(nodes, 0.93).collect()}
    assert set(cosines) == {-1, -2, -3, -4, -10}
    assert all(m == 0 and (c == 1.0 if n == -10 else 0.93 <= c < 0.9301) for n, (c, m) in cosines.items())


def test_saturated_lists_get_more_places(spark):
    """All links of a group of 25 are listed, which ten places cannot hold; a single node's list stays."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(64)
    vectors = [centre + 0.1 * rng.standard_normal(64) for _ in range(25)] + [rng.standard_normal(64) for _ in range(5)]
    units = [(n, 0, 64, 1, [float(x) for x in v / np.linalg.norm(v)]) for n, v in enumerate(vectors)]
    nodes = spark.createDataFrame(units, "node long, label int, dim int, m long, unit array<double>")
    lists = nn_descent.best_edges(nn_descent.first_lists(nodes, 6, 0, 0.93), nn_descent.K)
    lists = nn_descent.cut(lists, "test-lists")
    wide = nn_descent.enlarged(nodes, lists, 0.93)
    sizes = {r.a: r["count"] for r in wide.groupBy("a").count().collect()}
    assert sizes == {n: 24 if n < 25 else nn_descent.K for n in range(30)}


def test_what_the_search_misses_is_compared_whole(spark, rows, monkeypatch):
    """Lists that find next to nothing end in the comparison of all pairs, not in a result with gaps."""
    few = nn_descent.first_lists
    monkeypatch.setattr(nn_descent, "first_lists", lambda *options: few(*options).filter("a % 7 = 0 and b % 7 = 0"))
    monkeypatch.setattr(nn_descent, "refined", lambda nodes, lists: lists)
    monkeypatch.setattr(nn_descent, "MOST_TRIES", 1)
    monkeypatch.setattr(nn_descent, "WHOLE", 50)
    assert found(spark, rows) == expected(rows)
