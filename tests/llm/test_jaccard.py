import itertools
import random

import numpy as np
import pytest

from curbline.llm import common, jaccard

SCHEMA = "doc_id long, text string, n int, part string, grp int, row string"


def words_of(text):
    out, word = [], b""
    for byte in (text or "").encode() + b" ":
        if byte == 0x20 or 0x09 <= byte <= 0x0D:
            if word:
                out.append(word)
            word = b""
        else:
            word += bytes([byte + 32 if 65 <= byte <= 90 else byte])
    return out


def set_of(text):
    words = words_of(text)
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def expected(rows):
    sets = [set_of(row[1]) for row in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
            group = [group[i] if g == group[j] else g for g in group]
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((row[0], len(sets[i]), min(ids, default=None) if sets[i] else row[0]))
    return sorted(out, key=repr)


def marked(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n", "component_id").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    texts = [None, "", " \n", "One", "one", "one two", "ONE\ttwo", "one two ", "a b c", "A B C", "É b c", "é b c"]
    for size in (8, 10, 11, 12, 19, 20, 21, 40, 100, 101, 300, 1000):
        for _ in range(3):
            base = [f"w{draw.randrange(5000)}" for _ in range(size)]
            texts.append(" ".join(base))
            for edits in (0, 1, 1, 2, size // 60, size // 40, size // 30, size // 25, size // 20):
                copy = list(base)
                for _ in range(edits):
                    place = draw.randrange(len(copy))
                    copy[place : place + draw.choice([0, 1])] = [f"e{draw.randrange(9000)}"]
                texts.append(" ".join(copy))
    chain = [f"c{n}" for n in range(60)]
    texts += [" ".join(chain[n : n + 50]) for n in range(0, 11)]  # a chain: each links with its neighbours
    texts += ["same few words " * 30, "same few words " * 31, "junk " * 50, "junk " * 90]
    rows = [(n, t, n, "p", 1, "r") for n, t in enumerate(texts)]
    draw.shuffle(rows)
    return rows


def test_groups_equal_brute_force(spark, rows):
    assert marked(jaccard.mark_groups(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_many_small_tiles_give_the_same(spark, rows, monkeypatch):
    original = jaccard.tiles
    monkeypatch.setattr(jaccard, "tiles", lambda c, least: original(c, least, 60))
    assert marked(jaccard.mark_groups(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_every_linked_pair_shares_a_part_hash():
    draw = np.random.default_rng(0)
    for size in (10, 11, 13, 19, 25, 60, 200, 1900):
        for _ in range(30):
            one = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
            cut = jaccard.most_difference(2 * size)
            drop = draw.integers(0, cut + 1)
            added = draw.integers(0, 2**63, cut - drop).astype(np.uint64)
            other = np.unique(np.concatenate([draw.permutation(one)[drop:], added]))
            if jaccard.linked(one, other):
                assert np.intersect1d(jaccard.part_hashes(one), jaccard.part_hashes(other)).size


def test_bitmaps_never_understate_the_overlap():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 400, 150).astype(np.uint64)) for _ in range(40)]
    maps = jaccard.bitmaps(sets)
    for i, j in itertools.combinations(range(40), 2):
        differ = len(np.setxor1d(sets[i], sets[j]))
        assert int(np.bitwise_count(maps[i] ^ maps[j]).sum()) <= differ


def test_repeated_rows_null_ids_and_columns(spark):
    text = " ".join(f"w{n}" for n in range(100))
    near = text + " tail"
    rows = [(5, text), (5, text), (5, "quite another text here"), (None, near), (9, near), (None, "lone words are here")]
    rows += [(None, None), (7, "")]
    rows = [(*row, 1, "p", 2, "r") for row in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert marked(jaccard.mark_groups(docs)) == expected(rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(5, text), (5, "quite another text here"), (None, "lone words are here"), (None, None), (7, "")], key=repr
    )


def test_hot_group_of_near_copies(spark):
    draw = random.Random(9)
    base = [f"w{n}" for n in range(80)]
    rows = []
    for n in range(600):
        copy = list(base)
        copy[draw.randrange(80)] = f"x{n}"
        rows.append((n, " ".join(copy), 1, "p", 2, "r"))
    got = marked(jaccard.mark_groups(spark.createDataFrame(rows, SCHEMA)))
    assert got == expected(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert marked(jaccard.mark_groups(docs)) == []
    assert jaccard.keep_one(docs).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(500, n) for n in range(501, 560)]
    rows = [*chain, *star, (7, 7), (3, 2), (2, 3), (3, 2), (None, 4)]
    random.Random(1).shuffle(rows)
    got = common.connected_components(spark.createDataFrame(rows, "a long, b long"), "t").collect()
    wanted = {n: 100 for n in range(100, 161)} | {n: 500 for n in range(500, 560)} | {2: 2, 3: 2}
    assert {r.node: r.component for r in got} == wanted and len(got) == len(wanted)
