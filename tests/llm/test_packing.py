import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from curbline.llm import packing


@lru_cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary())


def whole(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


TEXTS = [
    None,
    "",
    " ",
    "It's 42 dogs here\tand\r\nthere  don't",
    "é café ΣΑΣ ΟΔΟΣ Σ ́x",
    "a\x1cb\x0bc\x0cd \x85 e f",
    "<|endoftext|> x<|startoftext|>y",
    "日本語 text 🙂🙂 x",
    "word " * 3000,
    "x" * 50_000,
]


def rejoined(rows):
    ids = {}
    for row in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        own = ids.setdefault(row.doc_id, [])
        assert row.start == len(own)
        own += np.frombuffer(row.ids, "<u4").tolist()
        assert len(row.ids) == 4 * row.length
    return ids


def test_ids_are_those_of_the_whole_text(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert rejoined(rows) == {n: whole(text) for n, text in enumerate(TEXTS)}
    assert all(row.doc_tokens == len(whole(TEXTS[row.doc_id])) for row in rows)


def test_ids_of_random_words(spark, monkeypatch):
    from curbline.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_PARTS", 300)
    monkeypatch.setattr(tokens, "KEPT_IDS", 900)
    encoder, draw = tokens.PartEncoder(packing.vocabulary()), random.Random(1)
    letters = [*map(chr, range(0x21, 0x260)), *(["'s", "\t", "\n", " \r", "\x1c", "\xa0", "<|endoftext|>", "'LL"] * 20)]
    for _ in range(3000):
        text = "".join(draw.choices(letters, k=draw.randint(1, 12)))
        assert encoder.encode([text])[0].tolist() + [1] == whole(text), text


def test_sequences_are_single_powers_of_two(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert len({row.sequence_id for row in rows}) == len(rows)
    assert {row.offset for row in rows} == {0}
    assert all(row.length & row.length - 1 == 0 and row.length <= 2048 for row in rows)


@pytest.mark.parametrize("tokens", [1, 2, 3, 2047, 2048, 2049, 6145])
def test_pieces_add_up(tokens):
    cuts = packing.piece_lengths(tokens)
    assert sum(cuts) == tokens and sorted(cuts, reverse=True) == cuts
    small = [c for c in cuts if c < 2048]
    assert len(set(small)) == len(small)


def test_repeats_nulls_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", 5, "x"), (1, "a b c", 6, None), (None, "d", None, "y")],
        "doc_id long, text string, length long, sequence_id string",
    )
    rows = packing.pack(docs).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 2), (1, 4), (1, 4)]
    assert len({r.sequence_id for r in rows}) == 3
    assert packing.pack(docs.limit(0)).collect() == []


def test_buckets_hold_one_length(spark, tmp_path):
    docs = spark.createDataFrame([(n, "w " * n) for n in range(40)], "doc_id long, text string")
    packing.write_buckets(packing.pack(docs), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rejoined(back.collect()) == {n: whole("w " * n) for n in range(40)}
    assert spark.read.parquet(str(tmp_path / "out" / "length=8")).filter("octet_length(ids) != 32").count() == 0


def test_query_digest(spark, testdata):
    rows = packing.op8_packing(spark, testdata).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{testdata}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(text)
    for doc_id in list(text)[::20]:
        ids = whole(text[doc_id])
        own = [r for r in rows if r.doc_id == doc_id]
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_a_length_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.decompose(spark.createDataFrame([(1, "a")], "doc_id long, text string"), longest=100)
