import collections
import random

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from curbline.llm import packing

LANGUAGES = {
    "en": "the house and tree are with other thing that she was thinking of then when water came over hill".split(),
    "de": "das haus und der baum sind mit dem anderen ding über das sie dann nachgedacht hat wasser".split(),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(7)
    rows = []
    for n in range(240):
        lang = "de" if n % 4 == 0 else "en"
        rows.append((n, " ".join(draw.choices(LANGUAGES[lang], k=60)), lang, f"src{n % 3}", 0))
    rows += [(300 + n, rows[n][1], rows[n][2], rows[n][3], 0) for n in range(20)]  # copies
    rows += [(400 + n, rows[50 + n][1] + " end", rows[50 + n][2], rows[50 + n][3], 0) for n in range(20)]  # near copies
    rows += [(500, "12 34 !!", "en", "src0", 0), (501, None, None, None, None), (502, "", "de", "src1", 0)]
    path = tmp_path_factory.mktemp("sf")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(path / "documents.parquet"))
    return str(path), rows


def test_stages_in_order(spark, folder):
    path, rows = folder
    texts = {row[0]: row[1] for row in rows}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, path), "test")
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert set(kept["language ID"]) == set(texts) - {500, 501, 502}
    assert sorted(kept["exact dedup"]) == sorted(set(kept["language ID"]) - set(range(20)))
    assert sorted(kept["n-gram Jaccard join"]) == sorted(set(kept["exact dedup"]) - set(range(400, 420)))
    times = collections.Counter(kept["mixing"])
    assert set(times) <= set(kept["n-gram Jaccard join"]) and max(times.values()) <= 3
    pieces = collections.defaultdict(list)
    for row in docs.collect():
        pieces[row.doc_id].append(row)
    assert set(pieces) == set(times)
    encoder = packing.part_encoder(packing.vocabulary())
    for doc_id, own in pieces.items():
        ids, _ = encoder.encode([texts[doc_id]])
        whole = [*ids.tolist(), 1]
        assert sum(r.length for r in own) == times[doc_id] * len(whole)
        for r in own:
            assert np.frombuffer(r.ids, "<u4").tolist() == whole[r.start : r.start + r.length]
    assert len({r.sequence_id for own in pieces.values() for r in own}) == sum(map(len, pieces.values()))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_unlabelled_and_empty_tables(spark, tmp_path):
    rows = [(1, "das haus ist hier", None, None, None), (2, "das haus ist hier", None, "a", 3), (3, None, None, "a", None)]
    # The copy goes; the null text stays, and is drawn as often as its source, once.
    for name, some, kept in (("none", [], set()), ("unlabelled", rows, {2, 3})):
        spark.createDataFrame(some, SCHEMA).write.parquet(str(tmp_path / name / "documents.parquet"))
        result = corpus_pipeline.run(spark, str(tmp_path / name))
        assert {r.doc_id for r in result.collect()} == kept


def test_run_is_registered(spark, folder):
    result = contract.queries()["pipeline"](spark, folder[0])
    assert result.count() > 0
    assert result.columns == packing.pack(spark.read.parquet(f"{folder[0]}/documents.parquet")).columns


def test_one_query_of_each_number():
    numbers = sorted(int(name[2:].split("_")[0]) for name in contract.queries() if name.startswith("op"))
    assert numbers == list(range(1, 14))
