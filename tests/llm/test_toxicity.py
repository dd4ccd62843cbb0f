import random
from collections import Counter

import numpy as np
import pytest

from curbline.llm import toxicity

SCHEMA = "doc_id long, text string, toxic int, found string, row int"


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(3)
    plain = [f"{a}{b}" for a in "bcdfglmnp" for b in ("ano", "eri", "ost", "ulan", "ink")]
    rows, labels = [], []
    for n in range(900):
        words = draw.choices(plain, k=draw.choice([3, 30, 200]))
        toxic = int(n % 6 == 0)
        for _ in range(toxic * 3):
            words.insert(draw.randrange(len(words)), draw.choice(["vile", "nasty", "awful"]))
        rows.append((n, " ".join(words).capitalize(), 0, "f", 1))
        labels.append((n, toxic))
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


@pytest.fixture(scope="module")
def model(corpus):
    return toxicity.fit(corpus[0], corpus[1].filter("doc_id % 5 != 0"), sample=400, examples=100)


def test_index_equals_brute_force():
    draw = np.random.default_rng(2)
    for block, k in ((1, 1), (4, 5), (64, 15), (7, 200)):
        codes = [np.sort(draw.choice(50, draw.integers(0, 12), replace=False)) for _ in range(150)]
        weights = [draw.random(len(c)) for c in codes]
        index = toxicity.BlockMaxIndex(codes, weights, 50, block)
        whole = np.zeros((150, 50))
        for row, (c, w) in enumerate(zip(codes, weights)):
            whole[row, c] = w
        for _ in range(30):
            query = draw.choice(50, draw.integers(1, 10), replace=False)
            share = draw.random(len(query))
            wanted = whole[:, query] @ share
            best, scores = index.nearest(query, share, k)
            order = np.lexsort((np.arange(150), -wanted))[:k]
            order = order[wanted[order] > 0]
            assert np.allclose(scores, wanted[order])
            assert np.allclose(wanted[best], wanted[order])


def test_held_out_documents(spark, corpus, model):
    docs, _, truth = corpus
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == 900 and rows[0].row.asDict().keys() == set(docs.columns)
    held = [r for r in rows if r.row.doc_id % 5 == 0]
    assert all((r.found.score >= 0.5) == bool(truth[r.row.doc_id]) for r in held)
    toxic = [r for r in held if truth[r.row.doc_id]]
    assert all(r.found.evidence and r.found.evidence[0].toxic == 1 for r in toxic)
    assert all(0 <= r.found.score <= 1 for r in rows)


def test_cosines_are_exact(corpus, model):
    known = toxicity.Classifier(model)
    texts = [r.text for r in corpus[0].collect() if r.doc_id % 5 == 0]
    vectors = np.zeros((len(model["ids"]), len(model["terms"])))
    for row, (c, w) in enumerate(zip(model["codes"], model["weights"])):
        vectors[row, c] = w
    assert np.allclose((vectors**2).sum(axis=1), 1)
    for text in texts:
        best, scores = known.neighbours(text)
        counts = Counter(known.place[t] for t in toxicity.terms(text) if t in known.place)
        query = np.zeros(len(model["terms"]))
        for code, n in counts.items():
            query[code] = (1 + np.log(n)) * model["idf"][code]
        if counts:
            query /= np.linalg.norm(query)
            assert np.allclose(np.sort(vectors @ query)[::-1][: len(scores)], scores)
        else:
            assert len(best) == 0


def test_document_frequencies_cover_all_documents(corpus):
    docs, _, _ = corpus
    rows, n = toxicity.document_frequency(docs, ["vile", "nowhere"])
    assert rows == 900
    assert n.tolist() == [sum("vile" in r.text.lower().split() for r in docs.collect()), 0]


def test_null_empty_and_very_long_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "vile nasty " * 100_000), (3, "bano"), (None, "awful")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.row.doc_id, r.row.text): r.found for r in toxicity.score_documents(docs, model).collect()}
    assert got[1, None].score == got[2, ""].score == model["none"] < 0.5
    assert got[3, rows[2][1]].score > 0.5 and got[None, "awful"].score > 0.5


def test_no_labels(spark, corpus):
    docs, labels, _ = corpus
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        model = toxicity.fit(docs, some)
        assert {r.found.score for r in toxicity.score_documents(docs.limit(5), model).collect()} == {0.0}


def test_query_on_the_tables(spark, testdata):
    rows = toxicity.op5_toxicity(spark, testdata).collect()
    assert len(rows) == spark.read.parquet(f"{testdata}/documents.parquet").count()
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
