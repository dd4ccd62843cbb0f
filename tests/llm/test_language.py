import itertools
import math
import re

import numpy as np
import pytest

from curbline.llm import common, language

TEXTS = {
    "en": "the house and the tree are with the other thing that she was thinking of then",
    "de": "das haus und der baum sind mit dem anderen ding über das sie dann nachgedacht hat",
    "fr": "la maison et l'arbre sont avec l'autre chose à laquelle elle pensait déjà alors",
}
SCHEMA = "doc_id long, text string, lang string, score string, row int, found int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, text + " " + text[n:], lang, "s", 1, 2) for n in range(12) for lang, text in TEXTS.items()]
    return spark.createDataFrame([(k, *row[1:]) for k, row in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs)


def all_segmentations(word, pieces, logs):
    """The sum over every way to cut the word, one by one."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        borders = [0, *[n + 1 for n, cut in enumerate(cuts) if cut], len(word)]
        value = 0.0
        for a, b in zip(borders, borders[1:]):
            if word[a:b] in pieces:
                value += logs[pieces[word[a:b]]]
            elif b - a == 1:
                value += language.UNSEEN
            else:
                value = -math.inf
                break
        total += math.exp(value)
    return math.log(total)


def test_forward_sums_all_segmentations(model):
    scorer = language.Scorer(model)
    words = ["house", "über", "pensait", "xq", "日a", "a"]
    got = scorer.words(words)
    for row, word in zip(got, words):
        for column in range(len(model["languages"])):
            wanted = all_segmentations(language.BEGIN + word, scorer.pieces, model["logs"][:, column])
            assert row[column] == pytest.approx(wanted)


def test_expected_counts_are_those_of_all_segmentations(model):
    pieces = language.read_pieces(model["path"])
    logs = model["logs"][:, :1]
    word = language.BEGIN + "the"
    got = language.expected_counts([word], np.array([2.0]), pieces, logs)
    wanted, total = {}, 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        borders = [0, *[n + 1 for n, cut in enumerate(cuts) if cut], len(word)]
        parts = [word[a:b] for a, b in zip(borders, borders[1:])]
        if all(part in pieces for part in parts):
            weight = math.exp(sum(logs[pieces[part], 0] for part in parts))
            total += weight
            for part in parts:
                wanted[part] = wanted.get(part, 0.0) + weight
    for part, weight in wanted.items():
        assert got[pieces[part]] == pytest.approx(2 * weight / total)


def test_texts_are_told_apart_and_columns_stay(docs, model):
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    rows = language.detect(docs, model).collect()
    assert all(r.found.lang == r.row.lang and 0.9 < r.found.score <= 1 for r in rows)


def test_texts_without_letters_and_very_long_ones(spark, model):
    rows = [(1, None), (2, ""), (3, "12 !! _"), (4, "🙂"), (5, "the house " * 200_000), (5, "日本"), (None, "das haus")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.row.doc_id, r.found.lang, r.found.score) for r in language.detect(docs, model).collect()]
    assert [x for x in got if x[0] in (1, 2, 3, 4)] == [(n, "und", 0.0) for n in (1, 2, 3, 4)]
    assert (5, "en", 1.0) in got and len(got) == 7
    assert [x[1] for x in got if x[0] is None] == ["de"]
    assert language.keep_identified(docs.filter("doc_id < 5"), model).count() == 0


def test_numerals_are_no_letters(spark, model):
    rows = [(1, "² ½ ①"), (2, "Ⅷ ⅷ ٣ ௧"), (3, "²das haus½ ist①da")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: (r.found.lang, r.found.score) for r in language.detect(docs, model).collect()}
    assert got[1] == got[2] == ("und", 0.0)
    assert got[3][0] == "de"
    assert language.letters("²das haus½ ist①da ªçßñ漢字") == ["das", "haus", "ist", "da", "ªçßñ漢字"]


def test_without_labels_every_document_stays(spark, docs):
    model = language.fit(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert model["languages"] == []
    assert language.keep_identified(docs, model).count() == docs.count()


def test_slices_of_a_text_add_up(model, monkeypatch):
    whole, _ = language.Scorer(model).texts(list(TEXTS.values()))
    monkeypatch.setattr(language, "SLICE_WORDS", 3)
    monkeypatch.setattr(language, "KEPT_WORDS", 5)
    parts, counts = language.Scorer(model).texts(list(TEXTS.values()))
    assert np.allclose(whole, parts)
    assert counts.tolist() == [len(re.findall(r"[^\W\d_]+", t)) for t in TEXTS.values()]


def test_no_labelled_row(spark, docs):
    model = language.fit(docs.limit(0))
    assert [(r.found.lang, r.found.score) for r in language.detect(docs.limit(1), model).collect()] == [("und", 0.0)]


def test_sample_is_bounded_and_repeatable(spark):
    rows = [(n, "t", "a" if n % 10 else "b") for n in range(5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = sorted(r.doc_id for r in common.sample_per_label(frame, "lang", 300).collect())
    again = sorted(r.doc_id for r in common.sample_per_label(frame.repartition(9), "lang", 300).collect())
    assert first == again and len(first) == 600


def test_held_out_documents_are_identified(spark, testdata):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{testdata}/documents.parquet").collect()}
    rows = [r for r in language.op7_language(spark, testdata).collect() if r.held_out]
    assert len(rows) > 20
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.98 * len(rows)
