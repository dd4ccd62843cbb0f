"""Language identification by segmentation-marginalised unigrams.

Each language has its own probabilities for the pieces of one fixed public vocabulary. A word's probability
in a language is the sum over all its segmentations into pieces, found by the forward algorithm; a
text's is the product over its words. Piece probabilities are learned by expectation maximisation: forward and
backward sums give the expected count of each piece over the words of a language.

Words are runs of letters in lower case, with the vocabulary's mark for a word's begin. Each Python worker
remembers the scores of words it has met, so a text costs little more than the split into words. Texts
never leave their task; what comes to the driver is a number per piece and language.

The model is fitted on at most ``SAMPLE`` labelled rows of each language, those whose ids hash lowest.

Defined cases: a text that is null or without letters is ``und`` with score 0, as is everything when there
is no labelled row; characters outside the vocabulary cost the same in each language; ties go to the language
first by code point; repeated rows are scored alike; very long texts are scored whole, in slices of their
words; rows without a language are not learned from; further columns are carried along and may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from curbline.llm.common import cut, held, held_out, sample_per_label

#: Labelled rows of each language that the model is fitted on, at most.
SAMPLE = 1500
#: Rounds of expectation maximisation.
ROUNDS = 3
#: Count added to each piece of each language.
SMOOTHING = 0.05
#: Log probability of a character that the vocabulary lacks.
UNSEEN = -18.0
#: Words kept by one Python worker before it starts afresh.
KEPT_WORDS = 300_000
#: Words that are looked up, and texts that are taken from a batch, at a time.
SLICE_WORDS = 250_000
SLICE_TEXTS = 500
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Fixed value: the vocabulary's mark of a word's begin.
BEGIN = "▁"


def vocabulary() -> str:
    """The default vocabulary file, wherever the tokenizer package is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> dict[str, int]:
    """Pieces of the vocabulary and their numbers; control and byte pieces left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i)))
    names = (model.id_to_piece(i) for i in plain if not model.is_unknown(i))
    return {name: number for number, name in enumerate(names)}


class Lattice:
    """All segmentations of words of one length, as edges between character borders."""

    def __init__(self, words: list[str], pieces: dict[str, int], longest: int) -> None:
        self.size = len(words[0])
        self.words = len(words)
        self.edges: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for start in range(self.size):
            for end in range(start + 1, min(self.size, start + longest) + 1):
                found = np.fromiter((pieces.get(w[start:end], -1) for w in words), np.int64, len(words))
                rows = np.flatnonzero(found >= 0) if end > start + 1 else np.arange(len(words))
                if len(rows):
                    self.edges.append((start, end, rows, found[rows]))

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """Log sums over all paths to each border; ``logs`` is pieces x models, its last row the unseen."""
        sums = np.full((self.size + 1, self.words, logs.shape[1]), -np.inf)
        sums[0] = 0.0
        for start, end, rows, ids in self.edges:
            sums[end, rows] = np.logaddexp(sums[end, rows], sums[start, rows] + logs[ids])
        return sums

    def backward(self, logs: np.ndarray) -> np.ndarray:
        sums = np.full((self.size + 1, self.words, logs.shape[1]), -np.inf)
        sums[self.size] = 0.0
        for start, end, rows, ids in reversed(self.edges):
            sums[start, rows] = np.logaddexp(sums[start, rows], sums[end, rows] + logs[ids])
        return sums


def by_length(words: list[str], most: int = 20_000) -> Iterator[np.ndarray]:
    """Positions of words of equal length, some at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        step = max(1, min(most, 4_000_000 // (int(lengths[group[0]]) + 1))) if len(group) else most
        for first in range(0, len(group), step):
            yield group[first : first + step]


def expected_counts(words: list[str], counts: np.ndarray, pieces: dict[str, int], logs: np.ndarray) -> np.ndarray:
    """Expected occurrences of each piece over counted words, under one model."""
    total = np.zeros(len(pieces) + 1)
    longest = max(map(len, pieces))
    for group in by_length(words):
        lattice = Lattice([words[i] for i in group], pieces, longest)
        ahead, behind = lattice.forward(logs)[..., 0], lattice.backward(logs)[..., 0]
        for start, end, rows, ids in lattice.edges:
            share = np.exp(ahead[start, rows] + logs[ids, 0] + behind[end, rows] - ahead[-1, rows])
            total += np.bincount(ids % len(total), share * counts[group[rows]], len(total))
    return total[:-1]


def letters(text: str) -> list[str]:
    found = LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # Superscripts, fractions, Roman numerals and the like are in the class, but are numbers and no letters.
    split = ("".join(c if c.isalpha() else " " for c in word).split() for word in found)
    return [part for parts in split for part in parts]


def fit(labelled: DataFrame, path: str | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> dict:
    """A model ``{"path", "languages", "logs"}`` from ``doc_id, text, lang`` rows."""
    path = path or vocabulary()
    pieces = read_pieces(path)
    rows = sample_per_label(labelled.select("doc_id", "text", "lang").dropna(subset=["lang"]), "lang", sample)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                counts.setdefault(lang, Counter()).update(letters(text or ""))
        for lang, own in counts.items():
            columns = [pa.array([lang] * len(own)), pa.array(list(own)), pa.array(list(own.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    counted = rows.select("text", "lang").mapInArrow(count_words, "lang string, word string, n long")
    words = cut(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    logs = np.zeros((len(pieces) + 1, len(languages)))
    logs[-1] = UNSEEN

    for step in range(rounds):
        flat = np.zeros_like(logs[:, :1]) - np.log(len(pieces))
        flat[-1] = UNSEEN

        def expect(batches: Iterator[pa.RecordBatch], step: int = step, logs: np.ndarray = logs, flat=flat):
            pieces = read_pieces(path)
            total: dict[str, np.ndarray] = {}
            for batch in batches:
                frame = batch.to_pandas()
                for lang, own in frame.groupby("lang"):
                    model = logs[:, [languages.index(lang)]] if step else flat
                    found = expected_counts([BEGIN + w for w in own["word"]], own["n"].to_numpy(float), pieces, model)
                    total[lang] = total.get(lang, 0.0) + found
            for lang, found in total.items():
                ids = np.flatnonzero(found > 1e-9)
                columns = [pa.array([lang] * len(ids)), pa.array(ids), pa.array(found[ids])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "piece", "expected"])

        expected = words.mapInArrow(expect, "lang string, piece long, expected double")
        totals = np.full((len(pieces), len(languages)), SMOOTHING)
        for row in expected.groupBy("lang", "piece").agg(F.sum("expected").alias("n")).toLocalIterator():
            totals[row["piece"], languages.index(row["lang"])] += row["n"]
        logs = np.vstack([np.log(totals / totals.sum(axis=0)), np.full((1, len(languages)), UNSEEN)])
    return {"path": path, "languages": languages, "logs": logs}


class Scorer:
    """Log probabilities of words and texts under all languages of a model."""

    def __init__(self, model: dict) -> None:
        self.pieces, self.logs = read_pieces(model["path"]), model["logs"]
        self.longest = max(map(len, self.pieces))
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, self.logs.shape[1]))

    def learn(self, words: list[str]) -> None:
        found = np.zeros((len(words), self.logs.shape[1]))
        marked = [BEGIN + word for word in words]
        for group in by_length(marked):
            found[group] = Lattice([marked[i] for i in group], self.pieces, self.longest).forward(self.logs)[-1]
        for word in words:
            self.place[word] = len(self.place)
        self.scores = np.vstack([self.scores, found])

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of words, one row each."""
        if len(self.place) > KEPT_WORDS:
            self.clear()
        new = [word for word in dict.fromkeys(words) if word not in self.place]
        if new:
            self.learn(new)
        return self.scores[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of texts and how many words each has."""
        total = np.zeros((len(texts), self.logs.shape[1]))
        counts = np.zeros(len(texts), np.int64)
        held: list[str] = []
        rows: list[int] = []

        def add() -> None:
            np.add.at(total, np.array(rows, np.int64), self.words(held))

        for row, text in enumerate(texts):
            found = letters(text)
            counts[row] = len(found)
            for first in range(0, len(found), SLICE_WORDS):
                some = found[first : first + SLICE_WORDS]
                held += some
                rows += [row] * len(some)
                if len(held) >= SLICE_WORDS:
                    add()
                    held, rows = [], []
        if held:
            add()
        return total, counts


def scorer_of(model: dict) -> Scorer:
    """The scorer of this Python worker for a model."""
    return held("language", model["id"], lambda: Scorer(model))


def identify(text: Column, model: dict, session) -> Column:
    """``struct<lang, score>``: the likeliest language and its posterior, all languages likely alike before."""
    import hashlib

    known = model | {"id": hashlib.sha256(model["logs"].tobytes()).hexdigest()}
    languages = model["languages"]
    shared = session.sparkContext.broadcast(known)  # pieces x languages, bounded by the vocabulary

    @arrow_udf("struct<lang: string, score: double>")
    def predict(column: pa.Array) -> pa.Array:
        scorer = scorer_of(shared.value)
        # A few texts at a time: an Arrow batch may hold 64 MB of them.
        slices = [column.slice(first, SLICE_TEXTS) for first in range(0, len(column), SLICE_TEXTS)]
        parts = [scorer.texts([text or "" for text in some.to_pylist()]) for some in slices]
        logs = np.concatenate([np.zeros((0, len(languages))), *[part[0] for part in parts]])
        counts = np.concatenate([np.zeros(0, np.int64), *[part[1] for part in parts]])
        if not languages:
            names, scores = [UNKNOWN] * len(column), np.zeros(len(column))
        else:
            best = logs.argmax(axis=1)
            top = logs[np.arange(len(best)), best]
            scores = np.where(counts > 0, 1.0 / np.exp(logs - top[:, None]).sum(axis=1), 0.0)
            names = [languages[b] if n else UNKNOWN for b, n in zip(best, counts, strict=True)]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang", "score"])

    return predict(text)


def detect(docs: DataFrame, model: dict) -> DataFrame:
    """``row`` (the document) and ``found`` (lang, score)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), identify(F.col("text"), model, docs.sparkSession).alias("found"))


def keep_identified(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The documents whose language is known with a score of ``least`` or more, columns unchanged.

    Where nothing was learned nothing can be told, and all documents stay.
    """
    if not model["languages"]:
        return docs
    found = F.col("found")
    return detect(docs, model).filter((found["lang"] != UNKNOWN) & (found["score"] >= least)).select("row.*")


def learned(docs: DataFrame) -> DataFrame:
    """The documents that a model may learn from."""
    return docs.filter(~held_out(F.col("doc_id"), 4, 2))


def op7_language(spark, sf_dir: str) -> DataFrame:
    """Per document: the predicted language and its score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return detect(docs.select("doc_id", "text"), fit(learned(docs))).select(
        "row.doc_id",
        held_out(F.col("row.doc_id"), 4, 2).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )
