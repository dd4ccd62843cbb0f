"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The classifier is fitted on a bounded sample of labelled rows: at most ``SAMPLE`` of each label, those whose ids
hash lowest. Its vocabulary are the terms that at least double the odds of a label, beyond chance; as many
examples as ``EXAMPLES`` of each label make up the index, the others calibrate. Document frequencies are counted over
all documents.

The index lists, for each term, the examples with it in blocks, and the largest weight in each block. A
query adds up these maxima to a bound for every block, scores blocks in order of their bounds, and stops when
no bound beats the k-th best score: its nearest examples are exact, whatever is skipped. Their votes, weighted by
cosine, become a score by a logistic curve fitted on the other sampled rows, weighted to the labels' true
shares. A text with no term of the vocabulary has no neighbour; its score is the share of toxic rows among such
texts. The nearest examples are returned as evidence.

Defined cases: null and empty texts have no neighbour; a doc_id labelled twice counts as toxic if one label says so;
without labelled rows of both labels every score is the share of toxic rows, or 0; equal texts of the
sample count once; repeated rows are scored alike; very long texts are scored whole; an empty table gives an
empty result; further columns are carried along and may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from curbline.llm.common import cut, held, held_out, sample_per_label, strings, table

#: Labelled rows of each label that the classifier is fitted on, and of these the examples of the index, at most.
SAMPLE = 6000
EXAMPLES = 2000
#: Terms of the vocabulary at most, and how sure its odds must be, in standard errors.
MOST_TERMS = 50_000
SURE = 2.5
#: Examples in a block of the index, and neighbours that vote.
BLOCK = 64
NEIGHBOURS = 15
LETTERS = re.compile(r"[^\W\d_]+")


def terms(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


class BlockMaxIndex:
    """Postings by term, in blocks of examples, with the largest weight of each term in each block."""

    def __init__(self, codes: list[np.ndarray], weights: list[np.ndarray], terms: int, block: int = BLOCK) -> None:
        example = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        term = np.concatenate([*codes, np.zeros(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([*weights, np.zeros(0)])
        order = np.lexsort((example, term))
        self.example, self.weight, term = example[order], weight[order], term[order]
        self.size, self.block = len(codes), block
        self.blocks = -(-len(codes) // block)
        # One entry for each block of each term: where its postings begin, and their largest weight.
        key = term * max(1, self.blocks) + self.example // block
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.starts = np.append(first, len(key))
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.entry_block = key[first] % max(1, self.blocks)
        self.term_starts = np.searchsorted(key[first] // max(1, self.blocks), np.arange(terms + 1))

    @staticmethod
    def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """All numbers of several ranges, one after the other."""
        lengths = ends - starts
        after = np.cumsum(lengths)
        return np.arange(int(after[-1]) if len(after) else 0) + np.repeat(starts - (after - lengths), lengths)

    def nearest(self, codes: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the largest dot product over 0, and the products; ties to the earlier example."""
        entries = self.ranges(self.term_starts[codes], self.term_starts[codes + 1])
        share = np.repeat(weights, self.term_starts[codes + 1] - self.term_starts[codes])
        bound = np.bincount(self.entry_block[entries], share * self.most[entries], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound > 0)]
        best, scores = np.zeros(0, np.int64), np.zeros(0)
        done, wave = 0, -(-k // self.block)
        while done < len(order):
            # Sums in another order may differ in the last bits, hence the slack.
            if len(best) == k and bound[order[done]] < scores[-1] * (1 - 1e-9):
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[order[done : done + wave]] = True
            some = chosen[self.entry_block[entries]]
            starts, ends = self.starts[entries[some]], self.starts[entries[some] + 1]
            places = self.ranges(starts, ends)
            total = np.bincount(
                self.example[places], self.weight[places] * np.repeat(share[some], ends - starts), self.size
            )
            hit = np.flatnonzero(total > 0)
            best, scores = np.concatenate([best, hit]), np.concatenate([scores, total[hit]])
            top = np.lexsort((best, -scores))[:k]
            best, scores = best[top], scores[top]
            done, wave = done + wave, wave * 2
        return best, scores


class Classifier:
    """Vocabulary, index and calibration of a fitted model."""

    def __init__(self, model: dict) -> None:
        self.model = model
        self.place = {term: code for code, term in enumerate(model["terms"])}
        self.idf = model["idf"]
        self.index = BlockMaxIndex(model["codes"], model["weights"], len(model["terms"]))

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Codes and weights of a text at length 1: (1 + ln count) * idf."""
        codes = np.fromiter(counts, np.int64, len(counts))
        weights = (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))) * self.idf[codes]
        return codes, weights / np.sqrt(weights @ weights) if len(codes) else weights

    def counts(self, text: str) -> Counter:
        place = self.place
        return Counter([place[term] for term in terms(text) if term in place])

    def neighbours(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts(text)
        if not counts:
            return np.zeros(0, np.int64), np.zeros(0)
        return self.index.nearest(*self.vector(counts), NEIGHBOURS)

    def vote(self, best: np.ndarray, scores: np.ndarray) -> float:
        """Toxic share of the neighbours by squared cosine, drawn to the middle where they are few or far."""
        weight = scores * scores
        return float((weight @ self.model["toxic"][best] + 0.25) / (weight.sum() + 0.5))

    def score(self, best: np.ndarray, scores: np.ndarray) -> float:
        if not len(best):
            return self.model["none"]
        slope, shift = self.model["curve"]
        vote = self.vote(best, scores)
        return float(1 / (1 + np.exp(-(slope * np.log(vote / (1 - vote)) + shift))))


def vocabulary(sample: DataFrame, totals: dict[int, int], most: int = MOST_TERMS, sure: float = SURE) -> list[str]:
    """Terms whose log odds for a label lie beyond ln 2 by ``sure`` standard errors, the surest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(strings(batch["text"]), batch["toxic"].to_pylist(), strict=True):
                found[toxic].update(set(terms(text)))
            for toxic, own in found.items():
                columns = [pa.array(list(own), pa.string()), pa.array([toxic] * len(own), pa.int32())]
                columns.append(pa.array(list(own.values()), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "n"])

    counted = sample.select("text", "toxic").mapInArrow(count, "term string, toxic int, n long")
    cells = counted.groupBy("term").agg(
        *[(F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)) + 0.5).alias(f"with{t}") for t in (0, 1)]
    )
    without = [F.lit(totals[t] + 1.0) - F.col(f"with{t}") for t in (0, 1)]
    odds = F.log(F.col("with1") * without[0] / (F.col("with0") * without[1]))
    error = F.sqrt(1 / F.col("with0") + 1 / F.col("with1") + 1 / without[0] + 1 / without[1])
    surest = cells.withColumn("sure", (F.abs(odds) - float(np.log(2.0))) / error).filter(F.col("sure") >= sure)
    rows = surest.orderBy(F.col("sure").desc(), "term").limit(most).select("term").collect()
    return [row["term"] for row in rows]


def document_frequency(docs: DataFrame, known: list[str]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term, over all of them."""
    place = {term: code for code, term in enumerate(known)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, np.zeros(len(place), np.int64)
        for batch in batches:
            rows += batch.num_rows
            for text in strings(batch["text"]):
                codes = {place[term] for term in terms(text) if term in place}
                if codes:
                    total[list(codes)] += 1
        codes = np.flatnonzero(total)
        columns = [pa.array([-1, *codes.tolist()], pa.int64()), pa.array([rows, *total[codes].tolist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["code", "n"])

    counted = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    total = np.zeros(len(known), np.int64)
    rows = 0
    for row in counted.collect():  # a number per term of a bounded vocabulary
        if row["code"] < 0:
            rows = row["n"]
        else:
            total[row["code"]] = row["n"]
    return rows, total


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic curve, by Newton steps with a mild pull to slope 1, shift 0."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    start = beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + (beta - start)
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, examples: int = EXAMPLES) -> dict:
    """A model from ``doc_id, text`` and ``doc_id, toxic``. All that comes to the driver is bounded by the sample."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    known = cut(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("doc_id is not null"), "toxic-labels")
    shares = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    model = {
        "terms": [], "idf": np.zeros(0), "codes": [], "weights": [], "ids": np.zeros(0, np.int64),
        "toxic": np.zeros(0, np.int64), "none": shares.get(1, 0) / max(1, sum(shares.values())), "curve": (1.0, 0.0),
    }
    # At most 2 * sample ids of 8 bytes: small enough to go to every task.
    drawn = cut(sample_per_label(known, "toxic", sample).select("doc_id", "toxic"), "toxic-drawn")
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = cut(
        chosen.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(
            F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")
        ),
        "toxic-sample",
    )
    totals = {row["toxic"]: row["n"] for row in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return model
    model["terms"] = vocabulary(rows, totals)
    corpus, frequency = document_frequency(docs, model["terms"])
    model["idf"] = np.log((1 + corpus) / (1 + frequency)) + 1
    empty = Classifier(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [empty.counts(text) for text in strings(batch["text"])]
            columns = [batch["doc_id"], batch["toxic"]]
            columns += [pa.array([list(c) for c in found], pa.list_(pa.int64()))]
            columns += [pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "codes", "counts"])

    schema = "doc_id long, toxic int, codes array<long>, counts array<long>"
    vectors = rows.select(F.col("doc_id").cast("long"), "toxic", "text").mapInArrow(count, schema).toPandas()
    order = vectors["doc_id"].map(lambda i: hashlib.sha256(str(i).encode()).digest())
    vectors = vectors.iloc[np.argsort(order.to_numpy(), kind="stable")].reset_index(drop=True)
    vectors["place"] = vectors.groupby("toxic").cumcount()
    wanted = {label: min(examples, -(-2 * totals[label] // 3)) for label in (0, 1)}
    vectors["example"] = vectors["place"] < vectors["toxic"].map(wanted)
    counters = [Counter(dict(zip(c, n, strict=True))) for c, n in zip(vectors["codes"], vectors["counts"], strict=True)]
    listed = vectors[vectors["example"] & (vectors["codes"].str.len() > 0)].sort_values(["toxic", "place"])
    pairs = [empty.vector(counters[row]) for row in listed.index]
    model["codes"], model["weights"] = [p[0] for p in pairs], [p[1] for p in pairs]
    model["ids"], model["toxic"] = listed["doc_id"].to_numpy(np.int64), listed["toxic"].to_numpy(np.int64)

    # The other rows calibrate, each label weighted to its true share.
    fitted = Classifier(model)
    rest = vectors[~vectors["example"]]
    weigh = {label: shares[label] / sum(shares.values()) for label in (0, 1)}
    counts = rest["toxic"].value_counts()
    none, logits, truth, weights = np.array([weigh[1], 1.0]) * 0.5, [], [], []
    for row, toxic in zip(rest.index, rest["toxic"], strict=True):
        weight = weigh[toxic] * len(rest) / counts[toxic]
        if counters[row]:
            vote = fitted.vote(*fitted.index.nearest(*fitted.vector(counters[row]), NEIGHBOURS))
            logits.append(np.log(vote / (1 - vote)))
            truth.append(toxic)
            weights.append(weight)
        else:
            none += np.array([toxic * weight, weight])
    model["none"] = float(none[0] / none[1])
    model["curve"] = logistic(np.array(logits), np.array(truth, float), np.array(weights))
    return model


def classifier_of(model: dict) -> Classifier:
    """The classifier of this Python worker for a model."""
    return held("toxicity", model["id"], lambda: Classifier(model))


def toxicity(text: Column, model: dict, session: SparkSession) -> Column:
    """``struct<score, evidence>``; evidence has the nearest examples with their cosine and label."""
    digest = hashlib.sha256(repr((model["terms"], model["none"], model["curve"])).encode())
    digest.update(model["ids"].tobytes())
    shared = session.sparkContext.broadcast(model | {"id": digest.hexdigest()})  # bounded by the sample

    @arrow_udf("struct<score: double, evidence: array<struct<doc_id: long, cosine: double, toxic: int>>>")
    def scored(column: pa.Array) -> pa.Array:
        known = classifier_of(shared.value)
        ids, toxic = known.model["ids"], known.model["toxic"]
        scores, evidence = [], []
        for value in column:
            best, near = known.neighbours(value.as_py() or "")
            scores.append(known.score(best, near))
            evidence.append(
                [
                    {"doc_id": i, "cosine": c, "toxic": t}
                    for i, c, t in zip(ids[best].tolist(), near.tolist(), toxic[best].tolist(), strict=True)
                ]
            )
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["score", "evidence"])

    return scored(text)


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """``row`` (the document) and ``found`` (score, evidence)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), toxicity(F.col("text"), model, docs.sparkSession).alias("found"))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Per document: a calibrated toxicity score, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5, 0))
    return score_documents(docs, fit(docs, labels)).select(
        "row.doc_id",
        held_out(F.col("row.doc_id"), 5, 0).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
    )
