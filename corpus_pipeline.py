"""The corpus pipeline: its stages in order, each written as Parquet and reread as the next one's documents.

Defined cases: a document whose text is null or without letters is dropped by the first stage, unless no row has a language to learn from: then
all pass it. Of equal texts the largest doc_id stays, of near copies the smallest; rows that repeat a doc_id and a text are copies like others. Null
sources are a source of their own; a null language is not learned from. Long texts pass every stage whole. Columns beyond those of documents
are carried to the last stage, which returns pieces. An empty table gives an empty result with the columns of the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbline.llm import exact_dedup, jaccard, language, mixing, packing
from curbline.llm.common import cut


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those whose language is no likelier than the others together."""
    return language.keep_identified(docs, language.fit(language.learned(docs)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that shingles of ``words`` words link at ``least`` hundredths."""
    return jaccard.keep_one(docs, words=5, least=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights; a document comes as often as it is drawn."""
    return mixing.mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two length, a sequence each."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: A trained language model and a tokenizer cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
