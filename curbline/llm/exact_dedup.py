"""Exact duplicates by composable polynomial fingerprints, confirmed by comparing chunks.

A text's fingerprint is its UTF-8 bytes as a polynomial at two points modulo 2**31 - 1, with its length. It
composes: fingerprint(left + right) = fingerprint(left) * point**len(right) + fingerprint(right), so
chunks are hashed side by side and added up with shifts, within a text here and across tasks in
``join_parts``, where a huge document comes as rows of parts.

Equal fingerprints are candidates only. Their texts are cut into chunks that stream through one grouped
count by (fingerprint, chunk number, bytes): repeated chunks shrink to one before the shuffle, so a group
of copies with a third of all rows costs no more than its share of the scan. Only a group with two
different chunks at one number is split, by the SHA-256 of its texts.

Defined cases: a null text equals an empty one; of equal texts the row with the largest doc_id stays; a
null doc_id stays only where the group has no other; rows that repeat doc_id and text count in the size
of their group and are all marked kept, and ``deduplicate`` gives one of them; an empty table gives an
empty result; further columns are carried along and may have any name but a repeated one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from curbline.llm.common import cut, release

#: The modulus and the two points; fixed values, any points would do.
PRIME = 2**31 - 1
POINTS = (1_318_699_427, 903_746_123)
#: Bytes per chunk that is hashed: sums of 4,096 products of 8 and 31 bits are exact in a double.
HASH_CHUNK = 4096
#: Bytes per chunk that is compared.
COMPARE_CHUNK = 65_536


def powers(point: int, count: int, prime: int = PRIME) -> np.ndarray:
    """point**(count-1), ..., point, 1 modulo the prime."""
    out = [1]
    for _ in range(count - 1):
        out.append(out[-1] * point % prime)
    return np.array(out[::-1], np.float64)


def combine(left: int, right: int, right_length: int, point: int, prime: int = PRIME) -> int:
    """Fingerprint of two texts in a row, from theirs."""
    return (left * pow(point, right_length, prime) + right) % prime


def hash_bytes(data: np.ndarray, weights: np.ndarray, points=POINTS, prime: int = PRIME) -> tuple[int, ...]:
    """Fingerprint of one text's bytes; ``weights`` has a column of ``powers`` per point."""
    chunk = len(weights)
    count = -(-len(data) // chunk)
    if count <= 1:
        return tuple(int(h) % prime for h in data.astype(np.float64) @ weights[chunk - len(data) :])
    first = len(data) - (count - 1) * chunk
    parts = np.zeros((count, chunk), np.uint8)
    parts[0, chunk - first :] = data[:first]  # zeros before a text add nothing
    parts[1:] = data[first:].reshape(count - 1, chunk)
    hashed = np.empty((count, len(points)))
    for row in range(0, count, 1024):
        hashed[row : row + 1024] = parts[row : row + 1024].astype(np.float64) @ weights
    out = []
    for point, column in zip(points, hashed.T, strict=True):
        total, shift = 0, pow(point, chunk, prime)
        for value in column.tolist():
            total = (total * shift + int(value)) % prime
        out.append(total)
    return tuple(out)


def fingerprint(text: Column, points=POINTS, prime: int = PRIME) -> Column:
    """``struct<fp_a, fp_b>`` of a string or binary column; null as empty."""

    @arrow_udf("struct<fp_a: long, fp_b: long>")
    def hashed(column: pa.Array) -> pa.Array:
        release()
        weights = np.stack([powers(point, HASH_CHUNK, prime) for point in points], axis=1)
        column = column.cast(pa.large_binary())
        _, offsets, values = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1].tolist()
        data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
        found = [hash_bytes(data[a:b], weights, points, prime) for a, b in zip(ends, ends[1:], strict=False)]
        pair = np.array(found, np.int64).reshape(-1, 2)
        return pa.StructArray.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["fp_a", "fp_b"])

    return hashed(F.coalesce(text, F.lit("")))


def join_parts(parts: DataFrame, points=POINTS, prime: int = PRIME) -> DataFrame:
    """``doc_id, fp_a, fp_b, n_bytes`` of documents that come as ``doc_id, part, bytes`` rows.

    Each part is hashed where it lies and shifted by the bytes behind it; the shifted hashes of a document
    add up in any order. Parts count up; null bytes are none.
    """
    @arrow_udf("long")
    def shifted(value: pa.Array, behind: pa.Array, which: pa.Array) -> pa.Array:
        rows = zip(value.to_pylist(), behind.to_pylist(), which.to_pylist(), strict=True)
        return pa.array([v * pow(points[w], b, prime) % prime for v, b, w in rows], pa.int64())

    hashed = parts.select(
        "doc_id",
        "part",
        F.coalesce(F.octet_length("bytes"), F.lit(0)).cast("long").alias("n"),
        fingerprint(F.coalesce("bytes", F.lit(b"")), points, prime).alias("fp"),
    )
    later = Window.partitionBy("doc_id").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    behind = hashed.withColumn("behind", F.coalesce(F.sum("n").over(later), F.lit(0)))
    total = [
        F.pmod(F.sum(shifted(F.col(f"fp.{name}"), F.col("behind"), F.lit(which))), F.lit(prime)).alias(name)
        for which, name in enumerate(("fp_a", "fp_b"))
    ]
    return behind.groupBy("doc_id").agg(*total, F.sum("n").alias("n_bytes"))


def differing_groups(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Groups whose texts differ somewhere: their chunks, counted by number and bytes.

    ``members`` has ``doc_id, text_hash`` and the ``group`` of rows that share a fingerprint.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("bytes")
    )
    wanted = members.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "group").distinct()
    found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
    last = F.floor((F.greatest(F.octet_length("bytes"), F.lit(1)) - 1) / COMPARE_CHUNK).cast("int")
    chunks = found.select("group", "bytes", F.explode(F.sequence(F.lit(0), last)).alias("number")).select(
        "group",
        "number",
        F.substring("bytes", F.col("number") * COMPARE_CHUNK + 1, F.lit(COMPARE_CHUNK)).alias("chunk"),
    )
    return (
        chunks.groupBy("group", "number", "chunk")
        .agg(F.lit(1).alias("one"))
        .groupBy("group", "number")
        .agg(F.sum("one").alias("texts"))
        .filter("texts > 1")
        .select("group")
        .distinct()
    )


def sizes_of(marks: DataFrame) -> DataFrame:
    """Who stays in each group, and its rows; written, so that the join on it can split a hot group."""
    return cut(
        marks.groupBy("group").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "dedup-groups",
    )


def mark_duplicates(docs: DataFrame, points=POINTS, prime: int = PRIME) -> DataFrame:
    """``doc_id, text_hash, text_sha256, keep_id, group_size, kept`` for every row."""
    text = F.coalesce("text", F.lit(""))
    marks = cut(
        docs.select(
            "doc_id",
            F.xxhash64(text).alias("text_hash"),
            fingerprint(F.col("text"), points, prime).alias("fp"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        ).select(
            "doc_id",
            "text_hash",
            "text_sha256",
            F.struct("fp.fp_a", "fp.fp_b", "n_bytes", F.lit("").alias("split")).alias("group"),
        ),
        "dedup-marks",
    )
    groups = sizes_of(marks)
    several = groups.filter("group_size > 1").select("group")
    differing = cut(differing_groups(docs, marks.join(several, "group", "left_semi")), "dedup-differing")
    if not differing.isEmpty():
        flagged = marks.join(differing.withColumn("differs", F.lit(True)), "group", "left")
        split = F.when(F.col("differs"), F.col("text_sha256")).otherwise(F.lit(""))
        group = F.struct("group.fp_a", "group.fp_b", "group.n_bytes", split.alias("split"))
        marks = cut(flagged.select("doc_id", "text_hash", "text_sha256", group.alias("group")), "dedup-marks")
        groups = sizes_of(marks)
    return marks.join(groups, "group").select(
        "doc_id",
        "text_hash",
        "text_sha256",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def rows_named(docs: DataFrame, names: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``doc_id, text_hash`` of ``names``, all columns.

    Rows that repeat both are reduced by a minimum, which is taken before the shuffle.
    """
    wanted = names.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    wanted = wanted.groupBy("id", "hash").agg(F.lit(1).alias("one"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text_hash = F.xxhash64(F.coalesce("row.text", F.lit("")))
    slim = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    counts = slim.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    repeats = cut(counts.filter("rows > 1").select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h")), "repeats")
    found = whole.withColumn("text_hash", text_hash).join(
        wanted, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    )
    if repeats.isEmpty():
        return found.select("row.*")
    marked = found.join(repeats, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h")), "left")
    once = marked.filter("h is null").select("row")
    repeated = marked.filter("h is not null").groupBy("id", "hash")
    return once.unionByName(repeated.agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")).select("row.*")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns, one row for each different text."""
    return rows_named(docs, mark_duplicates(docs).filter("kept"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: which of its equals stays, how many they are, and the SHA-256 of its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mark_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""
