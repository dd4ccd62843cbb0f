"""Packing documents by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are powers of two: as many of the longest as fit,
then the binary digits of the rest. Each piece is a sequence of its own in the bucket of its length, so no
sequence crosses documents, none is padded, and batches of one bucket have one shape. Cutting needs nothing
but the document itself: no shuffle, no state, and a hot source or a group of copies is like any other.

Defined cases: a null or empty text is its end token alone, one piece of length 1; very long texts are
encoded whole, one at a time; repeated rows and null doc_ids get sequences of their own; an empty table
gives no pieces; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import small_batches, strings
from curbline.llm.tokens import part_encoder

LONGEST = 2048
END_ID = 1
#: Bytes of text that are encoded at a time, or one longer text.
BATCH_BYTES = 4_000_000

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"


def vocabulary() -> str:
    """The default vocabulary file, wherever the tokenizer package is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """Lengths of a document's pieces, longest first."""
    rest = [1 << digit for digit in reversed(range(longest.bit_length() - 1)) if tokens % longest >> digit & 1]
    return [longest] * (tokens // longest) + rest


def decompose(
    docs: DataFrame, tokenizer_path: str | None = None, longest: int = LONGEST, end_id: int = END_ID
) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens``, a row per piece; ids are little-endian 32-bit numbers.

    ``longest`` must be a power of two.
    """
    if longest < 1 or longest & longest - 1:
        raise ValueError("the longest piece must be a power of two")
    path = tokenizer_path or vocabulary()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(path)
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH_BYTES):
                ids, ends = encoder.encode(strings(batch["text"]))
                rows, starts, lengths, pieces, totals = [], [], [], [], []
                first = 0
                for row, end in enumerate(ends.tolist()):
                    own = np.append(ids[first:end], np.uint32(end_id)).astype("<u4").tobytes()
                    first, start = end, 0
                    cuts = piece_lengths(len(own) // 4, longest)
                    for length in cuts:
                        starts.append(start)
                        lengths.append(length)
                        pieces.append(own[4 * start : 4 * (start + length)])
                        start += length
                    rows += [row] * len(cuts)
                    totals += [len(own) // 4] * len(cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(pa.array(rows, pa.int64())),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(pieces, pa.binary()),
                        pa.array(totals, pa.int64()),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut_up, PIECES)


def pack(
    docs: DataFrame, tokenizer_path: str | None = None, longest: int = LONGEST, end_id: int = END_ID
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: a sequence is one piece, so each offset is 0.

    Ids of sequences are unique, not gapless, and need no count over all partitions.
    """
    return decompose(docs, tokenizer_path, longest, end_id).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences in a folder per bucket; a batch reader picks one length at a time.

    The rebalance gathers a bucket in few files and splits the large ones.
    """
    packed.hint("rebalance", "length").write.partitionBy("length").parquet(path)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    """Per piece of a document: where it starts, its length, the checksum of its ids, and its sequence."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
