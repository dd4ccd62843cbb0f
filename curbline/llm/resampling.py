"""Importance resampling towards a target distribution by hashed n-grams, their CRCs taken from prefixes.

A document is normalised to its words with one separator between them and scanned once: the running CRC-32 is
kept at both ends of every word (a separator stands before each). The CRC of any run of words follows from two of them: shifting the
earlier one by the run's bytes, a linear map over GF(2), and adding it cancels the common prefix. A shift by any number of
bytes is made of shifts by powers of two, each four table look-ups. The CRC modulo ``buckets`` names the
bucket of an n-gram, and the scan writes the buckets of each document, from which both counts and weights are worked out.

A bucket's gain is the log ratio of its smoothed shares in the target and in the corpus, a document's weight the sum over
its n-grams. Gumbel noise by the hash of the id turns the highest scores into a draw without replacement. Places come
from ranges of the scores and prefix sums of their sizes, so no task holds all documents.

Defined cases: a null or empty text, or one without words, has no n-gram, weight 0, and is not drawn; a null doc_id hashes as
an empty one and comes last among ties; rows that repeat a doc_id are scored one by one and tie by their n-grams; equal rows share what they
get in any order; an empty target or corpus counts 0 in every bucket; an empty table gives an empty result. Columns beyond ``doc_id`` and
``text`` are not read, so their names cannot clash. A long text is a row of its own batch, with four bytes a byte of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from curbline.llm.common import cut, release, small_batches, strings, table
from curbline.operators.places import with_place

#: Fixed values of the contract: words in a run, buckets, scale of gains and scores, words that a drawn
#: document has at least, share drawn in hundredths, and the seed of the noise.
LONGEST = 1
BUCKETS = 10_000
SCALE = 1000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

#: Texts that are scanned at a time, in bytes.
BATCH_BYTES = 4 << 20
#: The reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

#: Small letters, digits and bytes beyond ASCII stay, capitals become small, all else separates.
NORMAL = bytes(
    code + 32 if 65 <= code <= 90 else code if code >= 128 or chr(code).isdigit() or 97 <= code <= 122 else 32
    for code in range(256)
)


def byte_table() -> np.ndarray:
    """What a byte that leaves a CRC register adds to it."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(POLYNOMIAL), register >> 1).astype(np.uint32)
    return register


STEP = byte_table()


def shift_tables(doublings: int) -> list[np.ndarray]:
    """Tables [4, 256] of the shifts by 1, 2, 4, ... zero bytes: each is the one before it applied twice."""
    columns = np.arange(256, dtype=np.uint32)
    one = np.stack([columns << np.uint32(8 * place) for place in range(4)])
    tables = [(one >> np.uint32(8)) ^ STEP[one & 255]]
    while len(tables) < doublings:
        tables.append(apply_shift(tables[-1], tables[-1]))
    return tables


def apply_shift(tables: np.ndarray, registers: np.ndarray) -> np.ndarray:
    """Registers after the zero bytes that ``tables`` stand for; linear, so a table per byte and a sum."""
    out = tables[0][registers & 255]
    for place in range(1, 4):
        out = out ^ tables[place][(registers >> np.uint32(8 * place)) & 255]
    return out


SHIFTS = shift_tables(31)
#: Shifts by fewer bytes than this have tables of their own.
SHORT_BITS = 6


def short_tables() -> np.ndarray:
    """Tables [4, bytes, 256] of the shifts by 0, 1, 2, ... zero bytes."""
    columns = np.arange(256, dtype=np.uint32)
    tables = [np.stack([columns << np.uint32(8 * place) for place in range(4)])]
    while len(tables) < 1 << SHORT_BITS:
        tables.append(apply_shift(SHIFTS[0], tables[-1]))
    return np.stack(tables, axis=1)


SHORT = short_tables()


def shifted(registers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each register after as many zero bytes as its length says: the low bits in one look-up, the others doubled."""
    low = lengths & ((1 << SHORT_BITS) - 1)
    out = SHORT[0, low, registers & 255]
    for place in range(1, 4):
        out ^= SHORT[place, low, (registers >> np.uint32(8 * place)) & 255]
    for power in range(SHORT_BITS, int(lengths.max(initial=0)).bit_length()):
        far = np.flatnonzero(lengths >> power & 1)
        out[far] = apply_shift(SHIFTS[power], out[far])
    return out


def prefix_crcs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word its length in bytes, and the CRC of the normalised text up to its start and to its end."""
    crc32 = zlib.crc32
    crc = 0
    running = [crc := crc32(word, crc32(b" ", crc)) for word in words]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.array(running, np.uint32)
    # A start is the end before it and the separator: one step of the register, which CRC-32 keeps inverted.
    inverted = ~np.concatenate([np.zeros(1, np.uint32), ends[:-1]])
    starts = ~((inverted >> np.uint32(8)) ^ STEP[(inverted ^ np.uint32(32)) & 255])
    return lengths, starts, ends


def run_crcs(text: str, longest: int) -> tuple[np.ndarray, int]:
    """CRCs of all runs of 1 to ``longest`` words joined by one space, by length of the run and place; number of words."""
    words = text.encode().translate(NORMAL).split()
    if not words:
        return np.zeros(0, np.uint32), 0
    lengths, starts, ends = prefix_crcs(words)
    sizes = np.cumsum(lengths + 1)
    begins = sizes - lengths - 1
    out = []
    for run in range(1, longest + 1):
        many = len(lengths) - run + 1
        if many > 0:
            span = sizes[run - 1 :] - 1 - begins[:many]
            out.append(ends[run - 1 :] ^ shifted(starts[:many], span))
    return np.concatenate(out), len(words)


SCANNED = "doc_id long, n_words long, grams array<int>"


def scan(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words`` and the buckets of all n-grams, repeats included, of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH_BYTES):
                crcs, words = zip(*(run_crcs(text, longest) for text in strings(batch["text"])), strict=True)
                sizes = np.array([len(each) for each in crcs], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = (np.concatenate(crcs) % np.uint32(buckets)).astype(np.int32)
                grams = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].cast(pa.int64()), pa.array(words, pa.int64()), grams],
                    names=["doc_id", "n_words", "grams"],
                )

    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCANNED)


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: added up inside every partition before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch["grams"].flatten().to_numpy(), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    partial = scanned.select("grams").mapInArrow(count, "bucket int, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    """The gain of every bucket; as many numbers as there are buckets reach the driver, whatever the tables hold."""
    held = np.zeros((2, buckets))
    for side, scanned in enumerate((corpus, target)):
        for row in bucket_counts(scanned, buckets).collect():
            held[side, row["bucket"]] = row["n"]
    (here, there), (all_here, all_there) = held, held.sum(axis=1)
    ratio = ((there + 1) * (all_here + buckets)) / ((here + 1) * (all_there + buckets))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def scored(corpus: DataFrame, by_bucket: np.ndarray, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score``."""

    @arrow_udf("long")
    def weigh(grams: pa.Array) -> pa.Array:
        sums = np.concatenate([[0], np.cumsum(by_bucket[grams.flatten().to_numpy()])])
        edges = np.concatenate([[0], np.cumsum(grams.value_lengths().to_numpy(zero_copy_only=False))])
        return pa.array(sums[edges[1:]] - sums[edges[:-1]])

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(scale)) * F.log(-F.log((digits + 0.5) / F.lit(4294967296.0))))
    weighed = corpus.select("doc_id", "n_words", F.size("grams").cast("long").alias("n_features"), weigh("grams").alias("weight"))
    return weighed.withColumn("score", F.col("weight") + noise)


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every document; ``rank`` is null where it is not drawn.

    ``docs`` has ``doc_id, text``, ``target`` has ``text``. ``percent`` hundredths, rounded down, of the documents with at
    least ``least_words`` words are drawn, the highest scores first.
    """
    corpus = cut(scan(docs, longest, buckets), "resampling-corpus")
    wanted = cut(scan(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets), "resampling-target")
    frame = scored(corpus, gains(corpus, wanted, buckets, scale), scale, seed)
    eligible = F.col("n_words") >= least_words
    drawn = corpus.filter(eligible).count() * percent // 100
    order = (F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"))
    placed = with_place(frame.withColumn("eligible", eligible), *order)
    rank = F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def op11_resampling(spark, sf_dir: str) -> DataFrame:
    """All documents, resampled towards the benchmark's texts."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 is worked out byte by byte from the table of its polynomial, for the distinct words.
OP11_SQL = rf"""
with steps as (
  select list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, {POLYNOMIAL}) else c >> 1 end, n::bigint)) as crc
), held as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), aimed as (
  select regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), here as (
  select word, count(*) as n from (select unnest(words) as word from held) group by word
), there as (
  select word, count(*) as n from (select unnest(words) as word from aimed) group by word
), hexed as (
  select word, hex(encode(word)) as digits from (select word from here union select word from there)
), hashed as (
  select word, xor(list_reduce(list_transform(range(len(digits) // 2),
      lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::bigint),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) % {BUCKETS} as bucket
  from hexed, steps
), counts as (
  select bucket, coalesce(sum(here.n), 0)::double as s, coalesce(sum(there.n), 0)::double as t
  from hashed left join here using (word) left join there using (word) group by bucket
), totals as (
  select sum(s) as s_all, sum(t) as t_all from counts
), gains as (
  select bucket, floor({SCALE} * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS}))))::bigint as gain
  from counts, totals
), weighed as (
  select h.rowid as id, sum(gain)::bigint as weight
  from (select rowid, unnest(words) as word from (select row_number() over () as rowid, words from held)) h
  join hashed using (word) join gains using (bucket) group by h.rowid
), scored as (
  select doc_id, coalesce(len(words), 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-{SCALE} * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint
      + 0.5::double) / 4294967296::double)))::bigint as score
  from (select row_number() over () as rowid, * from held) left join weighed on id = rowid
), ranked as (
  select *, row_number() over (order by n_features < {LEAST_WORDS}, score desc, doc_id nulls last, n_features) as place,
    count(*) filter (where n_features >= {LEAST_WORDS}) over () * {PERCENT} // 100 as drawn
  from scored
)
select doc_id, n_features, weight, score,
  case when n_features >= {LEAST_WORDS} and place <= drawn then place end as rank
from ranked
"""
