"""Exact n-gram Jaccard join: size bands, tiles with bitmap signatures, sorted-array intersection.

1. A text becomes its sorted set of hashed word shingles. Equal sets are one class, whatever their number.
2. Classes stand in bands of set size. Two sets that link differ in at most ``d`` shingles, a bound that the
   sizes of a band fix. Cut the hash range into ``d + 3`` parts: at least three parts are equal, so at least one
   hash over a part is. Classes that share one meet in a bucket. Parts without a shingle say nothing and are left
   out, except by sets with three or more of them, which might share nothing else. A group of near copies is spread
   over as many buckets as its sets have parts; of buckets with the same classes one is kept.
3. In a bucket, bitmaps of the sets (parity of the shingles that fall on a bit) bound the difference from below, and so
   the overlap from above. A bucket emits links that join what the bound lets pass, fewer than it has sets; their
   components are groups of candidates. Large buckets are cut into blocks that meet in pairs.
4. A group is cut into tiles by band and, where it is large, by hash; only tiles whose sizes can link meet. Pairs
   that pass the bitmaps are intersected exactly, and a pair of tiles emits the links that join what was not yet joined.
5. Links between classes give the components.

No step is approximate but for equal 64-bit hashes of different shingles. Nothing is capped: hot buckets and
groups get more blocks and tiles.

Defined cases: a null text or one without words has an empty set and links with nothing; with fewer words than a
shingle the whole sequence is the one shingle; repeated rows and rows that share a doc_id are told apart by their
sets; a null doc_id links as others do but names no component; an empty table gives an empty result; very long
texts are one set; further columns are carried along and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from curbline.llm.common import connected_components, cut, release, small_batches, strings
from curbline.llm.exact_dedup import rows_named

WORDS = 3
#: The similarity in hundredths.
LEAST = 90
#: Ratio of the sizes of neighbouring bands; it must be at least 100 / LEAST.
BAND = 1.5
#: Shingles that a tile holds about, at most, unless one set has more.
TILE_SHINGLES = 4_000_000
#: Classes that a block of a bucket holds about, at most.
BLOCK = 4096
#: Bits of a bitmap for each shingle in which two linked sets may differ, about.
BITS = 4
#: Bytes of text that are worked on at a time.
BATCH_BYTES = 4_000_000

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
STEP = np.uint64(0x9E3779B97F4A7C15)
U64 = np.uint64


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = (values ^ (values >> U64(30))) * MIX[0]
    values = (values ^ (values >> U64(27))) * MIX[1]
    return values ^ (values >> U64(31))


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; A-Z in lower case, words between ASCII white space."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, U64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), U64, len(found))
    width = min(words, len(found))
    total = np.full(len(found) - width + 1, U64(width))
    for place in range(width):
        total = mixed(total * STEP + hashes[place : place + len(total)])
    return np.unique(total)


def bands(largest: int, ratio: float = BAND) -> list[int]:
    """First sizes of the bands, up to one beyond ``largest``."""
    first = [1]
    while first[-1] <= largest:
        first.append(max(first[-1] + 1, int(first[-1] * ratio)))
    return first


#: Bands up to sets of 2**40 shingles.
STARTS = np.array(bands(2**40), np.int64)


def band_of(size: int) -> int:
    return int(np.searchsorted(STARTS, size, "right")) - 1


def most_difference(total: int, least: int = LEAST) -> int:
    """Most shingles in which two linked sets can differ whose sizes add up to ``total``."""
    return total * (100 - least) // (100 + least)


def reaches(size: int, band: int, least: int = LEAST) -> bool:
    """Whether a set can link with one of the next band."""
    return size * 100 >= least * int(STARTS[band + 1])


def part_hashes(shingles: np.ndarray, least: int = LEAST) -> np.ndarray:
    """The hashes by which a set meets those it may link with, in its band and from the next."""
    size = len(shingles)
    own = band_of(size)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(shingles ^ STEP), dtype=U64)])
    out = []
    for band in (own, own + 1) if reaches(size, own, least) else (own,):
        differ = most_difference(2 * (int(STARTS[band + 1]) - 1), least)
        if not differ:
            continue  # sets this small link only when equal
        parts = differ + 3
        borders = np.array([(k << 64) // parts for k in range(1, parts)], U64)
        ends = np.concatenate([[0], np.searchsorted(shingles, borders), [size]])
        sizes = np.diff(ends)
        number = U64(band << 40) + np.arange(parts, dtype=U64)
        hashes = mixed(mixed(sums[ends[1:]] - sums[ends[:-1]]) + number * STEP)
        out.append(hashes if np.count_nonzero(sizes == 0) >= 3 else hashes[sizes > 0])
    return np.concatenate(out) if out else np.zeros(0, U64)


def sketch(text: F.Column, words: int = WORDS, least: int = LEAST) -> F.Column:
    """``struct<n, a, b, bits, parts>``: size, digest and bitmap of a text's set, and its part hashes."""

    @arrow_udf("struct<n: long, a: long, b: long, bits: binary, parts: array<long>>")
    def sketched(column: pa.Array) -> pa.Array:
        release()
        sizes, firsts, seconds, maps, hashes = [], [], [], [], []
        for value in column:
            found = shingle_set(value.as_py() or "", words)
            sizes.append(len(found))
            firsts.append(mixed(found).sum(dtype=U64))
            seconds.append(mixed(found ^ MIX[0]).sum(dtype=U64))
            maps.append(parity(found, bits_for(len(found), least)).tobytes())
            hashes.append(part_hashes(found, least) if len(found) else np.zeros(0, U64))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in hashes])]).astype(np.int32)
        flat = np.concatenate([*hashes, np.zeros(0, U64)]).view(np.int64)
        columns = [
            pa.array(sizes, pa.int64()),
            pa.array(np.array(firsts, U64).view(np.int64)),
            pa.array(np.array(seconds, U64).view(np.int64)),
            pa.array(maps, pa.binary()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
        ]
        return pa.StructArray.from_arrays(columns, ["n", "a", "b", "bits", "parts"])

    return sketched(text)


def parity(own: np.ndarray, bits: int) -> np.ndarray:
    """A set's bitmap in 64-bit words: each bit is the parity of the shingles that fall on it.

    Halving ``bits`` folds the bitmap: its halves are added by exclusive or.
    """
    out = np.zeros(bits // 64, U64)
    place = mixed(own * STEP) & U64(bits - 1)
    np.bitwise_xor.at(out, place >> U64(6), U64(1) << (place & U64(63)))
    return out


def bits_for(size: int, least: int = LEAST) -> int:
    """Length of the bitmap of a set, a power of two."""
    return max(64, min(1 << 17, 1 << (BITS * most_difference(2 * size, least)).bit_length()))


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of several lengths as rows of the shortest."""
    words = min(map(len, maps))
    return np.stack([np.bitwise_xor.reduce(own.reshape(-1, words), axis=0) for own in maps])


def bitmaps(sets: list[np.ndarray], least: int = LEAST) -> np.ndarray:
    """A bitmap for each set, all of one length."""
    bits = bits_for(max(map(len, sets)), least)
    return np.stack([parity(own, bits) for own in sets])


def linked(one: np.ndarray, other: np.ndarray, least: int = LEAST) -> bool:
    """Whether two sorted sets reach the similarity, in whole numbers."""
    small, large = (one, other) if len(one) < len(other) else (other, one)
    place = np.searchsorted(large, small)
    place[place == len(large)] = 0
    both = int(np.count_nonzero(large[place] == small))
    return 100 * both >= least * (len(one) + len(other) - both)


def forest(
    size: np.ndarray, maps: np.ndarray, sides: np.ndarray, least: int = LEAST, check: Callable | None = None
) -> list[tuple[int, int]]:
    """Pairs that join all whose bitmaps let them link, and who pass ``check``; within, or across, two sides."""
    label = np.arange(len(size))
    across = len(np.unique(sides)) > 1
    out = []
    for one in range(len(size) - 1):
        rest = slice(one + 1, None)
        near = label[rest] != label[one]
        near &= 100 * np.minimum(size[rest], size[one]) >= least * np.maximum(size[rest], size[one])
        if across:
            near &= sides[rest] != sides[one]
        others = np.flatnonzero(near) + one + 1
        differ = np.bitwise_count(maps[others] ^ maps[one]).sum(axis=1, dtype=np.int64)
        others = others[differ <= most_difference(size[others] + size[one], least)]
        for other in others.tolist():
            if label[other] != label[one] and (check is None or check(one, other)):
                label[label == label[other]] = label[one]
                out.append((one, other))
    return out


def tile_links(sets: list[np.ndarray], sides: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Links that join the sets of a tile, or those of one side with the other's."""
    size = np.array([len(x) for x in sets], np.int64)
    return forest(size, bitmaps(sets, least), sides, least, lambda a, b: linked(sets[a], sets[b], least))


def pairs_of(found: list[tuple[int, int]], names: np.ndarray) -> pa.RecordBatch:
    ends = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(names[ends[:, 0]]), pa.array(names[ends[:, 1]])], ["a", "b"])


def bucket_links(met: DataFrame, sizes: DataFrame, least: int = LEAST) -> DataFrame:
    """``a, b``: links by bitmap among the classes of each bucket.

    ``met`` has ``part, cls`` of buckets with several classes, ``sizes`` has ``cls, n, bits``.
    """
    buckets = met.groupBy("part").agg(
        F.count("*").alias("rows"),
        F.bit_xor(F.xxhash64("cls")).alias("x"),
        F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"),
    )
    once = cut(buckets.groupBy("rows", "x", "y").agg(F.min("part").alias("part")), "jaccard-buckets")
    cuts = F.ceil(F.col("rows") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), cuts).cast("int")
    spread = met.join(once.select("part", "rows"), "part").withColumn("own", own)
    spread = spread.withColumn("j", F.explode(F.sequence(F.lit(0), cuts - 1)))
    keyed = spread.select(
        F.struct("part", F.least("own", "j").alias("i"), F.greatest("own", "j").alias("j")).alias("key"),
        (F.col("own") > F.col("j")).alias("side"),
        "cls",
    )
    rows = keyed.join(sizes, "cls").select("key.*", "side", "cls", "n", "bits")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            if whole.num_rows < 2:
                return
            maps = folded([np.frombuffer(bits, U64) for bits in whole["bits"].to_pylist()])
            size, side = whole["n"].to_numpy(), whole["side"].to_numpy()
            found = forest(size, maps, side, least)
            if found:
                yield pairs_of(found, whole["cls"].to_numpy())

        last = None
        for batch in batches:
            keys = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("part", "i", "j")], axis=1)
            borders = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            for start, end in zip([0, *borders], [*borders, len(keys)], strict=True):
                if start == end:
                    continue
                key = keys[start].tolist()
                if held and key != last:
                    yield from flush()
                held.append(batch.slice(start, end - start))
                last = key
        if held:
            yield from flush()

    dealt = rows.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")
    return dealt.mapInArrow(compare, "a long, b long")


def candidate_groups(classes: DataFrame, parts: DataFrame, sizes: DataFrame, least: int = LEAST) -> DataFrame:
    """``cls, n, doc_id, text_hash, grp`` of the classes that may link with another."""
    same = Window.partitionBy("part")
    ends = parts.withColumn("low", F.min("cls").over(same)).withColumn("high", F.max("cls").over(same))
    met = cut(ends.filter("low < high").select("part", "cls"), "jaccard-met")
    edges = cut(bucket_links(met, sizes, least), "jaccard-edges")
    groups = connected_components(edges, "jaccard")
    return cut(
        classes.join(groups, classes["cls"] == groups["node"]).select(
            "cls", "n", "doc_id", "text_hash", F.col("component").alias("grp")
        ),
        "jaccard-candidates",
    )


def band_column(n: F.Column) -> F.Column:
    """The band of a size; the starts are few, so they are looked up in a literal."""
    starts = F.array(*[F.lit(int(start)) for start in STARTS])
    return (F.aggregate(starts, F.lit(-1), lambda found, start: found + (start <= n).cast("int"))).cast("int")


def tiles(candidates: DataFrame, least: int = LEAST, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """``cls, doc_id, text_hash, tile, side`` with a row for each pair of tiles that a class is in."""
    banded = candidates.withColumn("band", band_column(F.col("n")))
    sizes = banded.groupBy("grp", "band").agg(
        F.ceil(F.sum("n") / tile_shingles).cast("int").alias("cuts"), F.count("*").alias("rows")
    )
    lower = sizes.select("grp", (F.col("band") + 1).alias("band"), F.col("cuts").alias("lower_cuts"))
    upper = sizes.select("grp", (F.col("band") - 1).alias("band"), F.col("cuts").alias("upper_cuts"))
    known = sizes.join(lower, ["grp", "band"], "left").join(upper, ["grp", "band"], "left")
    starts = F.array(*[F.lit(int(start)) for start in STARTS])
    start = F.element_at(starts, F.col("band") + 1)
    after = F.element_at(starts, F.col("band") + 2)
    own = F.pmod(F.xxhash64("cls"), F.col("cuts")).cast("int")

    def meets(low_band: F.Column, cuts: F.Column, key, wanted: F.Column) -> F.Column:
        each = F.transform(F.sequence(F.lit(0), cuts - 1), key)
        return F.when(wanted, each).otherwise(F.array().cast(KEYS))

    def key(low: F.Column, high: F.Column, i: F.Column, j: F.Column, side: F.Column) -> F.Column:
        return F.struct(
            low.alias("low"), high.alias("high"), i.cast("int").alias("i"), j.cast("int").alias("j"), side.alias("side")
        )

    band = F.col("band")
    within = meets(
        band,
        F.col("cuts"),
        lambda j: key(band, band, F.least(own, j), F.greatest(own, j), (own > j).cast("int")),
        (F.col("rows") > 1),
    )
    up = meets(
        band,
        F.coalesce("upper_cuts", F.lit(1)),
        lambda j: key(band, band + 1, own, j, F.lit(0)),
        F.col("upper_cuts").isNotNull() & (F.col("n") * 100 >= least * after),
    )
    down = meets(
        band,
        F.coalesce("lower_cuts", F.lit(1)),
        lambda j: key(band - 1, band, j, own, F.lit(1)),
        F.col("lower_cuts").isNotNull() & (F.col("n") * least <= 100 * (start - 1)),
    )
    spread = banded.join(known, ["grp", "band"]).withColumn("key", F.explode(F.concat(within, up, down)))
    return spread.select(
        "cls",
        "doc_id",
        "text_hash",
        F.struct("grp", "key.low", "key.high", "key.i", "key.j").alias("tile"),
        F.col("key.side").alias("side"),
    )


KEYS = "array<struct<low: int, high: int, i: int, j: int, side: int>>"


def links_in_tiles(docs: DataFrame, spread: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """``a, b`` of classes that link, found in each pair of tiles; texts are read for the classes in tiles only."""
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("id", "text", F.xxhash64("text").alias("hash"))
    wanted = spread.join(
        texts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    ).select(F.xxhash64("tile").alias("place"), F.to_json("tile").alias("tile"), "side", "cls", "text")

    def emit(rows: dict) -> Iterator[pa.RecordBatch]:
        order = sorted(rows.values(), key=lambda row: (len(row[2]), row[0]))
        found = tile_links([row[2] for row in order], np.array([row[1] for row in order]), least)
        if found:
            yield pairs_of(found, np.array([row[0] for row in order], np.int64))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, {}
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH_BYTES):
                columns = (batch[name].to_pylist() for name in ("tile", "side", "cls"))
                for name, side, cls, text in zip(*columns, strings(batch["text"]), strict=True):
                    if name != tile:
                        if len(rows) > 1:
                            yield from emit(rows)
                        tile, rows = name, {}
                    if cls not in rows:
                        rows[cls] = (cls, side, shingle_set(text, words))
        if len(rows) > 1:
            yield from emit(rows)

    sorted_rows = wanted.repartition("place").sortWithinPartitions("place", "tile")
    return sorted_rows.select("tile", "side", "cls", "text").mapInArrow(compare, "a long, b long")


def mark_groups(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """``doc_id, text_hash, n, component_id`` for every row; ``grp`` is a number of the component."""
    text = F.coalesce("text", F.lit(""))
    marks = cut(
        docs.select("doc_id", F.xxhash64(text).alias("text_hash"), sketch(F.col("text"), words, least).alias("s"))
        .select("doc_id", "text_hash", "s.*")
        .withColumn("row", F.monotonically_increasing_id()),
        "jaccard-sets",
    )
    classes = cut(
        marks.filter("n > 0")
        .groupBy("n", "a", "b")
        .agg(F.min("row").alias("cls"), F.min("doc_id").alias("least_id"), F.min_by("doc_id", "row").alias("doc_id"),
             F.min_by("text_hash", "row").alias("text_hash")),
        "jaccard-classes",
    )
    parts = (
        marks.filter(F.size("parts") > 0)
        .select("row", "parts")
        .join(classes.select("cls"), F.col("row") == F.col("cls"))
        .select("cls", F.explode("parts").alias("part"))
    )
    candidates = candidate_groups(classes, parts, marks.select(F.col("row").alias("cls"), "n", "bits"), least)
    links = cut(links_in_tiles(docs, tiles(candidates, least), words, least), "jaccard-found")
    components = connected_components(links, "jaccard-links")
    joined = classes.join(components, F.col("cls") == F.col("node"), "left").select(
        "n", "a", "b", "least_id", F.coalesce("component", "cls").alias("grp")
    )
    named = cut(joined, "jaccard-joined")
    lowest = named.groupBy("grp").agg(F.min("least_id").alias("component_id"))
    of_class = cut(named.join(lowest, "grp").select("n", "a", "b", "grp", "component_id"), "jaccard-named")
    full = marks.filter("n > 0").select("doc_id", "text_hash", "n", "a", "b").join(of_class, ["n", "a", "b"])
    empty = marks.filter("n = 0").select(
        "doc_id", "text_hash", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("grp")
    )
    return full.select("doc_id", "text_hash", "n", "component_id", "grp").unionByName(empty)


def keep_one(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """The documents with one of each component, that with the smallest doc_id; empty ones all stay."""
    marks = mark_groups(docs, words, least)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    kept = marks.filter("grp is not null").groupBy("grp").agg(first).select("first.doc_id", "first.text_hash")
    empty = docs.filter(F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) == 0)
    return rows_named(docs, kept).unionByName(empty)


def op9_jaccard(spark, sf_dir: str) -> DataFrame:
    """Per document: the size of its shingle set and the component of documents that it links with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mark_groups(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


OP9_SQL = r"""
with recursive split as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
), sets as (
  select distinct doc_id, unnest(case when len(w) = 0 then []
    when len(w) < 3 then [array_to_string(w, ' ')]
    else [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] end) as s
  from split
), sizes as (
  select d.doc_id, count(s)::bigint as n from documents d left join sets using (doc_id) group by d.doc_id
), pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as shared
  from sets x join sets y on x.s = y.s and x.doc_id <> y.doc_id group by all
), links as (
  select a, b from pairs join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * shared >= 90 * (p.n + q.n - shared)
), reach(a, b) as (
  select doc_id, doc_id from documents
  union
  select reach.a, links.b from reach join links on reach.b = links.a
)
select doc_id, n as n_shingles, min(b) as component_id
from sizes join reach on a = doc_id group by doc_id, n
"""
