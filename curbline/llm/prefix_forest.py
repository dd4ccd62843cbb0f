"""Approximate nearest neighbours by cosine in a forest of hash prefixes.

Each of ``TREES`` trees gives a vector a string of 64 bits, its sides of random orthogonal planes, and keeps all strings as sorted
arrays. An array holds the strings of one prefix, as long as it must be for at most ``ARRAY_ROWS`` of them, so dense
regions lie in deep arrays. A query descends to its longest match in every tree; from there all trees ascend together, a bit
at a time, and what shares that many bits with the query in any tree is a candidate, until the candidates suffice. Inside an array
that is a range found by bisection; above it, whole arrays. Candidates travel as places, in blocks, to the vectors, where their
cosines are measured in double precision.

How many candidates suffice is fitted: for a bounded sample of ``AUDITED`` queries the nearest vectors are found by comparison
with all, and the ascent stops at the least number of candidates that finds ``RECALL`` of them. The result carries that recall. Every
vector is indexed and every query answered alike; a group of equal vectors is one node, of which no more copies than can be returned
are listed. A level is taken whole: near copies that share all 64 bits of a query's string are all candidates.

Defined cases: rows whose vec_id or vector is null, whose vector is empty, zero, or holds a null or non-finite component take no part; of rows that
share a vec_id the one with the smallest vector does. A shorter vector counts as padded by zeros. Ties of a cosine go to the smaller
vec_id; equal vectors tie exactly. Fewer other rows than wanted are all returned; without any there is no row. An empty
table gives an empty result. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from curbline.llm.common import cut, held, release, table

#: Fixed values of the contract.
NEAREST = 5
QUERY_EVERY = 50

TREES = 48
BITS = 64
#: Strings of a sorted array at most, and bits by which the prefix of a fuller one grows at a time.
ARRAY_ROWS = 4096
DEEPER = 6
#: Queries that the stop is fitted on, at most, and the share of their nearest that must be found.
AUDITED = 256
RECALL = 0.96
#: Vectors of a block: at most, and where a table is small.
BLOCK_ROWS = 32_768
SMALL_BLOCK = 2048
#: A place is a block and a slot in it, two bytes.
SLOT_BITS = 16
#: Queries of an array whose candidates are listed at once.
ASKED_AT_ONCE = 64
SEED = 12

BUCKET = ("tree", "depth", "prefix", "chunk")


def finite_rows(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles of one width, each scaled by a power of two so that squares cannot overflow."""
    column = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    _, exponents = np.frexp(np.abs(out).max(axis=1, initial=0))
    return np.ldexp(out, -exponents[:, None])


def planes(width: int, tree: int, seed: int = SEED) -> np.ndarray:
    """Normals [width, BITS], orthogonal as far as the width allows."""
    rng = np.random.default_rng([seed, tree, width])
    sets = []
    while sum(part.shape[1] for part in sets) < BITS:
        normals, _ = np.linalg.qr(rng.standard_normal((width, min(width, BITS))))
        sets.append(normals)
    return np.concatenate(sets, axis=1)[:, :BITS]


def strings_of(vectors: np.ndarray, trees: int, seed: int = SEED) -> np.ndarray:
    """Hash strings [rows, trees], the first plane's side in the highest bit."""
    width = vectors.shape[1]
    normals = held("planes", f"{seed}/{trees}/{width}", lambda: [planes(width, tree, seed) for tree in range(trees)])
    out = np.empty((len(vectors), trees), np.uint64)
    for tree in range(trees):
        sides = np.packbits(vectors @ normals[tree] > 0, axis=1)
        out[:, tree] = np.ascontiguousarray(sides).view(">u8")[:, 0]
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, one for each id."""
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.filter(
        F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)) & F.exists("embedding", lambda v: v != 0)
    )
    typed = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return typed.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nodes_of(rows: DataFrame, asked: Column, copies: int) -> DataFrame:
    """``block, slot, place, node, ids, vector, asked``: equal vectors once, with their ``copies`` smallest ids.

    The window's limit is applied before the shuffle too, so a hot vector sends few rows.
    """
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("copy", F.row_number().over(order)).filter(F.col("copy") <= copies)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    searched = rows.filter(asked).select(F.col("vector").alias("own"), F.lit(True).alias("asked")).distinct()
    nodes = cut(
        grouped.join(searched, F.col("vector") == F.col("own"), "left").select(
            F.col("ids")[0].alias("node"), "ids", "vector", F.coalesce("asked", F.lit(False)).alias("asked")
        ),
        "forest-groups",
    )
    many = nodes.count()
    blocks = max(1, -(-many // BLOCK_ROWS), min(16, -(-many // SMALL_BLOCK)))
    # Blocks fill evenly by hash, far below the slots that two bytes can name.
    dealt = nodes.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int"))
    slot = F.row_number().over(Window.partitionBy("block").orderBy("node")) - 1
    placed = dealt.withColumn("slot", slot)
    place = F.shiftleft(F.col("block").cast("long"), SLOT_BITS) + F.col("slot")
    return cut(placed.withColumn("place", place), "forest-nodes")


def entries_of(nodes: DataFrame, width: int, trees: int, seed: int) -> DataFrame:
    """``tree, hash, place, asked``: a string of every node in every tree."""

    @arrow_udf("array<long>")
    def hashes(vectors: pa.Array) -> pa.Array:
        strings = strings_of(finite_rows(vectors, width), trees, seed).view(np.int64)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(len(strings) + 1, dtype=np.int32) * trees), pa.array(strings.ravel())
        )

    exploded = nodes.select("place", "asked", F.posexplode(hashes("vector")).alias("tree", "hash"))
    return exploded.select("tree", "hash", "place", "asked")


def prefix_of(depth: Column | int) -> Column:
    """The first ``depth`` bits of ``hash``; a shift by all 64 is none, so no bits are a case of its own."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    shifted = F.call_function("shiftrightunsigned", F.col("hash"), (F.lit(BITS) - depth).cast("int"))
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(shifted)


def sorted_arrays(entries: DataFrame, many: int, array_rows: int = ARRAY_ROWS) -> DataFrame:
    """``tree, depth, prefix, chunk, total`` and the sorted ``entries`` (hash, place, asked) of each array.

    Prefixes start at the length that leaves arrays of some half the rows allowed, and grow only where one holds more; strings
    equal in all bits are dealt over chunks.
    """
    depth = min(BITS, max(1, int(np.ceil(np.log2(max(1, 2 * many / array_rows))))))
    parts: list[DataFrame] = []
    open_ = cut(entries, "forest-entries")
    while True:
        named = open_.withColumn("prefix", prefix_of(depth))
        sizes = named.groupBy("tree", "prefix").agg(F.count("*").alias("total"))
        hot = cut(sizes.filter(F.col("total") > array_rows), "forest-hot")
        last = depth == BITS or hot.isEmpty()
        if last:
            chunks = F.ceil(F.coalesce("total", F.lit(1)) / array_rows)
            chunk = F.pmod(F.xxhash64("place"), chunks).cast("int")
            done = named.join(hot, ["tree", "prefix"], "left").withColumn("chunk", chunk).drop("total")
        else:
            done = named.join(hot, ["tree", "prefix"], "left_anti").withColumn("chunk", F.lit(0))
        parts.append(done.withColumn("depth", F.lit(depth)))
        if last:
            break
        open_ = cut(named.join(hot.drop("total"), ["tree", "prefix"]).drop("prefix"), "forest-open")
        depth = min(BITS, depth + DEEPER)
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    arrays = together.groupBy(*BUCKET).agg(F.sort_array(F.collect_list(F.struct("hash", "place", "asked"))).alias("entries"))
    return cut(arrays, "forest-arrays")


def above_arrays(arrays: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every level above each array (``tree, level, up`` and its name), and ``name, total, above``: rows below its prefixes."""
    sized = arrays.select(*BUCKET, F.size("entries").cast("long").alias("rows"))
    levels = sized.withColumn("level", F.explode(F.sequence(F.lit(0), F.col("depth"))))
    up = F.when(F.col("level") == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", F.col("prefix"), (F.col("depth") - F.col("level")).cast("int"))
    )
    ancestors = cut(levels.withColumn("up", up), "forest-ancestors")
    sums = ancestors.groupBy("tree", "level", "up").agg(F.sum("rows").alias("below"))
    joined = ancestors.join(sums, ["tree", "level", "up"])
    above = joined.groupBy(*BUCKET).agg(F.sort_array(F.collect_list(F.struct("level", "below"))).alias("above"))
    return ancestors.drop("rows"), above.select(*BUCKET, F.col("above.below").alias("above"))


def common_bits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Leading bits that two strings share."""
    differ = left ^ right
    out = np.full(differ.shape, BITS, np.int64)
    rest = differ.copy()
    length = np.zeros(differ.shape, np.int64)
    for power in (32, 16, 8, 4, 2, 1):
        high = rest >> np.uint64(power)
        length += np.where(high > 0, power, 0)
        rest = np.where(high > 0, high, rest)
    return np.where(differ > 0, BITS - 1 - length, out)


def range_at(strings: np.ndarray, own: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings that share ``level`` bits with ``own`` begin and end."""
    keep = np.where(level > 0, ~np.uint64(0) << (np.uint64(BITS) - np.maximum(level, 1).astype(np.uint64)), np.uint64(0))
    low = own & keep
    high = low | ~keep
    return np.searchsorted(strings, low, "left"), np.searchsorted(strings, high, "right")


def matches_by_level(arrays: DataFrame, above: DataFrame) -> DataFrame:
    """``query, level, rows``: how many strings share exactly so many bits with each query's, over all trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            below = batch["above"].to_pylist()
            for row in range(batch.num_rows):
                entries = batch["entries"][row].values
                strings = entries.field("hash").to_numpy().view(np.uint64)
                places = entries.field("place").to_numpy()
                asked = np.flatnonzero(entries.field("asked").to_numpy(zero_copy_only=False))
                if not len(asked):
                    continue
                depth = len(below[row]) - 1
                levels = np.arange(depth + 1, BITS + 1)
                counts = np.empty((len(asked), BITS + 2), np.int64)
                counts[:, : depth + 1] = below[row]
                counts[:, BITS + 1] = 0
                for level in levels.tolist():
                    first, end = range_at(strings, strings[asked], np.full(len(asked), level))
                    counts[:, level] = end - first
                exact = counts[:, :-1] - counts[:, 1:]
                query, level = np.nonzero(exact)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places[asked][query]), pa.array(level.astype(np.int32)), pa.array(exact[query, level])],
                    names=["query", "level", "rows"],
                )

    joined = arrays.join(above, list(BUCKET)).select("entries", "above")
    found = joined.mapInArrow(run, "query long, level int, rows long")
    return found.groupBy("query", "level").agg(F.sum("rows").alias("rows"))


def nearest_of_sample(nodes: DataFrame, width: int, wanted: int, seed: int) -> list:
    """For at most ``AUDITED`` queries: place, vector, and the nearest others among all nodes, with their vectors."""
    chosen = nodes.filter("asked").orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(AUDITED)
    sample = chosen.select("place", "vector").toArrow()
    if not sample.num_rows:
        return []
    places, own = sample["place"].to_numpy(), finite_rows(sample["vector"], width)
    own = own / np.linalg.norm(own, axis=1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = finite_rows(batch["vector"], width)
            scores = (own @ others.T) / np.linalg.norm(others, axis=1)
            scores[places[:, None] == batch["place"].to_numpy()[None, :]] = -np.inf
            take = min(wanted, batch.num_rows)
            best = np.argpartition(-scores, take - 1, axis=1)[:, :take]
            query = np.repeat(np.arange(len(places)), take)
            score = scores[query, best.ravel()]
            good = np.isfinite(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[good].astype(np.int32)), pa.array(score[good]), batch["vector"].take(pa.array(best.ravel()[good]))],
                names=["query", "score", "vector"],
            )

    order = Window.partitionBy("query").orderBy(F.desc("score"))
    best = nodes.select("place", "vector").mapInArrow(run, "query int, score double, vector array<double>")
    few = best.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= wanted).select("query", "vector").toArrow()
    found = finite_rows(few["vector"], width)
    by_query = few["query"].to_numpy()
    return [(int(places[row]), own[row], found[by_query == row]) for row in range(len(places))]


def fitted_stop(matches: DataFrame, sample: list, trees: int, wanted: int, recall: float, seed: int) -> tuple[int, float]:
    """The least number of candidates, counted in every tree, that finds ``recall`` of the sample's nearest; and their recall."""
    least = trees * (wanted + 1)
    if not any(len(near) for _, _, near in sample):
        return least, 1.0
    counts = np.zeros((len(sample), BITS + 1), np.int64)
    rows = {place: row for row, (place, _, _) in enumerate(sample)}
    for found in matches.filter(F.col("query").isin(list(rows))).collect():
        counts[rows[found["query"]], found["level"]] = found["rows"]
    totals = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    needed = []
    for row, (_, own, near) in enumerate(sample):
        if len(near):
            bits = common_bits(strings_of(near, trees, seed), strings_of(own[None, :], trees, seed)).max(axis=1)
            # What is met at a level is found if the ascent goes on while fewer were met one level below.
            needed += [int(totals[row, level + 1]) if level < BITS else 0 for level in bits.tolist()]
    ordered = np.sort(np.array(needed) + 1)
    stop = max(least, int(ordered[int(np.ceil(recall * len(ordered))) - 1]))
    return stop, float((ordered <= stop).mean())


def stops_of(matches: DataFrame, stop: int) -> DataFrame:
    """``query, reach``: the deepest level at which ``stop`` candidates are met, 0 where there never are."""
    deeper = Window.partitionBy("query").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    summed = matches.withColumn("met", F.sum("rows").over(deeper))
    reach = F.coalesce(F.max(F.when(F.col("met") >= stop, F.col("level"))), F.lit(0))
    return summed.groupBy("query").agg(reach.alias("reach"))


def streamed(left: DataFrame, right: DataFrame, order: list[str], holder: type, schema: str, *settings: object) -> DataFrame:
    """What a ``holder`` of a key's left rows makes of its right rows, which pass by in slices sorted by ``order``."""
    left = left.withColumn("side", F.lit(0))
    both = left.unionByName(right.withColumn("side", F.lit(1)), allowMissingColumns=True)
    dealt = both.repartition("key").sortWithinPartitions("key", "side", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        last, kept, own = None, [], None
        for batch in batches:
            keys, sides = batch["key"].to_numpy(), batch["side"].to_numpy()
            change = (keys[1:] != keys[:-1]) | (sides[1:] != sides[:-1])
            borders = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for start, end in zip(borders, borders[1:], strict=False):
                if start == end:
                    continue
                if keys[start] != last:
                    if own is not None:
                        yield from own.end()
                    last, kept, own = keys[start], [], None
                if sides[start] == 0:
                    kept.append(batch.slice(start, end - start))
                elif kept:
                    own = own or holder(pa.Table.from_batches(kept).combine_chunks(), *settings)
                    yield from own.take(batch.slice(start, end - start))
        if own is not None:
            yield from own.end()

    return dealt.mapInArrow(run, schema)


CANDIDATES = "block int, query long, slots binary"


class SortedArrays:
    """The arrays of one key, which lists the candidates of passing queries."""

    def __init__(self, rows: pa.Table):
        self.names = [tuple(rows[c][row].as_py() for c in BUCKET) for row in range(rows.num_rows)]
        entries = [rows["entries"][row].values for row in range(rows.num_rows)]
        self.strings = [own.field("hash").to_numpy().view(np.uint64) for own in entries]
        self.places = [own.field("place").to_numpy() for own in entries]

    def take(self, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [asked[c].to_numpy() for c in BUCKET]
        for name, strings, places in zip(self.names, self.strings, self.places, strict=True):
            # Keys of 64 bits may meet.
            rows = np.flatnonzero(np.logical_and.reduce([column == part for column, part in zip(columns, name, strict=True)]))
            queries = asked["query"].to_numpy()[rows]
            wanted = asked["own"].to_numpy()[rows].view(np.uint64)
            first, end = range_at(strings, wanted, asked["reach"].to_numpy()[rows])
            for start in range(0, len(rows), ASKED_AT_ONCE):
                some = slice(start, start + ASKED_AT_ONCE)
                yield from listed(queries[some], first[some], end[some], places)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from ()


def listed(queries: np.ndarray, first: np.ndarray, end: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each query and block with the slots of the query's range, two bytes each."""
    many = end - first
    if not many.sum():
        return
    owner = np.repeat(np.arange(len(queries)), many)
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    order = np.lexsort((places[at], owner))
    owner, found = owner[order], places[at][order]
    block = found >> SLOT_BITS
    starts = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])]))
    slots = (found & ((1 << SLOT_BITS) - 1)).astype("<u2")
    offsets = np.concatenate([starts, [len(found)]]).astype(np.int32) * 2
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(slots.tobytes())]
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(starts), buffers)
    yield pa.RecordBatch.from_arrays(
        [pa.array(block[starts].astype(np.int32)), pa.array(queries[owner[starts]]), packed], names=["block", "query", "slots"]
    )


def candidates_of(arrays: DataFrame, ancestors: DataFrame, stops: DataFrame) -> DataFrame:
    """``block, query, slots``: where in which block the candidates of a query lie, tree by tree."""
    asked = arrays.select("tree", "depth", F.explode(F.filter("entries", lambda e: e["asked"])).alias("e"))
    asked = asked.select("tree", F.col("depth").alias("deep"), F.col("e.hash").alias("hash"), F.col("e.place").alias("query"))
    # At level 0 one tree has them all.
    routed = asked.join(stops, "query").filter("reach > 0 or tree = 0").withColumn("level", F.least("reach", "deep"))
    routed = routed.withColumn("up", prefix_of(F.col("level"))).drop("deep")
    right = routed.join(ancestors, ["tree", "level", "up"]).select(
        F.xxhash64(*BUCKET).alias("key"), *BUCKET, "query", F.col("hash").alias("own"), "reach"
    )
    left = arrays.select(F.xxhash64(*BUCKET).alias("key"), *BUCKET, "entries")
    return streamed(left, right, ["query"], SortedArrays, CANDIDATES)


SCORED = "query long, node long, ids array<long>, score double"


class Block:
    """The vectors of one block, which measures the candidates of passing queries.

    A query's vector comes first, then its slots tree by tree; they join to one set before they are measured.
    """

    def __init__(self, rows: pa.Table, width: int, wanted: int):
        rows = rows.take(pa.array(np.argsort(rows["slot"].to_numpy(), kind="stable")))
        self.wanted, self.width = wanted, width
        self.node, self.ids = rows["node"].to_numpy(), rows["ids"].combine_chunks()
        self.vectors = finite_rows(rows["vector"], width)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.mask = np.zeros(len(self.node), bool)
        self.query = self.vector = None

    def take(self, passing: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        queries = passing["query"].to_numpy()
        slots, own = passing["slots"], passing["own"]
        found = []
        borders = [0, *(np.flatnonzero(queries[1:] != queries[:-1]) + 1).tolist(), len(queries)]
        for start, end in zip(borders, borders[1:], strict=False):
            if queries[start] != self.query:
                found += self.best()
                self.query, self.vector = int(queries[start]), None
                self.mask[:] = False
            for row in range(start, end):
                if own[row].is_valid:
                    self.vector = finite_rows(own.slice(row, 1), self.width)[0]
                else:
                    self.mask[np.frombuffer(slots[row].as_buffer(), "<u2")] = True
        yield from self.batch(found)

    def best(self) -> list[tuple[int, int, float]]:
        rows = np.flatnonzero(self.mask)
        if self.vector is None or not len(rows):
            return []
        scores = (self.vectors[rows] @ self.vector) / (self.norms[rows] * np.sqrt((self.vector * self.vector).sum()))
        order = np.lexsort((self.node[rows], -scores))[: self.wanted]
        return [(self.query, int(row), float(score)) for row, score in zip(rows[order], scores[order], strict=True)]

    def batch(self, found: list[tuple[int, int, float]]) -> Iterator[pa.RecordBatch]:
        if found:
            query, row, score = (list(column) for column in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(self.node[row]), self.ids.take(pa.array(row)), pa.array(score)],
                names=["query", "node", "ids", "score"],
            )

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.batch(self.best())


def scored(nodes: DataFrame, candidates: DataFrame, width: int, wanted: int) -> DataFrame:
    """``query, node, ids, score``: the ``wanted`` nearest candidates of each query in each block."""
    left = nodes.select(F.col("block").alias("key"), "slot", "node", "ids", "vector")
    asked = nodes.filter("asked").select(F.col("place").alias("query"), F.col("vector").alias("own"))
    own = candidates.select("block", "query").distinct().join(asked, "query")
    right = own.select(F.col("block").alias("key"), "query", "own").unionByName(
        candidates.select(F.col("block").alias("key"), "query", "slots"), allowMissingColumns=True
    )
    return streamed(left, right, ["query", "slots"], Block, SCORED, width, wanted)


def nearest(
    vectors: DataFrame,
    queries: Column,
    wanted: int = NEAREST,
    trees: int = TREES,
    recall: float = RECALL,
    array_rows: int = ARRAY_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score, audited_recall`` for the rows of ``vec_id, embedding`` that ``queries`` names."""
    rows = cut(usable(vectors), "forest-rows")
    # One more than is wanted of each, as a query may be among its own copies.
    nodes = nodes_of(rows, queries, wanted + 1)
    many = nodes.count()
    width = nodes.agg(F.max(F.size("vector"))).first()[0] or 0
    arrays = sorted_arrays(entries_of(nodes, width, trees, seed), many, array_rows)
    ancestors, above = above_arrays(arrays)
    matches = cut(matches_by_level(arrays, above), "forest-matches")
    stop, found = fitted_stop(matches, nearest_of_sample(nodes, width, wanted, seed), trees, wanted, recall, seed)
    candidates = cut(candidates_of(arrays, ancestors, stops_of(matches, stop)), "forest-candidates")
    hits = cut(scored(nodes, candidates, width, wanted + 1), "forest-hits")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    best = hits.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= wanted + 1)
    listed_ = best.select("query", "score", F.explode("ids").alias("vec_id"))
    places = nodes.filter("asked").select(F.col("vector").alias("own"), F.col("place").alias("query"))
    asked = rows.filter(queries).join(places, F.col("vector") == F.col("own")).select(F.col("vec_id").alias("query_id"), "query")
    pairs = asked.join(listed_, "query").filter("vec_id != query_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= wanted)
    return pairs.select("query_id", "rank", "vec_id", "score", F.lit(found).alias("audited_recall"))


def op12_prefix_forest(spark, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)
