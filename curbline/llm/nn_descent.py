"""Near-duplicate vectors by NN-descent.

Equal vectors of one label are one node. Every node keeps a list of its ``K`` nearest nodes found so far. The first
lists come from blocks of nodes on the same side of random planes; each round then joins neighbours of neighbours:
a node's neighbourhood, in both directions, is compared with itself, and what beats the end of a list enters it.

Lists whose last place still reaches the threshold are saturated: they may hide further links. Their places are doubled, up to
``MOST_PLACES``, each time with a round over the neighbourhoods that hold a saturated node. What stays full is counted against
all of its component and not listed: two nodes within half the threshold's angle of the component's mean
direction are linked by the triangle inequality, so such nodes need a count only, and the others are compared
with the component in blocks. Two saturated components of one label may hide the links between them as well: where the
angle of their means, less both radii, leaves room for the threshold, all their pairs are counted in blocks, and a link
found joins them. Edges that reach the threshold in double precision are kept.

Sets of planes grow with the nodes of a label, so that two nodes at the threshold share a side of one of them by ``MEET``
at least. Recall is audited: for a bounded sample of each label's nodes all links are counted by comparison with every
node of the label, and each node with links counts alike, whether it has one or thousands. A label's recall is the
lowest of its nodes with less than ``K`` links, those with more, and both. A sample may hold no link at all where links are rare, so
each of its nodes also gets a planted partner just above the threshold: a node without weight that the search treats like others
and that enters nobody's list. The share of partners that find their node is a recall too, and the lower one counts. Labels below ``RECALL`` get further planes and
rounds, for ``MOST_TRIES`` tries; those still below are compared whole, every node with every other, in blocks.

Defined cases: rows whose label is null or whose vector is null, empty, zero or holds null or non-finite components
link with nothing; vectors of different lengths do not link; repeated rows are vectors of their own; a null vec_id
takes part but names no component; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from curbline.llm.common import connected_components, cut

LEAST = 0.93
#: Places in a node's list.
K = 10
#: Places that a saturated list is enlarged to, by doubling.
MOST_PLACES = 4 * K
#: Neighbours of a node that a round joins, of both directions.
JOINED = 2 * K
#: Improvements that a round takes from one neighbourhood for one of its nodes.
TAKEN = 3
#: Sets of planes to begin with, nodes that a side of a set has on average, and nodes compared at once.
PLANES = 6
LEAF = 64
BLOCK = 256
#: Nodes of a leaf above which it is dealt to several tasks.
HOT_LEAF = 4096
#: Rounds of neighbours of neighbours after each set of planes.
ROUNDS = 2
#: Share of pairs at the threshold that the first planes alone bring together.
MEET = 0.995
#: Nodes of a label that the audit compares with all, the recall it asks for, and how often the search is extended.
AUDIT = 512
RECALL = 0.99
MOST_TRIES = 4
#: Nodes of a component that are compared with others at once.
TILE = 1024
#: Nodes of a label that the audit, and a comparison of all, hold at once.
WHOLE = 4 * TILE
#: Slack of the search in single precision; the edges kept are measured in double.
SLACK = 1e-4


def unit_rows(vectors: pa.Array) -> pa.Array:
    """Vectors at length 1 as doubles, or null where one has no direction."""
    out: list[np.ndarray | None] = [None] * len(vectors)
    lengths = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan)
        own = flat.to_numpy(zero_copy_only=False).reshape(len(rows), dim)
        most = np.abs(own).max(axis=1)
        good = np.isfinite(most) & (most > 0)
        scaled = own[good] / most[good, None]
        scaled = scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None] + 0.0  # no negative zeros
        for row, values in zip(rows[good].tolist(), scaled, strict=True):
            out[row] = values
    return pa.array(out, pa.list_(pa.float64()))


def unit(vector: Column) -> Column:
    """The vector at length 1 as doubles, or null where it has no direction."""
    return arrow_udf(unit_rows, "array<double>")(vector)


def matrix(column: pa.Array, dtype: type = np.float32) -> np.ndarray:
    """Vectors of equal length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False)


def edge_batch(a: np.ndarray, b: np.ndarray, similarity: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(similarity, pa.float32())], ["a", "b", "s"]
    )


EDGES = "a long, b long, s float"
#: Edges to planted partners, which have negative numbers, enter no list.
REAL = "b >= 0"


def by_key(handle: Callable, block: int) -> Callable:
    """A function over batches sorted by column ``key`` that hands over the rows of a key, ``block`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            for first in range(0, rows.num_rows, block):
                yield from handle(rows.slice(first, block).to_batches())
            held.clear()

        for batch in batches:
            keys = batch["key"].to_numpy(zero_copy_only=False)
            borders = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for start, end in zip(borders, borders[1:], strict=False):
                if start == end:
                    continue
                if held and (keys[start] != last or sum(len(x) for x in held) >= block):
                    yield from flush()
                held.append(batch.slice(start, end - start))
                last = keys[start]
        if held:
            yield from flush()

    return run


def nearest_in_block(nodes: np.ndarray, vectors: np.ndarray, most: int, floor: np.ndarray | None = None):
    """The ``most`` nearest others of each node, and those only that beat its ``floor``."""
    similarity = vectors @ vectors.T
    np.fill_diagonal(similarity, -np.inf)
    take = min(most, len(nodes) - 1)
    best = np.argpartition(-similarity, take - 1, axis=1)[:, :take]
    rows = np.repeat(np.arange(len(nodes)), take)
    found = similarity[rows, best.ravel()]
    good = nodes[rows] != nodes[best.ravel()]
    if floor is not None:
        good &= found > floor[rows]
    return edge_batch(nodes[rows[good]], nodes[best.ravel()[good]], found[good])


def sets_of(bits: Column, planes: int, least: float) -> Column:
    """Sets of planes after which ``MEET`` of the pairs at the threshold have been on one side, ``planes`` at least."""
    alike = F.pow(F.lit(1 - math.acos(max(-1.0, min(1.0, least))) / math.pi), bits)
    wanted = F.when(bits > 0, F.ceil(math.log(1 - MEET) / F.log(1 - alike))).otherwise(0)
    return F.greatest(F.lit(planes), wanted).cast("int")


def leaves(nodes: DataFrame, planes: int, seed: int, least: float) -> DataFrame:
    """``node, unit, key``: each node once per set of planes, with the number of its side."""
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("rows"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("rows") / LEAF))).cast("int")
    sized = sizes.select("label", "dim", bits.alias("bits"))
    sized = nodes.join(sized.withColumn("sets", sets_of(F.col("bits"), planes, least)), ["label", "dim"])

    @arrow_udf("array<long>")
    def sides(vectors: pa.Array, bits: pa.Array, sets: pa.Array) -> pa.Array:
        lengths = np.diff(vectors.offsets.to_numpy())
        wanted = bits.to_numpy(zero_copy_only=False)
        many = sets.to_numpy(zero_copy_only=False)
        most = int(many.max(initial=0))
        out = np.zeros((len(vectors), most), np.int64)
        for dim in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dim)
            own = matrix(vectors.take(pa.array(rows)))
            for table in range(most):
                normals = np.random.default_rng([seed, table, dim]).standard_normal((dim, 48)).astype(np.float32)
                signs = (own @ normals > 0).astype(np.int64)
                signs *= np.arange(48) < wanted[rows, None]
                out[rows, table] = signs @ (1 << np.arange(48))
        offsets = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
        flat = out[np.arange(most) < many[:, None]]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))

    coded = sized.select("node", "label", "dim", "unit", F.posexplode(sides("unit", "bits", "sets")).alias("table", "side"))
    place = ["label", "dim", "table", "side"]
    hot = coded.groupBy(*place).agg(F.count("*").alias("rows")).filter(F.col("rows") > HOT_LEAF)
    hot = cut(hot.select(*place, F.ceil(F.col("rows") / HOT_LEAF).alias("cuts")), "nn-hot")
    dealt = F.pmod(F.xxhash64("node", "table", F.lit(seed)), F.coalesce("cuts", F.lit(1)))
    return coded.join(hot, place, "left").select("node", "unit", F.xxhash64(*place, dealt).alias("key"))


def best_edges(edges: DataFrame, most: int) -> DataFrame:
    """The ``most`` nearest of each node, repeated edges once, both in one shuffle by node.

    A node has no more rows than its neighbours' lists have places and the blocks find.
    """
    order = Window.partitionBy("a").orderBy(F.col("s").desc(), "b")
    once = edges.repartition("a").groupBy("a", "b").agg(F.max("s").alias("s"))
    return once.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def first_lists(nodes: DataFrame, planes: int, seed: int, least: float) -> DataFrame:
    """Lists from the blocks on each side of the planes."""

    def compare(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows > 1:
                yield nearest_in_block(batch["node"].to_numpy(), matrix(batch["unit"]), K)

    single = leaves(nodes, planes, seed, least).select("key", "node", F.col("unit").cast("array<float>").alias("unit"))
    dealt = single.repartition("key").sortWithinPartitions("key", F.xxhash64("node", "key"))
    return dealt.mapInArrow(by_key(compare, BLOCK), EDGES).filter(REAL)


def refined(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """One round: what the neighbourhoods find and the lists hold, cut to ``K`` places."""
    both = lists.unionByName(lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    around = best_edges(both, JOINED).select(F.col("a").alias("key"), F.col("b").alias("node"))
    around = around.unionByName(lists.select(F.col("a").alias("key"), F.col("a").alias("node")).distinct())
    ends = lists.groupBy("a").agg(F.when(F.count("*") >= K, F.min("s")).otherwise(F.lit(-2.0)).alias("end"))
    known = nodes.join(ends, F.col("node") == F.col("a"), "left").select(
        F.col("node").alias("id"),
        F.col("unit").cast("array<float>").alias("unit"),
        F.coalesce("end", F.lit(-2.0)).cast("float").alias("end"),
    )

    def compare(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows > 1:
                ends = batch["end"].to_numpy()
                yield nearest_in_block(batch["node"].to_numpy(), matrix(batch["unit"]), TAKEN, ends)

    met = around.join(known, F.col("node") == F.col("id")).select("key", "node", "unit", "end")
    found = met.repartition("key").sortWithinPartitions("key").mapInArrow(by_key(compare, JOINED + 1), EDGES)
    return best_edges(lists.unionByName(found.filter(REAL)), K)


def enlarged(nodes: DataFrame, lists: DataFrame, least: float) -> DataFrame:
    """The lists with twice the places where the last one reaches the threshold, as often as that holds."""
    places = K
    while places < MOST_PLACES:
        ends = lists.groupBy("a").agg(F.count("*").alias("n"), F.min("s").alias("end"))
        full = ends.filter((F.col("n") >= places) & (F.col("end") >= least - SLACK))
        full = cut(full.select(F.col("a").alias("node"), F.lit(True).alias("full")), "nn-full")
        if full.isEmpty():
            break
        places *= 2
        both = lists.unionByName(lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
        around = best_edges(both, 2 * places).select(F.col("a").alias("key"), F.col("b").alias("node"))
        around = around.unionByName(full.select(F.col("node").alias("key"), "node"))
        known = nodes.select("node", F.col("unit").cast("array<float>").alias("unit")).join(full, "node", "left")
        met = around.join(around.join(full, "node").select("key").distinct(), "key", "left_semi").join(known, "node")

        def compare(batches: list[pa.RecordBatch], most: int = places) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows > 1:
                    wanted = batch["full"].fill_null(False).to_numpy(zero_copy_only=False)
                    floor = np.where(wanted, least - SLACK, np.inf).astype(np.float32)
                    yield nearest_in_block(batch["node"].to_numpy(), matrix(batch["unit"]), most, floor)

        dealt = met.select("key", "node", "unit", "full").repartition("key").sortWithinPartitions("key")
        found = dealt.mapInArrow(by_key(compare, 2 * places + 1), EDGES).filter(REAL)
        lists = cut(best_edges(lists.unionByName(found), places), "nn-lists")
    return lists


def measured(nodes: DataFrame, lists: DataFrame, least: float) -> DataFrame:
    """``a, b`` in both directions for the edges that reach the threshold in double precision."""
    near = lists.filter(F.col("s") >= least - SLACK).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    one = nodes.select(F.col("node").alias("a"), F.col("unit").alias("u"))
    other = nodes.select(F.col("node").alias("b"), F.col("unit").alias("v"))
    products = F.zip_with("u", "v", lambda x, y: x * y)
    cosine = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    kept = near.distinct().join(one, "a").join(other, "b").filter(cosine >= least).select("a", "b")
    return kept.unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))


NAMES = ["a", "b", "lo", "hi"]


def tiled(members: DataFrame, pairs: DataFrame, handle: Callable, schema: str, most: int) -> DataFrame:
    """What ``handle(left, right)`` makes of every two tiles of groups that are paired.

    ``members`` has ``node, grp`` and what ``handle`` reads, ``pairs`` the groups ``a <= b``. Tiles have some ``most`` nodes;
    two tiles are compared once, and a tile of a group paired with itself also with itself.
    """
    sizes = members.groupBy("grp").agg(F.ceil(F.count("*") / most).cast("int").alias("cuts"))
    sized = pairs.join(sizes.select(F.col("grp").alias("a"), F.col("cuts").alias("cuts_a")), "a").join(
        sizes.select(F.col("grp").alias("b"), F.col("cuts").alias("cuts_b")), "b"
    )
    sized = cut(sized.select("a", "b", "cuts_a", "cuts_b"), "nn-pairs")
    columns = [c for c in members.columns if c != "grp"]
    own = F.xxhash64("node")
    same = F.col("a") == F.col("b")
    left = members.join(sized, F.col("grp") == F.col("a")).withColumn("lo", F.pmod(own, F.col("cuts_a")).cast("int"))
    left = left.withColumn("hi", F.explode(F.sequence(F.when(same, F.col("lo")).otherwise(0), F.col("cuts_b") - 1)))
    right = members.join(sized, F.col("grp") == F.col("b")).withColumn("hi", F.pmod(own, F.col("cuts_b")).cast("int"))
    right = right.withColumn("lo", F.explode(F.sequence(F.lit(0), F.when(same, F.col("hi")).otherwise(F.col("cuts_a") - 1))))
    both = left.select(*NAMES, F.lit(False).alias("side"), *columns).unionByName(
        right.select(*NAMES, F.lit(True).alias("side"), *columns)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two tiles are some 2 * most rows; others with an equal key are told apart by name."""
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            sides = [rows.filter(mask).combine_chunks() for mask in (pc.invert(rows["side"]), rows["side"])]
            if sides[0].num_rows and sides[1].num_rows:
                yield from handle(*sides)

        for batch in batches:
            names = np.stack([batch[c].to_numpy().astype(np.int64) for c in NAMES], axis=1)
            borders = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
            for start, end in zip(borders, borders[1:], strict=False):
                if start == end:
                    continue
                if held and tuple(names[start]) != last:
                    yield from flush()
                held.append(batch.slice(start, end - start))
                last = tuple(names[start])
        if held:
            yield from flush()

    dealt = both.withColumn("key", F.xxhash64(*NAMES)).repartition("key").sortWithinPartitions("key", *NAMES).drop("key")
    return dealt.mapInArrow(run, schema)


def rows_at(table: pa.Table, name: str, dtype: type = np.float64) -> np.ndarray:
    return matrix(table[name].combine_chunks(), dtype)


def counted(members: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """``node, links, other``: links of nodes of paired groups, and one edge for two tiles of different groups that link.

    ``members`` has ``node, m, unit, grp, core``; ``m`` is the number of vectors of a node. Nodes of a group's core are not
    counted against each other.
    """

    def count(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b, lo, hi = (left[c][0].as_py() for c in NAMES)
        nodes, others = left["node"].to_numpy(), right["node"].to_numpy()
        weights, other_weights = left["m"].to_numpy(), right["m"].to_numpy()
        core, other_core = (t["core"].to_numpy() for t in (left, right))
        vectors, other_vectors = rows_at(left, "unit"), rows_at(right, "unit")
        links, other_links = np.zeros(len(nodes), np.int64), np.zeros(len(others), np.int64)
        edge = None
        for first in range(0, len(nodes), TILE):
            part = slice(first, first + TILE)
            near = vectors[part] @ other_vectors.T >= least
            if a == b:
                near &= ~(core[part, None] & other_core[None, :])
                near &= nodes[part, None] != others[None, :]
            elif edge is None and near.any():
                row, column = np.unravel_index(near.argmax(), near.shape)
                edge = (nodes[first + row], others[column])
            links[part] = near @ other_weights
            other_links += weights[part] @ near
        empty = lambda n: pa.nulls(n, pa.int64())
        names = ["node", "links", "other"]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links), empty(len(nodes))], names)
        if a != b or lo != hi:
            yield pa.RecordBatch.from_arrays([pa.array(others), pa.array(other_links), empty(len(others))], names)
        if edge is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (edge[0], 0, edge[1])], names)

    return tiled(members.select("node", "m", "unit", "grp", "core"), pairs, count, "node long, links long, other long", TILE)


def near_groups(centres: DataFrame, least: float) -> DataFrame:
    """``a, b``: different groups of a label that may link, by the angle of their centres less both radii.

    ``centres`` has ``grp, label, dim, centre, radius``; those of a label are compared in tiles.
    """
    room = math.acos(least) + 1e-6

    def compare(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        mine, others = left["node"].to_numpy(), right["node"].to_numpy()
        angles = np.arccos(np.clip(rows_at(left, "centre") @ rows_at(right, "centre").T, -1.0, 1.0))
        angles -= left["radius"].to_numpy()[:, None]
        angles -= right["radius"].to_numpy()[None, :]
        rows, columns = np.nonzero((angles <= room) & (mine[:, None] != others[None, :]))
        ends = np.sort(np.stack([mine[rows], others[columns]], axis=1), axis=1)
        ends = np.unique(ends, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    firsts = centres.groupBy("label", "dim").agg(F.min("grp").alias("of"), F.count("*").alias("n")).filter("n > 1")
    placed = cut(
        centres.join(firsts, ["label", "dim"]).select(F.col("grp").alias("node"), F.col("of").alias("grp"), "centre", "radius"),
        "nn-centres",
    )
    pairs = placed.select(F.col("grp").alias("a"), F.col("grp").alias("b")).distinct()
    return tiled(placed, pairs, compare, "a long, b long", TILE)


def counted_whole(members: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """``node, links`` in components ``grp`` that are counted against all their nodes and those of near components,
    and ``a, b`` for components that turn out to be linked.

    ``members`` has ``node, label, dim, m, unit, grp``.
    """
    mean = members.select("grp", F.posexplode("unit").alias("place", "x")).groupBy("grp", "place").agg(
        F.sum("x").alias("x")
    )
    centre = mean.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("place", "x")))["x"].alias("sum"))
    centre = centre.select("grp", unit(F.col("sum")).alias("centre"))
    along = F.aggregate(F.zip_with("unit", "centre", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    half = math.sqrt((1 + least) / 2) + 1e-9
    placed = cut(
        members.join(centre, "grp", "left").select(
            "node", "label", "dim", "m", "unit", "grp", "centre",
            F.coalesce(along >= half, F.lit(False)).alias("core"),
            F.coalesce(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), along))), F.lit(math.pi)).alias("angle"),
        ),
        "nn-members",
    )
    sizes = placed.groupBy("grp", "label", "dim").agg(
        F.sum(F.when(F.col("core"), F.col("m")).otherwise(0)).alias("core_m"),
        F.sum(F.col("core").cast("long")).alias("core_rows"),
        F.count("*").alias("rows"),
        F.max("angle").alias("radius"),
        F.coalesce(F.first("centre"), F.array_repeat(F.lit(0.0), F.col("dim"))).alias("centre"),
    )
    sizes = cut(sizes, "nn-sizes")
    core_sizes = sizes.select("grp", "core_m")
    sure = placed.filter("core").join(core_sizes, "grp").select("node", (F.col("core_m") - F.col("m")).alias("links"))
    inside = sizes.filter("core_rows < rows").select(F.col("grp").alias("a"), F.col("grp").alias("b"))
    pairs = inside.unionByName(near_groups(sizes, least))
    compared = cut(counted(placed, pairs, least), "nn-counted")
    group_of = placed.select("node", "grp")
    across = (
        compared.filter("other is not null")
        .join(group_of.withColumnRenamed("grp", "a"), "node")
        .join(group_of.select(F.col("node").alias("other"), F.col("grp").alias("b")), "other")
        .select("a", "b")
    )
    links = sure.unionByName(compared.filter("other is null").select("node", "links"))
    return links.groupBy("node").agg(F.sum("links").alias("links")), across


def settled(nodes: DataFrame, lists: DataFrame, least: float) -> DataFrame:
    """``node, links, grp``: linked vectors of other nodes, and the component's number, of nodes with links."""
    edges = cut(measured(nodes, lists, least), "nn-edges")
    groups = cut(connected_components(edges, "nn"), "nn-groups").withColumnRenamed("component", "grp")
    saturated = lists.groupBy("a").agg(F.count("*").alias("n"), F.min("s").alias("end"))
    saturated = saturated.filter((F.col("n") >= K) & (F.col("end") >= least - SLACK)).select(F.col("a").alias("node"))
    hidden = cut(groups.join(saturated, "node", "left_semi").select("grp").distinct(), "nn-saturated")
    members = nodes.select("node", "label", "dim", "m", "unit").join(groups.join(hidden, "grp", "left_semi"), "node")
    whole, across = counted_whole(members, least)
    listed = (
        edges.join(groups.join(hidden, "grp", "left_anti"), F.col("a") == F.col("node"))
        .join(nodes.select(F.col("node").alias("b"), "m"), "b")
        .groupBy("node")
        .agg(F.sum("m").alias("links"))
    )
    across = cut(across.distinct(), "nn-across")
    if not across.isEmpty():
        joined = cut(connected_components(across, "nn-joined"), "nn-joined-groups")
        joined = joined.select(F.col("node").alias("grp"), "component")
        groups = groups.join(joined, "grp", "left").select("node", F.coalesce("component", "grp").alias("grp"))
    return cut(groups.join(whole.unionByName(listed), "node", "left"), "nn-settled")


def by_label(nodes: DataFrame) -> DataFrame:
    """``node, label, dim, m, unit, grp``: all nodes of a label and length as one group, named by the first."""
    firsts = nodes.groupBy("label", "dim").agg(F.min("node").alias("grp"))
    return nodes.select("node", "label", "dim", "m", "unit").join(firsts, ["label", "dim"])


def exact_counts(nodes: DataFrame, queries: DataFrame, least: float) -> DataFrame:
    """``node, links`` of some nodes of each label by comparison with every node of it, a block at a time.

    A label's queries are bounded and go to each of its blocks, as many as it has for every ``WHOLE`` nodes.
    """
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / WHOLE).cast("int").alias("cuts"))
    place = ["label", "dim"]
    columns = [F.xxhash64(*place, "piece").alias("key"), *place, "piece", "asked", "node", "m", "unit"]
    piece = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    known = nodes.join(sizes, place).withColumn("piece", piece).withColumn("asked", F.lit(False))
    asked = queries.join(sizes, place).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    both = known.select(*columns).unionByName(asked.withColumn("asked", F.lit(True)).select(*columns))

    def compare(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        names = list(zip(*(rows[c].to_pylist() for c in (*place, "piece")), strict=True))
        for name in set(names):  # one, but for equal hashes
            own = rows.filter(pa.array([n == name for n in names]))
            some, all_ = own.filter(own["asked"]), own.filter(pc.invert(own["asked"]))
            if some.num_rows and all_.num_rows:
                ids, others, weights = some["node"].to_numpy(), all_["node"].to_numpy(), all_["m"].to_numpy()
                near = rows_at(some, "unit") @ rows_at(all_, "unit").T >= least
                near &= ids[:, None] != others[None, :]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near @ weights)], ["node", "links"])

    dealt = both.repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(by_key(compare, 1 << 62), "node long, links long")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def audited(nodes: DataFrame, audit: int = AUDIT) -> DataFrame:
    """At most so many nodes of each label, those whose numbers hash lowest."""
    order = Window.partitionBy("label", "dim").orderBy("draw", "node")
    draw = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1 << 30))
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("rows"))
    few = nodes.withColumn("draw", draw).join(sizes, ["label", "dim"])
    few = few.filter(F.col("draw") < (1.2 * audit + 200) / F.col("rows") * (1 << 30))
    queries = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= audit)
    return cut(queries.select("node", "label", "dim", "m", "unit"), "nn-audit")


def partners(queries: DataFrame, least: float) -> DataFrame:
    """A node just above the threshold from each, in a random direction, without weight; node n has partner -1 - n."""

    @arrow_udf("array<double>")
    def beside(vectors: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        for vector, number in zip(vectors, numbers.to_pylist(), strict=True):
            own = vector.values.to_numpy()
            across = np.random.default_rng(number).standard_normal(len(own))
            across -= (across @ own) * own
            length = np.sqrt(across @ across)
            near = min(1.0, least + 1e-6)
            # one dimension has no other direction
            other = near * own + math.sqrt(1 - near * near) * across / length if length > 1e-9 else own
            out.append(other / np.sqrt(other @ other))
        return pa.array(out, pa.list_(pa.float64()))

    number = (-1 - F.col("node")).alias("node")
    return queries.select(number, "label", "dim", F.lit(0).cast("long").alias("m"), beside("unit", "node").alias("unit"))


def partner_recall(queries: DataFrame, lists: DataFrame, least: float) -> DataFrame:
    """``label, dim, planted``: the share of partners whose list holds their node, or is saturated by others."""
    own = lists.filter("a < 0").groupBy((-1 - F.col("a")).alias("node"))
    met = F.max((F.col("b") == -1 - F.col("a")).cast("int"))
    full = (F.count("*") >= K) & (F.min("s") >= least - SLACK)
    hits = own.agg(F.greatest(met, full.cast("int")).alias("hit"))
    hit = F.coalesce("hit", F.lit(0))
    return queries.join(hits, "node", "left").groupBy("label", "dim").agg(F.avg(hit).alias("planted"))


def recall_of(nodes: DataFrame, found: DataFrame, least: float, queries: DataFrame, lists: DataFrame) -> DataFrame:
    """``label, dim, recall, planted`` of every label: the lowest share found, and that of the planted partners.

    Of sampled nodes with links it is the lowest of the mean shares of nodes with less than ``K`` links, of those with more, and of
    both. Found links are all true.
    """
    truth = exact_counts(nodes, queries, least).filter("links > 0")
    both = truth.join(queries.select("node", "label", "dim"), "node").join(
        found.select("node", F.col("links").alias("got")), "node", "left"
    )
    share = F.coalesce("got", F.lit(0)) / F.col("links")
    low, high = (F.avg(F.when(which, share)) for which in (F.col("links") < K, F.col("links") >= K))
    counted = both.groupBy("label", "dim").agg(F.least(low, high, F.avg(share)).alias("linked"))
    every = partner_recall(queries, lists, least).join(counted, ["label", "dim"], "left")
    return every.select("label", "dim", F.least("linked", "planted").alias("recall"), "planted")


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that tie what ``near`` links, each row read once; rows and columns are numbered through."""
    edges: list[tuple[int, int]] = []
    rows, columns = near.shape
    new_row, new_column = np.ones(rows, bool), np.ones(columns, bool)
    for root in np.flatnonzero(near.any(axis=1)).tolist():
        if not new_row[root]:
            continue
        new_row[root] = False
        front = np.array([root])
        while len(front):
            met = np.flatnonzero(near[front].any(axis=0) & new_column)
            new_column[met] = False
            edges += [(root, rows + x) for x in met.tolist()]
            front = np.flatnonzero(near[:, met].any(axis=1) & new_row)
            new_row[front] = False
            edges += [(root, x) for x in front.tolist()]
    return edges


def compared_whole(nodes: DataFrame, least: float) -> DataFrame:
    """``node, links, grp`` of nodes with links, as ``settled``, from all pairs of each label."""
    members = by_label(nodes)
    pairs = members.select(F.col("grp").alias("a"), F.col("grp").alias("b")).distinct()

    def count(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        mine, others = left["node"].to_numpy(), right["node"].to_numpy()
        vectors, other_vectors = rows_at(left, "unit"), rows_at(right, "unit")
        near = np.empty((len(mine), len(others)), bool)
        for first in range(0, len(mine), TILE):
            near[first : first + TILE] = vectors[first : first + TILE] @ other_vectors.T >= least
        near &= mine[:, None] != others[None, :]
        tied = np.concatenate([mine, others])[np.array(forest(near), np.int64).reshape(-1, 2)]
        # weights are added up a block of rows at a time, since bits become numbers in the product
        links, other_links = np.zeros(len(mine), np.int64), np.zeros(len(others), np.int64)
        weights, other_weights = left["m"].to_numpy(), right["m"].to_numpy()
        for first in range(0, len(mine), TILE):
            part = slice(first, first + TILE)
            links[part] = near[part] @ other_weights
            other_links += weights[part] @ near[part]
        counts = [(mine, links)] + ([(others, other_links)] if left["lo"][0] != right["hi"][0] else [])
        names = ["node", "links", "other"]
        for node, own in counts:
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(own), pa.nulls(len(node), pa.int64())], names)
        zeros = np.zeros(len(tied), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(tied[:, 0]), pa.array(zeros), pa.array(tied[:, 1])], names)

    schema = "node long, links long, other long"
    compared = cut(tiled(members.select("node", "m", "unit", "grp"), pairs, count, schema, WHOLE), "nn-whole")
    edges = compared.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    groups = connected_components(edges, "nn-whole").withColumnRenamed("component", "grp")
    links = compared.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    return cut(groups.join(links, "node"), "nn-settled")


def link_vectors(vectors: DataFrame, least: float = LEAST, planes: int = PLANES, seed: int = 0) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``."""
    rows = cut(
        vectors.select(
            "vec_id",
            "label",
            F.when(F.col("label").isNotNull(), unit(F.col("embedding"))).alias("unit"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "nn-rows",
    )
    nodes = cut(
        rows.filter("unit is not null")
        .groupBy("label", "unit")
        .agg(F.min("row").alias("node"), F.min("vec_id").alias("first_id"), F.count("*").alias("m"))
        .withColumn("dim", F.size("unit")),
        "nn-nodes",
    )
    lists = cut(nodes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0.0).cast("float").alias("s")).limit(0), "nn-lists")
    place = ["label", "dim"]
    searched, done = nodes, []
    for attempt in range(MOST_TRIES):
        queries = audited(searched)
        planted = cut(partners(queries, least), "nn-partners")
        both = searched.select(*planted.columns).unionByName(planted)
        more = first_lists(both, planes, seed + attempt, least)
        lists = cut(best_edges(lists.unionByName(more), K), "nn-lists")
        for _ in range(ROUNDS):
            lists = cut(refined(both, lists), "nn-lists")
        own = enlarged(searched, lists.filter("a >= 0"), least)
        found = settled(searched, own, least)
        recall = recall_of(searched, found, least, queries, lists)
        poor = cut(recall.filter(F.col("recall") < RECALL).select(*place), "nn-poor")
        if poor.isEmpty():
            done.append(found)
            break
        # Labels that are found well are done; the others are searched on.
        again = searched.join(poor, place, "left_semi")
        done.append(found.join(again, "node", "left_anti"))
        searched = cut(again, "nn-searched")
        lists = own.join(searched.select(F.col("node").alias("a")), "a", "left_semi")
    else:
        done.append(compared_whole(searched, least))
    found = reduce(DataFrame.unionByName, done)
    joined = nodes.join(found, "node", "left").select(
        "node", "label", "unit", "m", "first_id",
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("grp", "node").alias("grp"),
    )
    joined = cut(joined, "nn-joined")
    named = joined.groupBy("grp").agg(F.min("first_id").alias("component_id"))
    of_node = cut(
        joined.join(named, "grp").select(
            "label", "unit", (F.col("links") + F.col("m") - 1).alias("n_links"), "component_id"
        ),
        "nn-named",
    )
    linked = rows.filter("unit is not null").join(of_node, ["label", "unit"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("unit is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return linked.unionByName(alone).withColumn("kept", kept)


def op3_nn_descent(spark, sf_dir: str) -> DataFrame:
    """Per vector: how many it links with, its component, and whether it stays."""
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP3_SQL = """
with recursive unit as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
), links as (
  select a.vec_id as a, b.vec_id as b from unit a join unit b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.93
), reach(a, b) as (
  select vec_id, vec_id from embeddings
  union
  select reach.a, links.b from reach join links on reach.b = links.a
), components as (
  select a as vec_id, min(b) as component_id from reach group by a
), counts as (
  select a as vec_id, count(*) as n from links group by a
)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from components left join counts using (vec_id)
"""
