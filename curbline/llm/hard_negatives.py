"""Hard negatives by best-first search in STR-packed R-trees.

Components become integers, ``floor(scale * x)``, and a score is an integer inner product. Rows are dealt into slabs by ranges of label and
first coordinates; a slab is packed by sort-tile-recursive: its rows are sorted and cut along one coordinate after
the other, widest first, until a tile is a page. A page is one row of the written index, with its minimum bounding box, its range of labels and its
smallest id; parents of ``FAN`` neighbouring boxes and the boxes of whole slabs follow from it.

A box gives an interval of scores with an anchor, coordinate by coordinate. A search visits boxes best first and drops those
whose labels do not fit, whose interval misses the score window, that lie strictly below the k-th score found, or that tie
with it and hold greater ids only. Across slabs it runs in two rounds: each anchor's most promising slab gives it a k-th score, and
then come the slabs that may still beat it. Both are joins of a block of anchors with a slab's pages, so no task holds more than those.

The first ``positives`` rows of an anchor's label are its positives; each of their scores is the top of a window
``floor/cap`` hundredths wide, searched among the rows of other labels. Anchors that are equal search once. Of equal rows with one label the
smallest ids alone can be returned, so more than that many are set aside before the search (a window with a limit, applied before the shuffle too).

Defined cases: rows whose vec_id, label or vector is null, whose vector holds a null or non-finite component, or a component
of ``LARGEST`` or more after scaling (their products would leave a long), take no part. An empty vector scores 0 with all; a shorter vector counts as
padded by zeros. Of rows that share a vec_id the one with the smallest label, then vector, takes part.
An anchor without another row of its label, or a positive without a row in its window, gives no row. An empty table gives an
empty result. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import cut, release, table

#: Fixed values of the contract.
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
FLOOR, CAP = 80, 100
ANCHOR_EVERY = 100

#: Rows of a slab and of a page, children of a box, anchors that meet a slab at once.
SLAB_ROWS = 16_384
PAGE_ROWS = 128
FAN = 16
BLOCK_ANCHORS = 1024
#: Components reach this at most, so that 1,024 products add up to less than a long.
LARGEST = 1 << 26


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part, one for each id."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale))
    finite = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v.cast("double") * scale) < LARGEST))
    rows = vectors.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    typed = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.cast("array<int>").alias("q"))
    return typed.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row")).select("vec_id", "row.*")


def thinned(rows: DataFrame, most: int) -> DataFrame:
    """Of rows equal in label and vector those with the ``most`` smallest ids."""
    order = Window.partitionBy("label", "q").orderBy("vec_id")
    return rows.withColumn("copy", F.row_number().over(order)).filter(F.col("copy") <= most).drop("copy")


def padded(vectors: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Vectors as rows of one width, zeros behind shorter ones."""
    column = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), max(width, int(lengths.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def packed(points: np.ndarray, rows: np.ndarray, page: int) -> Iterator[np.ndarray]:
    """Pages of rows by sort-tile-recursive over the coordinates, those that vary most first."""
    order = np.argsort(-points[rows].var(axis=0), kind="stable").tolist() if points.shape[1] else []

    def tile(rows: np.ndarray, dims: list[int]) -> Iterator[np.ndarray]:
        pages = -(-len(rows) // page)
        if pages <= 1:
            yield rows
            return
        if not dims:
            for start in range(0, len(rows), page):
                yield rows[start : start + page]
            return
        slabs = int(np.ceil(pages ** (1 / len(dims)) - 1e-9))
        step = -(-pages // slabs) * page
        along = rows[np.argsort(points[rows, dims[0]], kind="stable")]
        for start in range(0, len(along), step):
            yield from tile(along[start : start + step], dims[1:])

    yield from tile(rows, order)


PAGES = (
    "slab int, ids array<long>, labels array<long>, points array<int>, lo array<int>, hi array<int>, "
    "label_lo long, label_hi long, least long, many int"
)


def page_index(rows: DataFrame, slab_rows: int = SLAB_ROWS, page: int = PAGE_ROWS) -> DataFrame:
    """The pages of all slabs, one row each. Labels with a page's rows or more have pages of their own."""
    slabs = max(1, -(-rows.count() // slab_rows))
    first = [F.get("q", F.lit(place)) for place in range(2)]
    dealt = rows.repartitionByRange(slabs, "label", *first, "vec_id").withColumn("slab", F.spark_partition_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        points, ids, labels = padded(rows["q"]), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        by_label = np.lexsort((ids, labels))
        values, starts, counts = np.unique(labels[by_label], return_index=True, return_counts=True)
        few = np.repeat(counts < page, counts)
        groups = [by_label[s : s + n] for s, n in zip(starts, counts, strict=True) if n >= page]
        groups += [by_label[few]] if few.any() else []
        tiles = [tile for group in groups for tile in packed(points, group, page)]
        slab = rows["slab"][0].as_py()
        for tile in tiles:
            own = points[tile]
            made = {
                "slab": [slab], "ids": [ids[tile]], "labels": [labels[tile]], "points": [own.ravel()],
                "lo": [own.min(axis=0)], "hi": [own.max(axis=0)],
                "label_lo": [labels[tile].min()], "label_hi": [labels[tile].max()], "least": [ids[tile].min()], "many": [len(tile)],
            }
            yield pa.RecordBatch.from_pydict(made, schema=PAGE_SCHEMA)

    return cut(dealt.select("slab", "vec_id", "label", "q").mapInArrow(pack, PAGES), "hard-pages")


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
PAGE_SCHEMA = pa.schema(
    [("slab", pa.int32()), ("ids", _LONGS), ("labels", _LONGS), ("points", _INTS), ("lo", _INTS), ("hi", _INTS),
     ("label_lo", pa.int64()), ("label_hi", pa.int64()), ("least", pa.int64()), ("many", pa.int32())]
)


def slab_boxes(pages: DataFrame) -> DataFrame:
    """``slab, lo, hi, label_lo, label_hi, dir_block``: a row per slab."""
    sides = pages.select("slab", F.posexplode_outer(F.arrays_zip("lo", "hi")).alias("place", "side"))
    by_place = sides.groupBy("slab", "place").agg(F.min("side.lo").alias("lo"), F.max("side.hi").alias("hi"))
    gathered = by_place.groupBy("slab").agg(
        F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "lo", "hi")))).alias("sides")
    )
    labels = pages.groupBy("slab").agg(F.min("label_lo").alias("label_lo"), F.max("label_hi").alias("label_hi"))
    return gathered.join(labels, "slab").select(
        "slab", F.col("sides.lo").alias("lo"), F.col("sides.hi").alias("hi"), "label_lo", "label_hi"
    )


class Boxes:
    """The boxes of one level of a slab's tree, or of the slabs themselves."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, label_lo: np.ndarray, label_hi: np.ndarray, least: np.ndarray):
        self.lo, self.hi, self.label_lo, self.label_hi, self.least = lo, hi, label_lo, label_hi, least

    def parents(self) -> Boxes:
        starts = np.arange(0, len(self.least), FAN)
        low, high = np.minimum.reduceat, np.maximum.reduceat
        return Boxes(low(self.lo, starts, axis=0), high(self.hi, starts, axis=0), low(self.label_lo, starts),
                     high(self.label_hi, starts), low(self.least, starts))

    def intervals(self, anchor: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of any point in each box."""
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        lo, hi = self.lo[rows], self.hi[rows]
        return lo @ up + hi @ down, hi @ up + lo @ down

    def fits(self, label: int, same: bool, rows: slice) -> np.ndarray:
        """Whether a box may hold a row of the anchor's label, or of another one."""
        lo, hi = self.label_lo[rows], self.label_hi[rows]
        return (lo <= label) & (label <= hi) if same else (lo != label) | (hi != label)


def exact_type(left: np.ndarray, right: np.ndarray) -> type:
    """Doubles where every sum of products is exact in them, else longs."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    return np.float64 if most < 1 << 53 else np.int64


class Tree:
    """A slab's pages as a packed R-tree: every level's boxes lie in the order of the pages."""

    def __init__(self, pages: pa.Table, width: int, anchors: np.ndarray):
        many = pages["many"].to_numpy()
        self.edges = np.concatenate([[0], np.cumsum(many)])
        self.ids = pages["ids"].combine_chunks().flatten().to_numpy()
        self.labels = pages["labels"].combine_chunks().flatten().to_numpy()
        own = pages["lo"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        points = np.zeros((len(self.ids), width), np.int64)
        points[np.arange(width) < np.repeat(own, many)[:, None]] = pages["points"].combine_chunks().flatten().to_numpy()
        self.kind = exact_type(points, anchors)
        self.points = points.astype(self.kind)
        lo, hi = (padded(pages[side], width).astype(self.kind) for side in ("lo", "hi"))
        self.levels = [Boxes(lo, hi, *(pages[c].to_numpy() for c in ("label_lo", "label_hi", "least")))]
        while len(self.levels[-1].least) > FAN:
            self.levels.append(self.levels[-1].parents())
        self.scores: dict[int, np.ndarray] = {}

    def search(self, anchor: np.ndarray, label: int, same: bool, window: tuple[float, float], most: int, kth: tuple):
        """The first ``most`` (score, id) inside the window, best first; ``kth`` is a (-score, id) to be beaten or None."""
        low, high = window
        found: list[tuple] = []  # a heap whose first is the worst: (score, -id)
        queue: list[tuple] = []

        def worst():
            return found[0] if len(found) >= most else kth

        def push(level: int, rows: slice) -> None:
            boxes = self.levels[level]
            lower, upper = boxes.intervals(anchor, rows)
            good = boxes.fits(label, same, rows) & (upper >= low) & (lower <= high)
            for place in np.flatnonzero(good).tolist():
                entry = (-min(upper[place], high), boxes.least[rows.start + place], level, rows.start + place)
                heapq.heappush(queue, entry)

        push(len(self.levels) - 1, slice(0, len(self.levels[-1].least)))
        while queue:
            bound, least, level, box = heapq.heappop(queue)
            end = worst()
            # What is left lies strictly below the k-th, or ties with it by greater ids only.
            if end is not None and -bound < end[0]:
                break
            if end is not None and -bound == end[0] and least > -end[1]:
                continue
            if level:
                push(level - 1, slice(box * FAN, min(box * FAN + FAN, len(self.levels[level - 1].least))))
                continue
            rows = slice(self.edges[box], self.edges[box + 1])
            if box not in self.scores:
                self.scores[box] = self.points[rows] @ anchor
            scores = self.scores[box]
            good = (scores >= low) & (scores <= high) & ((self.labels[rows] == label) == same)
            if end is not None:
                good &= scores >= end[0]
            for place in np.flatnonzero(good).tolist():
                entry = (int(scores[place]), -int(self.ids[rows.start + place]))
                if kth is not None and entry < kth:
                    continue
                if len(found) < most:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
        return found


FOUND = "probe long, cap long, id long, score long"


def in_slabs(pages: DataFrame, jobs: DataFrame, same: bool, most: int) -> DataFrame:
    """``probe, cap, id, score`` of the ``jobs`` (slab, block and anchor), each slab's pages read once a block of anchors."""
    places = jobs.select(F.col("slab").alias("met"), F.col("block").alias("with")).distinct()
    left = pages.join(places, F.col("slab") == F.col("met")).withColumn("key", F.xxhash64("met", "with")).drop("met", "with")
    right = jobs.withColumn("key", F.xxhash64("slab", "block"))

    def run(pages: pa.Table, jobs: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        slabs = jobs["slab"].to_numpy() if jobs.num_rows else np.zeros(0, np.int32)
        for slab in np.unique(slabs).tolist():  # keys of 64 bits may meet
            own = pages.filter(pc.equal(pages["slab"], slab))
            todo = jobs.filter(pc.equal(jobs["slab"], slab))
            anchors = padded(todo["q"])
            width = max(anchors.shape[1], int(own["lo"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0)))
            anchors = np.pad(anchors, ((0, 0), (0, width - anchors.shape[1])))
            tree = Tree(own, width, anchors)
            labels = todo["label"].to_numpy()
            windows = todo["windows"].to_pylist()
            for row, probe in enumerate(todo["probe"].to_pylist()):
                tree.scores.clear()
                for each in windows[row]:
                    window = (-np.inf, np.inf) if each["cap"] is None else (each["low"], each["cap"])
                    kth = None if each["score"] is None else (each["score"], -each["id"])
                    hits = tree.search(anchors[row].astype(tree.kind), labels[row], same, window, most, kth)
                    out += [(probe, each["cap"], -minus, score) for score, minus in hits]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("probe", "cap", "id", "score"), columns, strict=True)})

    return left.groupBy("key").cogroup(right.groupBy("key")).applyInArrow(run, FOUND)


def promising(boxes: DataFrame, probes: DataFrame, same: bool) -> DataFrame:
    """``slab`` and what a probe has, with the interval of its scores, where labels fit and a window is met."""
    up = F.aggregate(F.zip_with("q", "sides", _greatest), F.lit(0).cast("long"), lambda a, b: a + b)
    down = F.aggregate(F.zip_with("q", "sides", _least), F.lit(0).cast("long"), lambda a, b: a + b)
    fits = F.col("label").between(F.col("label_lo"), F.col("label_hi"))
    if not same:
        fits = (F.col("label_lo") != F.col("label")) | (F.col("label_hi") != F.col("label"))
    blocks = boxes.select("slab", "label_lo", "label_hi", F.arrays_zip("lo", "hi").alias("sides"), F.pmod("slab", F.lit(SLAB_BLOCKS)).alias("part"))
    asked = probes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SLAB_BLOCKS - 1))))
    met = blocks.join(asked, "part").filter(fits).withColumn("upper", up).withColumn("lower", down)
    useful = F.exists(
        "windows", lambda w: (w["cap"].isNull() | ((F.col("upper") >= w["low"]) & (F.col("lower") <= w["cap"])))
    )
    return met.filter(useful).drop("part", "sides", "label_lo", "label_hi", "lower")


#: Parts that the boxes of the slabs are dealt over when anchors meet them.
SLAB_BLOCKS = 8


def _greatest(x: Column, side: Column) -> Column:
    lo, hi = F.coalesce(side["lo"], F.lit(0)).cast("long"), F.coalesce(side["hi"], F.lit(0)).cast("long")
    x = F.coalesce(x, F.lit(0)).cast("long")
    return F.greatest(x * lo, x * hi)


def _least(x: Column, side: Column) -> Column:
    lo, hi = F.coalesce(side["lo"], F.lit(0)).cast("long"), F.coalesce(side["hi"], F.lit(0)).cast("long")
    x = F.coalesce(x, F.lit(0)).cast("long")
    return F.least(x * lo, x * hi)


WINDOW = "struct<cap:bigint,low:bigint,score:bigint,id:bigint>"


def searched(pages: DataFrame, boxes: DataFrame, probes: DataFrame, same: bool, most: int, label: str) -> DataFrame:
    """The first ``most`` rows of each probe's windows: ``probe, cap, id, score, rank``.

    ``probes`` has ``probe, block, label, q, windows``; each window's ``score, id`` are its k-th, null at first.
    """
    met = cut(promising(boxes, probes, same), f"hard-{label}-slabs")
    best = met.groupBy("probe").agg(F.max_by("slab", F.struct("upper", "slab")).alias("best"))
    marked = met.join(best, "probe")
    first = cut(in_slabs(pages, marked.filter("slab = best"), same, most), f"hard-{label}-first")
    order = Window.partitionBy("probe", "cap").orderBy(F.desc("score"), "id")
    last = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == most)
    ends = last.groupBy("probe").agg(F.collect_list(F.struct("cap", "score", "id")).alias("ends"))
    known = marked.filter("slab != best").join(ends, "probe", "left")
    with_ends = F.transform("windows", lambda w: _with_end(w))
    may_beat = F.exists("windows", lambda w: w["score"].isNull() | (F.col("upper") >= w["score"]))
    rest = known.withColumn("windows", with_ends.cast(f"array<{WINDOW}>")).filter(may_beat)
    found = first.unionByName(in_slabs(pages, rest.drop("ends"), same, most))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _with_end(window: Column) -> Column:
    """A window with the k-th score of the first round; a probe has few windows."""
    own = F.filter(F.coalesce("ends", F.array()), lambda e: e["cap"].eqNullSafe(window["cap"]))
    end = F.get(own, F.lit(0))
    return F.struct(window["cap"].alias("cap"), window["low"].alias("low"), end["score"].alias("score"), end["id"].alias("id"))


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    floor: int = FLOOR,
    cap: int = CAP,
    scale: int = SCALE,
    slab_rows: int = SLAB_ROWS,
    page: int = PAGE_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` names.

    ``vectors`` has ``vec_id, embedding, label``. A negative's score times ``cap`` lies between ``floor`` and ``cap`` times the positive's.
    """
    rows = cut(usable(vectors, scale), "hard-rows")
    # One more than is wanted of each, as an anchor may be among its own copies.
    pages = page_index(thinned(rows, max(positives + 1, negatives)), slab_rows, page)
    boxes = cut(slab_boxes(pages), "hard-boxes")
    chosen = rows.filter(anchors)
    distinct = chosen.groupBy("label", "q").agg(F.count("*").alias("copies"))
    probes = cut(distinct.select(F.monotonically_increasing_id().alias("probe"), "label", "q"), "hard-probes")
    blocks = max(1, -(-probes.count() // BLOCK_ANCHORS))
    probes = probes.withColumn("block", F.pmod(F.xxhash64("probe"), F.lit(blocks)).cast("int"))
    everything = F.array(F.struct(*[F.lit(None).cast("long").alias(n) for n in ("cap", "low", "score", "id")]))
    alike = searched(pages, boxes, probes.withColumn("windows", everything.cast(f"array<{WINDOW}>")), True, positives + 1, "alike")
    alike = cut(alike.select("probe", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "hard-alike")
    # The least integer whose product with ``cap`` reaches ``floor`` times the score.
    low = F.expr(f"-((-positive_score * {floor} - pmod(-positive_score * {floor}, {cap})) div {cap})")
    asked = alike.filter("positive_score >= 0").select("probe", F.struct(
        F.col("positive_score").alias("cap"), low.alias("low"),
        F.lit(None).cast("long").alias("score"), F.lit(None).cast("long").alias("id")).alias("window"))
    windows = asked.groupBy("probe").agg(F.collect_set("window").cast(f"array<{WINDOW}>").alias("windows"))
    other = searched(pages, boxes, probes.join(windows, "probe"), False, negatives, "other")
    order = Window.partitionBy("anchor_id", "probe").orderBy(F.desc("positive_score"), "positive_id")
    named = chosen.join(probes, ["label", "q"]).select(F.col("vec_id").alias("anchor_id"), "probe")
    pairs = named.join(alike, "probe").filter("positive_id != anchor_id")
    pairs = pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    other = other.select("probe", F.col("cap").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(other, ["probe", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine(vectors, F.col("vec_id") % ANCHOR_EVERY == 0)


OP13_SQL = f"""
with rows_ as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor({SCALE} * x::double)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), anchors as (
  select * from rows_ where vec_id % {ANCHOR_EVERY} = 0
), scored as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
  from anchors a join rows_ b on a.vec_id <> b.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES}
)
select anchor_id, positive_id, row_number() over (
    partition by anchor_id, positive_id order by score desc, vec_id)::integer as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and {FLOOR} * positive_score <= {CAP} * score and score <= positive_score
qualify rank <= {NEGATIVES}
"""
