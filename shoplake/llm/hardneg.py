"""Hard negatives: candidates in blocks along a Hilbert curve, with zone maps that tell which blocks an anchor must read.

Candidate vectors of whole numbers are ordered by their place on a Hilbert curve through all dimensions and written as Parquet
in blocks of BLOCK rows, neighbours on the curve together.  A zone map holds for each block the least and the largest value of
each dimension and how many rows each label has.  By interval arithmetic the inner product of an anchor with any row of a
block lies between

    sum(min(a_d * lo_d, a_d * hi_d))   and   sum(max(a_d * lo_d, a_d * hi_d)).

For each block of anchors, a stated set of bounded size:

* blocks whose lower bounds are highest and that hold enough rows of the anchor's label guarantee a score that its positives
  reach; only blocks of that label whose upper bound reaches it are read for positives;
* a positive of score p opens the window low * p <= score <= high * p; only blocks with rows of another label whose bounds
  overlap a window are read for negatives.

Zone maps are read without the vectors.  What a block holds is decided by exact products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplake.llm.common import fresh_path, saved
from shoplake.llm.sharding import numbered
from shoplake.llm.topk import EXACT, _matrix, whole_numbers

# Rows of a block (a power of two), anchors that every task gets at a time, and bits of a dimension on the curve.
BLOCK_BITS = 8
ANCHORS = 4096
CURVE_BITS = 4
NONE = np.iinfo(np.int64).min


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve (big-endian bytes) of points with `bits` bits in each dimension.

    The Gray-code form of the curve: reflections and exchanges of axes are undone from the highest bit down, then the
    bits of all axes are interleaved.
    """
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        at, low = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for d in range(dims):
            set_ = (x[d] & at) != 0
            swap = np.where(set_, 0, (x[0] ^ x[d]) & low).astype(np.uint32)
            x[0] ^= np.where(set_, low, swap).astype(np.uint32)
            x[d] ^= swap if d else np.uint32(0)
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << bit), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).astype(np.uint8).T, axis=1)


def _extent(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest value of each dimension; the driver gets a row for each of them."""

    def ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(0), width)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(m.min(0)), pa.array(m.max(0))], ["d", "lo", "hi"])

    ends_ = rows.select("v").mapInArrow(ends, "d long, lo long, hi long").groupBy("d").agg(F.min("lo"), F.max("hi"))
    lo, hi = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for d, least, most in ends_.collect():
        lo[d], hi[d] = least, most
    return lo, hi


def _on_curve(rows: DataFrame, width: int) -> DataFrame:
    """Adds `place`, the rows' key on the curve through the box that holds them all."""
    lo, hi = _extent(rows, width)
    step = np.maximum((hi.astype(float) - lo) / (1 << CURVE_BITS), 1e-9)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = ((_matrix(b.column("v"), width) - lo.astype(float)) / step).clip(0, (1 << CURVE_BITS) - 1)
            keys = hilbert_keys(cells, CURVE_BITS)
            yield b.append_column("place", pa.array([k.tobytes() for k in keys], pa.binary()))

    return rows.mapInArrow(keyed, "vec_id long, label long, v array<long>, place binary")


def blocked(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The candidates (part, block, vec_id, label, v) in blocks along the curve, and the blocks' zone maps.

    Directories of `part`, a range of the curve, let a join on it skip whole files.
    """
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "blocks")
    tied = _on_curve(rows, width).withColumn("_tie", F.monotonically_increasing_id())
    order = ["place", "vec_id", "_tie"]
    ranged = tied.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = ranged.select(
        F.shiftright("_at", BLOCK_BITS).alias("block"), "vec_id", "label", "v", F.shiftright("_at", 33).cast("int").alias("part")
    )
    placed.write.option("compression", "zstd").partitionBy("part").parquet(path)
    schema = "block long, vec_id long, label long, v array<long>, part int"
    return spark.read.schema(schema).parquet(path), saved(_zones(spark.read.schema(schema).parquet(path), width), "zones")


def _zones(blocks: DataFrame, width: int) -> DataFrame:
    """block, part, lo, hi, labels and counts of each block."""

    def zoned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            m, block, part = _matrix(b.column("v"), width), b.column("block").to_numpy(), b.column("part").to_numpy()
            label = b.column("label").to_numpy()
            lines = []
            for at in np.unique(block):
                here = np.flatnonzero(block == at)
                of, n = np.unique(label[here], return_counts=True)
                lines.append((int(at), int(part[here[0]]), m[here].min(0), m[here].max(0), of, n))
            types = [pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), types)], ["block", "part", "lo", "hi", "labels", "counts"])

    schema = "block long, part int, lo array<long>, hi array<long>, labels array<long>, counts array<long>"
    pieces = blocks.mapInArrow(zoned, schema)  # a block may be cut by the batches it is read in

    def least(c: str, fn: str) -> Column:
        lists = F.collect_list(c)
        return F.aggregate(lists, F.element_at(lists, 1), lambda a, x: F.zip_with(a, x, lambda p, q: F.call_function(fn, p, q)))

    return pieces.groupBy("block", "part").agg(
        least("lo", "least").alias("lo"),
        least("hi", "greatest").alias("hi"),
        F.flatten(F.collect_list("labels")).alias("labels"),
        F.flatten(F.collect_list("counts")).alias("counts"),
    )


class _Anchors:
    """A block of anchors: their ids, labels, vectors and rows of their id; and once known, what their scores must reach."""

    def __init__(self, table: pa.Table, width: int):
        self.ids, self.labels, self.copies = (table.column(c).to_numpy() for c in ("vec_id", "label", "copies"))
        parts = [_matrix(c, width) for c in table.column("v").chunks]
        self.rows = np.concatenate(parts) if parts else np.zeros((0, width), np.int64)
        self.wide = self.rows.astype(np.float64)
        self.size = np.abs(self.wide).sum(axis=1)
        self.bar = np.full(len(self.ids), NONE)
        # Windows of the positives, in the order of their anchors.
        self.of = np.zeros(0, np.int64)
        self.low = self.high = self.positive = self.of

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest product of each anchor with a box, a rounding error wider than they are."""
        lo, hi = lo.astype(np.float64), hi.astype(np.float64)
        up, down = np.maximum(self.wide, 0), np.minimum(self.wide, 0)
        slack = self.size * max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0)) * 1e-12
        return up @ lo + down @ hi - slack, up @ hi + down @ lo + slack

    def products(self, which: np.ndarray, rows: np.ndarray) -> np.ndarray:
        most = float(np.abs(rows).max(initial=0)) * float(self.size[which].max(initial=0))
        if most < EXACT:
            return (self.wide[which] @ rows.T.astype(np.float64)).astype(np.int64)
        return self.rows[which] @ rows.T


def _each_zone(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("block", "part", "lo", "hi", "labels", "counts"))):
            yield (*row[:2], *(np.array(x, np.int64) for x in row[2:]))


def _rows_of(wanted: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many rows of each wanted label a block holds."""
    of, where = np.unique(labels, return_inverse=True)
    n = np.bincount(where, counts, len(of)).astype(np.int64)
    at = np.searchsorted(of, wanted).clip(0, max(0, len(of) - 1))
    return np.where(of[at] == wanted, n[at], 0) if len(of) else np.zeros(len(wanted), np.int64)


def _guaranteed(zones: DataFrame, anchors: _Anchors, positives: int) -> np.ndarray:
    """A score that the positives of each anchor reach, by the zone maps alone."""
    sent = zones.sparkSession.sparkContext.broadcast(anchors)

    def lower(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value
        need = positives + a.copies
        bound, held = np.zeros((0, len(a.ids))), np.zeros((0, len(a.ids)), np.int64)
        zones_, more = _each_zone(batches), True
        while more:
            some = list(islice(zones_, 64))
            more = bool(some)
            bound = np.vstack([bound, *(a.bounds(lo, hi)[0] for _, _, lo, hi, _, _ in some)])
            held = np.vstack([held, *(_rows_of(a.labels, labels, counts) for *_, labels, counts in some)])
            bound[held == 0] = -np.inf
            # The highest bounds that hold enough rows of the label; a block gives one row at least, so there are few.
            order = np.argsort(-bound, axis=0, kind="stable")
            bound, held = np.take_along_axis(bound, order, 0), np.take_along_axis(held, order, 0)
            held[np.cumsum(held, axis=0) - held >= need] = 0
            most = int((held > 0).sum(axis=0).max(initial=0))
            bound, held = bound[:most], held[:most]
        at, anchor = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(bound[at, anchor]), pa.array(held[at, anchor])], ["anchor", "bound", "n"])

    rows = zones.mapInArrow(lower, "anchor long, bound double, n long")
    order = Window.partitionBy("anchor").orderBy(F.desc("bound")).rowsBetween(Window.unboundedPreceding, 0)
    reached = rows.withColumn("held", F.sum("n").over(order))
    out = np.full(len(anchors.ids), float("-inf"))
    need = positives + anchors.copies
    # At most `need` rows of an anchor and task reach the window; one row of an anchor reaches the driver.
    needs = zones.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(need)], "anchor long, need long")
    for anchor, bound in reached.join(needs, "anchor").where("held >= need").groupBy("anchor").agg(F.max("bound")).collect():
        out[anchor] = bound
    return out


class _Best:
    """The first `k` of each anchor or window among (of, id, score); ties go to the smaller id."""

    def __init__(self, k: int, bar: np.ndarray):
        self.k, self.bar = k, bar.copy()
        self.kept = [np.zeros(0, np.int64)] * 3
        self.new: list[tuple[np.ndarray, ...]] = []

    def take(self, of: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.new.append((of, ids, scores))
        if sum(len(n[0]) for n in self.new) > 1 << 18:
            self.settle()

    def settle(self) -> None:
        of, ids, scores = (np.concatenate([k, *new]) for k, new in zip(self.kept, zip(*self.new))) if self.new else self.kept
        order = np.lexsort((ids, -scores, of))
        of, ids, scores = of[order], ids[order], scores[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        keep = rank < self.k
        last = rank == self.k - 1
        self.bar[of[last]] = np.maximum(self.bar[of[last]], scores[last])
        self.kept, self.new = [of[keep], ids[keep], scores[keep]], []

    def batch(self) -> pa.RecordBatch:
        self.settle()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in self.kept], ["of", "vec_id", "score"])


class _Positives(_Best):
    def __init__(self, a: _Anchors, k: int):
        super().__init__(k, a.bar)
        self.a = a

    def add(self, who: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        a, scores = self.a, self.a.products(who, rows)
        good = (labels == a.labels[who, None]) & (ids != a.ids[who, None]) & (scores >= self.bar[who, None])
        i, j = np.nonzero(good)
        self.take(who[i], ids[j], scores[i, j])


class _Negatives(_Best):
    def __init__(self, a: _Anchors, k: int):
        super().__init__(k, a.low)
        self.a = a

    def add(self, who: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        a, scores = self.a, self.a.products(who, rows)
        other = (labels != a.labels[who, None]) & (ids != a.ids[who, None])
        place = np.full(len(a.ids), -1)
        place[who] = np.arange(len(who))
        windows = np.flatnonzero(place[a.of] >= 0)
        for some in np.array_split(windows, max(1, len(windows) // 1024)):
            at = place[a.of[some]]
            s = scores[at]
            i, j = np.nonzero(other[at] & (s >= self.bar[some, None]) & (s <= a.high[some, None]))
            self.take(some[i], ids[j], s[i, j])


# Whether each anchor needs a block: by the least and largest products with its zone, and the labels in it.
Wanted = Callable[[_Anchors, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _for_positives(a: _Anchors, least: np.ndarray, most: np.ndarray, labels: np.ndarray) -> np.ndarray:
    return np.isin(a.labels, labels) & (most >= a.bar)


def _for_windows(a: _Anchors, least: np.ndarray, most: np.ndarray, labels: np.ndarray) -> np.ndarray:
    marks = np.zeros(len(a.ids), bool)
    marks[a.of[(a.low <= a.high) & (most[a.of] >= a.low) & (least[a.of] <= a.high)]] = True
    return marks & ((len(np.unique(labels)) > 1) | ~np.isin(a.labels, labels))


def _read(blocks: DataFrame, zones: DataFrame, anchors: _Anchors, wanted: Wanted, found: Callable[[_Anchors], _Best]) -> DataFrame:
    """What `found` makes of the blocks that `wanted` chooses by their zone maps, with the anchors that want them."""
    sc = zones.sparkSession.sparkContext
    sent, width = sc.broadcast(anchors), anchors.rows.shape[1]

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value
        for block, part, lo, hi, labels, _ in _each_zone(batches):
            marks = wanted(a, *a.bounds(lo, hi), labels)
            if marks.any():
                cols = [pa.array([block]), pa.array([part], pa.int32()), pa.array([np.packbits(marks).tobytes()])]
                yield pa.RecordBatch.from_arrays(cols, ["block", "part", "who"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, best = sent.value, found(sent.value)
        for b in batches:
            block, ids, labels = (b.column(c).to_numpy() for c in ("block", "vec_id", "label"))
            rows, who = _matrix(b.column("v"), width), b.column("who")
            at, first = np.unique(block, return_index=True)
            for one, line in zip(at, first):
                here = np.flatnonzero(block == one)
                marks = np.unpackbits(np.frombuffer(who[int(line)].as_py(), np.uint8), count=len(a.ids))
                best.add(np.flatnonzero(marks), rows[here], ids[here], labels[here])
        yield best.batch()

    plan = saved(zones.mapInArrow(chosen, "block long, part int, who binary"), "plan")
    rows = blocks.join(plan.where(F.length("who") > 0), ["part", "block"]).select("block", "vec_id", "label", "v", "who")
    return rows.mapInArrow(search, "of long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("of").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _windows(anchors: _Anchors, positives: DataFrame, low: int, high: int) -> np.ndarray:
    """Opens the windows of the positives (at most ANCHORS times their number reach the driver); their ids."""
    rows = sorted(positives.select("of", "rank", "vec_id", "score").collect())
    of, _, ids, scores = np.array(rows, np.int64).reshape(-1, 4).T
    exact = [int(s) for s in scores]
    anchors.of, anchors.positive = of, scores
    anchors.low = np.array([-(-low * s // 100) for s in exact], np.int64)
    anchors.high = np.array([high * s // 100 for s in exact], np.int64)
    return ids


SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = ANCHORS,
) -> DataFrame:
    """For each anchor and each of its first positives (rows of its label) the first negatives (rows of another label) whose
    score lies from `low` to `high` hundredths of the positive's.

    Scores are inner products of floor(scale * x); higher ones come first, ties by smaller id.  `is_anchor` is a condition on
    `vec_id`.  Rows take no part if their id, label or vector is null or a component is null or not finite; shorter vectors are
    filled with zeros.  Rows that repeat an id are candidates of their own, but not for the anchor of that id; anchors among
    them are answered once, by the first in the order of label and vector.  Negative positive scores open no window, and an
    anchor without positives or a positive without negatives gives no row.  No rows give no rows; other columns are not read.
    """
    spark: SparkSession = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        whole_numbers(F.col(vector_col), scale).alias("v"),
    ).where("vec_id is not null and label is not null and v is not null")
    rows = saved(rows, "vectors")
    out = spark.createDataFrame([], SCHEMA)
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    asked = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("first"), F.count("*").alias("copies"))
    asked, n = numbered(asked.select("vec_id", "first.label", "first.v", "copies"), ["vec_id"])
    if not n:
        return out
    blocks, zones = blocked(rows, width)
    parts = []
    for first in range(0, n, block):
        some = asked.where(F.col("number").between(first, first + block - 1)).select("vec_id", "label", "v", "copies")
        anchors = _Anchors(some.toArrow(), width)
        reach = _guaranteed(zones, anchors, positives)
        anchors.bar = np.where(np.isfinite(reach), np.floor(reach.clip(-9e18, 9e18)), NONE).astype(np.int64)

        near = _ranked(_read(blocks, zones, anchors, _for_positives, lambda a: _Positives(a, positives)), positives)
        ids = _windows(anchors, saved(near, "positives"), low, high)
        if not len(ids):
            continue
        hard = _ranked(_read(blocks, zones, anchors, _for_windows, lambda a: _Negatives(a, negatives)), negatives)
        opened = pa.table(
            {"of": np.arange(len(ids)), "anchor_id": anchors.ids[anchors.of], "positive_id": ids, "positive_score": anchors.positive}
        )
        named = hard.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score")
        joined = named.join(spark.createDataFrame(opened), "of")
        parts.append(saved(joined.select(*(c.split()[0] for c in SCHEMA.split(", "))), "negatives"))
    for part in parts:
        out = out.unionAll(part)
    return out
