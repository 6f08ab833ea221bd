"""Near duplicates by HyperMinHash sketches, confirmed on full shingle sets.

A text's set is that of its 5-word shingles, as 64-bit hashes.  The sketch has 256 registers: the hash's first bits choose
one, and it keeps the least of the hashes that chose it, as the number of its leading zeros and ten bits that follow.
Registers that no hash chose take the value of another one, in an order that differs from register to register.

Equal sets are one node, however many rows have them.  Nodes meet in bands of five registers; two sets that are 0.75 alike
have an even chance of 10**-6 to meet in none of 51 bands.  Among the nodes of a band's bucket links are then sought
in two steps, neither of which lists the pairs of a group:

1. Every node is compared with the one node of its buckets that meets most others, and linked nodes are joined.
2. In buckets that still hold more than one component, the nodes outside the bucket's largest component are compared
   with all others, in blocks of bounded size, by estimates from the registers: the share of equal registers, corrected for
   chance collisions.  Nodes of different components that can be 0.75 alike, by a margin of SIGMAS standard errors,
   form parts, and within each part links between components are confirmed on the full sets, again in blocks.

Components come from links alone, so no link between nodes that share a bucket is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import mapped, near, saved
from shoplake.llm.components import components, thinned

WORDS = 5
REGISTERS = 256
ROWS = 5
BANDS = REGISTERS // ROWS
# Nodes of a block, and about how many shingles it may have (8 bytes each).
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
# Nodes that a task joins before it names the edges and begins anew.
JOINED = 1 << 18
SIGMAS = 4.5
NUMERATOR, DENOMINATOR = 75, 100

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of all words together if there are fewer than five."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b"\0" + b" ".join(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    out = hashes[:n].copy()
    for k in range(1, WORDS):
        out = _mixed(out * _STEP + hashes[k : k + n])
    return np.unique(out)


@lru_cache(maxsize=1)
def _ranks() -> np.ndarray:
    """Row j: the order in which an empty register j looks for a full one."""
    rng = np.random.default_rng(20260801)
    return np.stack([rng.permutation(REGISTERS) for _ in range(REGISTERS)]).astype(np.uint8)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set, not empty: leading zeros times 1024 plus the ten bits after the first one."""
    full, first = np.unique(hashes >> np.uint64(56), return_index=True)
    full, rest = full.astype(np.int64), hashes[first] & np.uint64((1 << 56) - 1)
    zeros = 56 - np.frexp(rest.astype(np.float64))[1].clip(0, 56).astype(np.int64)
    bits = ((rest << zeros.astype(np.uint64)) >> np.uint64(45)) & np.uint64(1023)
    out = np.zeros(REGISTERS, np.uint16)
    out[full] = (zeros << 10).astype(np.uint16) | bits.astype(np.uint16)
    if len(full) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), full, assume_unique=True)
        out[empty] = out[full[_ranks()[empty][:, full].argmin(axis=1)]]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch (rows of registers)."""
    parts = sketches[:, : BANDS * ROWS].astype(np.uint64).reshape(len(sketches), BANDS, ROWS)
    out = np.broadcast_to(_mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP), (len(sketches), BANDS)).copy()
    for k in range(ROWS):
        out = _mixed(out * _STEP + parts[:, :, k] + np.uint64(1))
    return out.view(np.int64)


def small_registers(sketches: np.ndarray) -> np.ndarray:
    """Eight bits of each register, for estimates: five of the zeros and three of those that follow."""
    return (np.minimum(sketches >> 10, 31) << 3 | (sketches & 1023) >> 7).astype(np.uint8)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of all pairs of small sketches: equal registers, less those that are equal by chance."""
    equal = np.stack([(b == row).sum(axis=1) for row in a]) / REGISTERS
    shares = [np.stack([np.bincount(row, minlength=256) for row in x]) / REGISTERS for x in (a, b)]
    chance = shares[0] @ shares[1].T
    return (equal - chance) / np.maximum(1 - chance, 1e-9)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (null for an empty set) and sketch of every row."""

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, sketches = [], [], []
            for text in batch.column(2):
                hashes = shingle_set(text.as_py())
                n.append(len(hashes))
                ids.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None)
                sketches.append(registers(hashes).tobytes() if len(hashes) else None)
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "set_id", "sketch"])

    rows = docs.select("doc_id", "text_hash", "text")
    return mapped(rows, sketch, "doc_id long, text_hash long, n_shingles long, set_id binary, sketch binary")


def _banded(nodes: DataFrame) -> DataFrame:
    """key and node, for every band of every node."""

    def band(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sketches = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                keys, node = band_keys(sketches).reshape(-1), np.repeat(b.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(node)], ["key", "node"])

    return mapped(nodes.select("node", "sketch"), band, "key long, node long")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its full set, from the text of the node's first row."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py()).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])

    docs = near(docs, nodes.select("doc_id", "text_hash"))
    same = docs["doc_id"].eqNullSafe(nodes["doc_id"]) & (docs["text_hash"] == nodes["text_hash"])
    texts = docs.join(nodes.select("node", "doc_id", "text_hash"), same).select("node", "text")
    return mapped(texts, build, "node long, hashes binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets are 0.75 alike."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, last, held = [], None, None
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, held = a, np.frombuffer(x.as_buffer(), np.uint64)
                other = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(held, other, assume_unique=True))
                good.append(DENOMINATOR * both >= NUMERATOR * (len(held) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    met = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return mapped(met, confirm, "a long, b long")


def _stars(members: DataFrame) -> DataFrame:
    """For every node the one of its buckets' nodes that meets most others, as a pair (a: that one, b: the node)."""
    weight = members.groupBy("node").agg(F.sum("size").alias("meets"))
    weighted = members.join(weight, "node")
    center = weighted.groupBy("key").agg(F.max(F.struct("meets", "node")).alias("center"))
    best = members.join(center, "key").groupBy("node").agg(F.max("center").alias("center"))
    return best.where("center.node <> node").select(F.col("center.node").alias("a"), F.col("node").alias("b"))


class _Joined:
    """Union-find over whatever ids a block holds."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        top = x
        while (above := self.up.get(top, top)) != top:
            top = above
        while (above := self.up.get(x, x)) != top:
            self.up[x], x = top, above
        return top

    def join(self, x: int, y: int) -> bool:
        """Whether they were apart."""
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _alike(n_a: np.ndarray, n_b: np.ndarray, small_a: np.ndarray, small_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that can be 0.75 alike, by size and estimate, and the estimates."""
    low, high = np.minimum.outer(n_a, n_b), np.maximum.outer(n_a, n_b)
    guess = estimates(small_a, small_b)
    error = np.sqrt(0.75 * 0.25 / np.minimum(high, REGISTERS))
    return (DENOMINATOR * low >= NUMERATOR * high) & (guess >= 0.75 - SIGMAS * error), guess


def _unpacked(items: pa.StructArray) -> tuple[np.ndarray, ...]:
    small = np.frombuffer(b"".join(items.field("small").to_pylist()), np.uint8).reshape(-1, REGISTERS)
    return (*(items.field(c).to_numpy() for c in ("node", "comp", "n")), small)


def _crossing(members: DataFrame, comps: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes of different components that share a bucket and can be 0.75 alike, as a graph (a, b) with the same components.

    A task joins what its blocks find and names an edge from the least node of each part to each other one, however many pairs
    can be alike, so the edges of many buckets of one group are mostly the same.
    """
    own = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    shares = own.groupBy("key", "comp").count()
    open_keys = shares.groupBy("key").agg(
        F.max(F.struct("count", "comp")).alias("main"), F.count("*").alias("n_comps"), F.sum("count").alias("size")
    )
    open_keys = open_keys.where("n_comps > 1").select("key", F.col("main.comp").alias("main"), F.ceil(F.col("size") / BLOCK).alias("blocks"))
    rows = own.select("key", "node", "comp").join(open_keys, "key").join(nodes.select("node", "n", "small"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    item = F.struct("node", "comp", "n", "small")
    every = rows.groupBy("key", "block").agg(F.collect_list(item).alias("every"))
    minor = rows.where("comp <> main").groupBy("key", F.col("block").alias("part"), "blocks").agg(F.collect_list(item).alias("minor"))
    minor = minor.select("key", "minor", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

    def edges(joined: _Joined) -> pa.RecordBatch:
        found = [(joined.root(node), node) for node in list(joined.up)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))], ["a", "b"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = _Joined()
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                (a, comp_a, n_a, small_a), (b, comp_b, n_b, small_b) = _unpacked(left.values), _unpacked(right.values)
                fit, _ = _alike(n_a, n_b, small_a, small_b)
                i, j = np.nonzero(fit & np.not_equal.outer(comp_a, comp_b))
                for pair in zip(a[i].tolist(), b[j].tolist()):
                    joined.join(*pair)
                if len(joined.up) > JOINED:
                    yield edges(joined)
                    joined = _Joined()
        yield edges(joined)

    blocks = minor.join(every, ["key", "block"]).select("minor", "every")
    return mapped(blocks, compare, "a long, b long").distinct()


def _linked(crossing: DataFrame, comps: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components, confirmed on the full sets: enough to join all components that any link joins.

    Each connected part of the crossing graph is compared within itself, in blocks of bounded size, so a set is sent to
    one task, or in large parts to as many as the part has blocks.  The likeliest pairs come first; pairs whose
    components are joined by then need no look at their sets.
    """
    parts = components(thinned(crossing)).withColumnRenamed("comp", "part")
    rows = parts.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    rows = rows.join(nodes.select("node", "n", "small"), "node").join(sets, "node")
    # Summed without the sets and written, so that their size is known and a large part is not dealt to one task to learn it.
    sizes = parts.join(nodes.select("node", "n"), "node").groupBy("part").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("total") / BLOCK_SHINGLES))
    rows = rows.join(saved(sizes.select("part", blocks.alias("blocks")), "sizes"), "part")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    item = F.collect_list(F.struct("node", "comp", "n", "small", "hashes"))
    held = saved(rows.groupBy("part", "block", "blocks").agg(item.alias("items")), "blocks")
    left = held.select("part", F.col("items").alias("left"), F.col("block").alias("first"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block"))
    pairs = left.join(held.select("part", "block", F.col("items").alias("right")), ["part", "block"]).select("left", "right")

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                (a, comp_a, n_a, small_a), (b, comp_b, n_b, small_b) = _unpacked(left.values), _unpacked(right.values)
                fit, guess = _alike(n_a, n_b, small_a, small_b)
                i, j = np.nonzero(fit & np.not_equal.outer(comp_a, comp_b))
                order = np.argsort(-guess[i, j], kind="stable")
                sets_a, sets_b = left.values.field("hashes"), right.values.field("hashes")
                joined, links = _Joined(), []
                for x, y in zip(i[order].tolist(), j[order].tolist()):
                    if joined.root(comp_a[x].item()) != joined.root(comp_b[y].item()):
                        p = np.frombuffer(sets_a[x].as_buffer(), np.uint64)
                        q = np.frombuffer(sets_b[y].as_buffer(), np.uint64)
                        both = len(np.intersect1d(p, q, assume_unique=True))
                        if DENOMINATOR * both >= NUMERATOR * (len(p) + len(q) - both):
                            joined.join(comp_a[x].item(), comp_b[y].item())
                            links.append((a[x].item(), b[y].item()))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

    return mapped(pairs, confirm, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`classified` without what tells rows of one id apart."""
    return classified(docs, id_col, text_col).drop("text_hash", "first")


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least id that links reach) and kept (the row has that id) of every row.

    Texts without words are linked with nothing.  Rows that repeat a text are one node, so all of them with the least id are
    kept.  Null ids come after all others: their component has a null id only if all of its rows have, and is then kept.
    `text_hash` and the id name a row; `first` holds for one such name of each component, the least one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    sketches = saved(sketched(rows), "sketches", "zstd")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row")
    nodes = sketches.where("set_id is not null").groupBy("set_id").agg(
        first, F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "set_id", "row.doc_id", "row.text_hash", "n", "sketch")
    nodes = saved(nodes, "nodes", "zstd")
    bands = saved(_banded(nodes), "bands", "zstd")
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = saved(bands.join(shared, "key"), "members", "zstd")
    some = members.select("node").distinct()
    sets = saved(_sets(rows, nodes.join(some, "node")), "sets")
    links = saved(_confirmed(_stars(members), sets), "links")
    comps = components(links)

    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                full = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                small = pa.array([r.tobytes() for r in small_registers(full)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), small], ["node", "n", "small"])

    small = mapped(nodes.join(some, "node").select("node", "n", "sketch"), shrink, "node long, n long, small binary")
    small = saved(small, "small")
    crossing = saved(_crossing(members, comps, small), "crossing")
    more = saved(_linked(crossing, comps, small, sets), "links")
    if not more.isEmpty():
        comps = components(links.unionAll(more))

    named = nodes.select("node", "set_id", "doc_id", "text_hash").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = saved(named, "classes")
    row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row")
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"), row)
    classes = named.select("comp", "set_id").join(least, "comp").select("set_id", "component_id", "row")
    out = sketches.select("doc_id", "text_hash", "n_shingles", "set_id").join(classes, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    first = F.col("doc_id").eqNullSafe(F.col("row.doc_id")) & (F.col("text_hash") == F.col("row.text_hash"))
    first = F.col("set_id").isNull() | F.coalesce(first, F.lit(False))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), first.alias("first")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )
