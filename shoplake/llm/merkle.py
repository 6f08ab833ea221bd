"""A Merkle manifest of a corpus: one tree for each language over its rows by id, and one tree over the languages.

Where a leaf stands in its tree is asked of an index instead of sorting the leaves.  The ids of a tree are set in bitmaps of
2**15 ids, merged from all tasks; a directory of popcounts says how many rows lie before each bitmap.  The rank of a row is
that number, and the bits below its own.  Ids that repeat, null ones too, are the exception: what they add is a small table,
and among themselves they go by their leaf.

Rank r puts a leaf into slot r mod 8 of run r div 8.  Runs are keyed arrays of eight slots, so a level is one grouping by
(tree, run) and nothing is sorted.  The lowest three levels are folded inside groups of 512 leaves; the levels above have an
eighth of the nodes each, and their siblings are handed down once for each group, not for each leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import ascii_lower, saved
from shoplake.llm.prefix import running
from shoplake.llm.sharding import numbered

FAN = 8
# Levels that are folded inside a group, and the leaves of a group.
INNER = 3
GROUP = FAN**INNER
# Ids of a bitmap: the size that Spark's bitmap functions have.
BITS = 15


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other; each must be text."""
    return F.sha2(F.concat(*parts), 256)


def spelt(value: Column) -> Column:
    """`-` for null, otherwise the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tree_of(lang: Column) -> Column:
    """A name that is never null and orders like the languages, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


# --- ranks -----------------------------------------------------------------------


def index(rows: DataFrame) -> DataFrame:
    """tree, bucket, bits (the ids of the bucket as a bitmap), ids, n (rows) and before (rows of the tree in earlier buckets).

    Tasks set bits on their own rows first, so a bucket moves as one bitmap for each task.  The bucket of null ids is null.
    """
    bucket = F.shiftright("doc_id", BITS).alias("bucket")
    at = F.col("doc_id").bitwiseAND((1 << BITS) - 1).alias("at")
    bits = rows.select("tree", bucket, at).groupBy("tree", "bucket")
    bits = bits.agg(F.bitmap_construct_agg("at").alias("bits"), F.count("*").alias("n"))
    bits = saved(bits.withColumn("ids", F.bitmap_count("bits")), "bitmaps", "zstd")
    places = running(bits.select("tree", "bucket", "n"), ["tree"], ["bucket"], F.col("n"), "before").drop("n")
    same = bits["tree"].eqNullSafe(places["tree"]) & bits["bucket"].eqNullSafe(places["bucket"])
    return saved(bits.join(places, same).select(bits["*"], "before"), "index", "zstd")


def _below(bits: Column, at: Column) -> Column:
    """How many bits are set below a position: whole bytes, and the rest of one."""
    whole = F.expr("at div 8").cast("int")
    # conv of the hex form reads one byte as a number.
    byte = F.conv(F.hex(F.substring(bits, whole + 1, F.lit(1))), 16, 10).cast("long")
    part = F.bit_count(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 8).cast("int")) - 1))
    return F.bitmap_count(F.substring(bits, F.lit(1), whole)) + part


def ranked(rows: DataFrame) -> DataFrame:
    """Adds `rank`, gapless from 0 in each tree by doc_id, null first, and among equal ids by leaf."""
    known = index(rows)
    placed = rows.select("*", F.shiftright("doc_id", BITS).alias("_bucket"), F.col("doc_id").bitwiseAND((1 << BITS) - 1).alias("at"))
    of = known.select(F.col("tree").alias("_tree"), "bucket", "bits", "before", (F.col("n") > F.col("ids")).alias("again"))
    met = placed.join(of, (F.col("tree") == F.col("_tree")) & F.col("_bucket").eqNullSafe(F.col("bucket")))
    met = met.withColumn("rank", F.col("before") + F.coalesce(_below(F.col("bits"), F.col("at")), F.lit(0)))
    met = saved(met.select(*rows.columns, "rank", "again", "bucket"), "ranks")
    if met.where("again").isEmpty():
        return met.drop("again", "bucket")
    # Buckets with repeated ids: the rows of an id are counted, and what an id has beyond one moves the later ids.
    some = met.where("again")
    ids = some.groupBy("tree", "bucket", "doc_id").agg((F.count("*") - 1).alias("more"))
    ids = ids.withColumn("key", F.concat_ws(":", "tree", F.col("bucket").cast("string")))
    moved = running(ids, ["key"], ["doc_id"], F.col("more"), "moved").select("tree", "doc_id", "moved", "more")
    moved = saved(moved, "moved").withColumnsRenamed({"tree": "_tree", "doc_id": "_id"})
    some = some.join(moved, (F.col("tree") == F.col("_tree")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    some = some.withColumn("rank", F.col("rank") + F.col("moved")).select(*rows.columns, "rank", "more")
    several = some.where("more > 0").drop("more").withColumn("key", F.concat_ws(":", "tree", F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    several = running(several, ["key"], ["leaf"], F.lit(1), "copy").withColumn("rank", F.col("rank") + F.col("copy"))
    out = met.where("not again").select(*rows.columns, "rank")
    return out.unionAll(some.where("more = 0").drop("more")).unionAll(several.select(*rows.columns, "rank"))


# --- levels ----------------------------------------------------------------------


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _folded(leaves: list[str], n: int) -> list[list[str]]:
    """The nodes of a group's levels, leaves first, in a tree of n leaves: at most INNER levels above them."""
    levels = [leaves]
    while n > 1 and len(levels) <= INNER:
        below = levels[-1]
        levels.append([_hash(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
        n = -(-n // FAN)
    return levels


def _path(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """The siblings left and right of a leaf's ancestors (itself first) inside its group."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % FAN
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + FAN])))
        at //= FAN
    return out


def _groups(rows: DataFrame, leaf: str, *others: str) -> DataFrame:
    """(tree, n, run, slots): groups of GROUP leaves as arrays in the order of their slots."""
    slot = F.struct((F.col("rank") % GROUP).cast("int").alias("slot"), F.col(leaf).alias("leaf"), *others)
    run = F.expr(f"rank div {GROUP}").alias("run")
    return rows.select("tree", "n", run, slot.alias("slot")).groupBy("tree", "n", "run").agg(F.array_sort(F.collect_list("slot")).alias("slots"))


def _tops(groups: DataFrame) -> DataFrame:
    """(tree, n, rank, hash): the node at the head of each group; n is how many such nodes the tree has."""

    def topped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads = [
                _folded([s["leaf"] for s in slots], n)[-1][0] for n, slots in zip(b.column("n").to_pylist(), b.column("slots").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("n"), b.column("run"), pa.array(heads, pa.string())], ["tree", "n", "rank", "hash"])

    rows = groups.select("tree", "n", "run", "slots.leaf")
    rows = rows.select("tree", "n", "run", F.transform("leaf", lambda x: F.struct(x.alias("leaf"))).alias("slots"))
    tops = rows.mapInArrow(topped, "tree string, n long, rank long, hash string")
    return tops.withColumn("n", F.expr(f"(n + {GROUP - 1}) div {GROUP}"))


def _raised(nodes: DataFrame) -> list[DataFrame]:
    """The runs (tree, n, run, slots) of every level of nodes up to the last with several nodes; written, each an eighth."""
    levels = []
    while True:
        nodes = nodes.where("n > 1")
        if nodes.isEmpty():
            return levels
        slot = F.struct((F.col("rank") % FAN).cast("int").alias("slot"), "hash")
        run = F.expr(f"rank div {FAN}").alias("run")
        runs = nodes.select("tree", "n", run, slot.alias("slot")).groupBy("tree", "n", "run").agg(F.array_sort(F.collect_list("slot")).alias("slots"))
        runs = saved(runs.select("tree", "n", "run", F.col("slots.hash").alias("slots")), "runs")
        levels.append(runs)
        parent = F.sha2(F.array_join("slots", ""), 256).alias("hash")
        nodes = runs.select("tree", F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.col("run").alias("rank"), parent)


NO_PATH = "array<struct<left:string,right:string>>"


def _paths(heads: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, rank, path): for each node the siblings beside it and its ancestors, the lowest first; from the top down."""
    none = F.array().cast(NO_PATH).alias("path")
    above = None
    for runs in reversed(levels):
        if above is None:
            met = runs.withColumn("up", none)
        else:
            up = above.select(F.col("tree").alias("_tree"), F.col("rank").alias("_rank"), F.col("path").alias("up"))
            met = runs.join(up, (F.col("tree") == F.col("_tree")) & (F.col("run") == F.col("_rank")), "left")
            met = met.withColumn("up", F.coalesce("up", none))
        one = met.select("tree", "run", "slots", "up", F.posexplode("slots").alias("at", "hash"))
        left = F.array_join(F.slice("slots", F.lit(1), F.col("at")), "").alias("left")
        right = F.array_join(F.slice("slots", F.col("at") + 2, F.lit(FAN)), "").alias("right")
        path = F.concat(F.array(F.struct(left, right)), "up").alias("path")
        above = saved(one.select("tree", (F.col("run") * FAN + F.col("at")).alias("rank"), path), "paths")
    single = heads.where("n = 1").select("tree", "rank", none)
    return single if above is None else single.unionAll(above)


def _roots(heads: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, hash): the last node of every tree."""
    out = heads.where("n = 1").select("tree", "hash")
    for runs in levels:
        out = out.unionAll(runs.where(F.col("n") <= FAN).select("tree", F.sha2(F.array_join("slots", ""), 256)))
    return out


# --- manifest --------------------------------------------------------------------


def manifest(
    docs: DataFrame,
    tampered: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    chars_col: str = "n_chars",
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (siblings of the leaf's ancestors from the bottom up, as a digest), folded_root and
    verified for every row.

    A leaf is the digest of id, source, language, n_chars and text.  Rows for which `tampered` (a condition on the input) holds
    are checked with their text's A-Z in lower case: `folded_root` is what that leaf and the siblings of the true one give, and
    `verified` tells whether it is the root.  Rows with null ids come first in their tree; rows with one id go by their leaf, so
    equal rows may change places, which changes nothing.  A null language is a tree of its own.  No rows give no rows.
    """
    fields = [F.col(c) for c in (id_col, source_col, lang_col, chars_col)]
    text = F.col(text_col)
    before = F.concat(*[spelt(f) for f in fields])
    forged = F.when(tampered, digest(before, spelt(ascii_lower(text)))) if tampered is not None else F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        tree_of(F.col(lang_col)).alias("tree"),
        digest(before, spelt(text)).alias("leaf"),
        forged.alias("forged"),
    )
    rows = saved(rows, "leaves")
    # Written, so that its size is known and the leaves need not be dealt by their tree.
    sizes = saved(rows.groupBy("tree").agg(F.count("*").alias("n")), "sizes")
    placed = ranked(rows).join(sizes, "tree")
    groups = saved(_groups(placed, "leaf", "doc_id", "forged"), "groups")
    heads = saved(_tops(groups), "heads")
    levels = _raised(heads)
    subroots = _roots(heads, levels).withColumnsRenamed({"hash": "subroot"})
    subroots, trees = numbered(subroots, ["tree"])
    # The tree over the languages.
    upper = subroots.select(F.lit("").alias("tree"), F.lit(trees).cast("long").alias("n"), F.col("number").alias("rank"), F.col("subroot").alias("hash"))
    runs = _raised(upper)
    root = (_roots(upper, runs).first() or [None, None])[1]
    over = _paths(upper, runs).select(F.col("rank").alias("number"), F.col("path").alias("over"))
    upto = subroots.join(over, "number").select(F.col("tree").alias("_tree"), "subroot", "over")
    inside = _paths(heads, levels).select(F.col("tree").alias("_of"), F.col("rank").alias("_rank"), "path")
    met = groups.join(inside, (F.col("tree") == F.col("_of")) & (F.col("run") == F.col("_rank"))).join(upto, F.col("tree") == F.col("_tree"))
    met = met.select("n", "slots", "subroot", F.concat("path", "over").alias("path"))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def proven(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, slots, subroot, up in zip(*(b.column(c).to_pylist() for c in ("n", "slots", "subroot", "path"))):
                levels_ = _folded([s["leaf"] for s in slots], n)
                higher = [(u["left"], u["right"]) for u in up]
                tail = "".join(left + right for left, right in higher).encode()
                lines = []
                for at, s in enumerate(slots):
                    own = _path(levels_, at)
                    proof = hashlib.sha256("".join(left + right for left, right in own).encode())
                    proof.update(tail)
                    node = s["forged"] or s["leaf"]
                    for left, right in (*own, *higher):
                        node = _hash(left, node, right)
                    lines.append((s["doc_id"], s["leaf"], subroot, root, proof.hexdigest(), node, node == root))
                types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), types)], names)

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return met.mapInArrow(proven, schema)
