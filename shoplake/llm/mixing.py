"""A corpus mixed to target weights: fixed-length blocks, multinomial draws for each output shard, pseudorandom indexes.

The words of a source, its rows in the order of (id, hash of the text), make one stream that is cut into blocks of BLOCK words;
the last block may be shorter.  Targets follow the weights, at most `most` times a source's words, and fix how many blocks
(slots) of each source the mix holds: whole passes over the source and then as many slots as the rest needs, the last of which
takes only the words still missing.

The mix is a number of output shards of SLOTS slots.  Each shard draws how many slots each source gets from a multinomial with
the sources' shares.  The draws of a source are numbered over all shards; where they go beyond what the source has to give, the
slots pass to the sources that were drawn too rarely, so the totals are exact.  Draw number g of a source with n blocks reads
block p(g mod n), p being a Feistel permutation of 0 .. n-1 that belongs to the source and the pass g div n; no block comes
a second time before all others came once.  Slots and blocks meet by (source, block).

Every random number is a function of the seed, the source and the shard, so reruns agree.  No table here has fewer rows than
the corpus but one with a row for each source; sources are numbered in ranges and drawn in bunches of BUNCH.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import saved
from shoplake.llm.prefix import running
from shoplake.llm.sharding import numbered

# Words of a block, slots of an output shard, and sources that are drawn together.
BLOCK = 256
SLOTS = 1024
BUNCH = 1024
ROUNDS = 6

# White space by bytes: a word is a run of others.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_counts(texts: pa.Array) -> np.ndarray:
    """How many words each text has; a null text has none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or cuts[0] == cuts[-1]:
        return np.zeros(len(texts), np.int64)
    word = ~_BLANK[np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]]]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    # A text's first byte starts a word whatever the text before it ends with.
    firsts = (cuts[:-1] - cuts[0])[cuts[:-1] < cuts[1:]]
    starts[firsts] = word[firsts]
    return np.diff(np.searchsorted(np.flatnonzero(starts), cuts - cuts[0]))


def _mix64(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers: two rounds of multiplying and folding."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Where the permutation of 0 .. n-1 with that key takes each index, or where it came from: a Feistel network on the least
    even number of bits, walked until it comes back below n."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2) + 0.0)).astype(np.int64) + 1) // 2).astype(np.uint64)
    bits += (np.uint64(1) << (np.uint64(2) * bits)) < n.astype(np.uint64)  # where the logarithm was rounded
    mask = (np.uint64(1) << bits) - np.uint64(1)
    key, out = key.astype(np.uint64), index.astype(np.uint64).copy()
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            b, m, k = bits[todo], mask[todo], key[todo]
            left, right = out[todo] >> b, out[todo] & m
            for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
                of = left if inverse else right
                f = _mix64(of * np.uint64(0x9E3779B97F4A7C15) + k + np.uint64(r + 1) * np.uint64(0xD1B54A32D192ED03)) & m
                left, right = (right ^ f, left) if inverse else (right, left ^ f)
            out[todo] = (left << b) | right
            todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _key(seed: int, source: np.ndarray, turn: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix64(_mix64(np.uint64(seed) + source.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + turn.astype(np.uint64))


@dataclass
class Mix:
    """What was decided: `sources` (no, source, size, target, blocks, slots, last), `docs` (no, at, doc_id, size and the hash of
    the text; `at` is where the row's words start in its source's stream), `draws` (shard, no, draw, block, words)."""

    sources: DataFrame
    docs: DataFrame
    draws: DataFrame
    block: int


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"), text.alias("text"),
    )

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # A few texts at a time, as their marks take as much memory as they do.
            sizes = [word_counts(b.column(3).slice(at, 256)) for at in range(0, b.num_rows, 256)]
            size = pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], size], ["doc_id", "source", "text_hash", "size"])

    return saved(rows.mapInArrow(counted, "doc_id long, source string, text_hash long, size long"), "sized")


def _targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds `target`: the words shared by weight; what lies above `most` times a source's words goes to the others by weight."""
    cap, weight = F.col("size") * most, F.col("weight")
    total = (sources.agg(F.sum("size")).first()[0] or 0) * share
    level, before = 0.0, None
    while level != before:
        full = cap <= level * weight
        done, rest = sources.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, weight))).first()
        level, before = ((total - (done or 0.0)) / rest if rest else level), level
    return sources.withColumn("target", F.least(cap, level * weight).cast("double"))


def _quotas(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Adds `blocks`, `slots` (of the mix) and `last` (words that the last slot takes)."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            no, size, target = (b.column(c).to_numpy() for c in ("no", "size", "target"))
            want, some = np.rint(target).astype(np.int64), np.maximum(size, 1)
            blocks = -(-size // block)
            passes, rest = want // some, want % some
            # The last, shorter block comes in the last pass at a known place.
            short = size - (blocks - 1) * block
            place = np.zeros(len(no), np.int64)
            held = np.flatnonzero(size > 0)
            place[held] = permuted(blocks[held] - 1, blocks[held], _key(seed, no[held], passes[held]), inverse=True)
            later = rest > place * block
            gap = np.where(later, block - short, 0)
            slots = np.where(rest > 0, np.maximum(-(-(rest + gap) // block), np.where(later, place + 1, 0)), 0)
            last = rest - np.where(slots > place + 1, (slots - 1) * block - (block - short), (slots - 1) * block)
            slots = passes * blocks + slots
            cols = [pa.array(np.where(size > 0, x, 0)) for x in (blocks, slots, np.where(rest > 0, last, block))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, "blocks", "slots", "last"])

    schema = "no long, source string, size long, weight long, target double, blocks long, slots long, last long"
    return sources.select("no", "source", "size", "weight", "target").mapInArrow(counted, schema)


def _multinomial(rows: DataFrame, names: list[str], schema: str, seed: int) -> DataFrame:
    """Rows (shard, bunch, n, nos, shares) to (shard, no, n): n draws with those shares."""

    def drawn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
            for shard, bunch, n, nos, shares in zip(*(c.to_pylist() for c in b.columns)):
                p = np.array(shares, float)
                counts = np.random.default_rng([seed, shard, bunch + 1]).multinomial(n, p / p.sum())
                hit = np.flatnonzero(counts)
                out.append(np.stack([np.full(len(hit), shard), np.array(nos, np.int64)[hit], counts[hit]]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], names)

    return rows.mapInArrow(drawn, schema)


def _drawn(sources: DataFrame, slots: int, seed: int) -> DataFrame:
    """(shard, no, n): how many slots of each shard a source gets."""
    spark = sources.sparkSession
    live = sources.where("slots > 0").withColumn("bunch", F.expr(f"no div {BUNCH}"))
    lists = F.array_sort(F.collect_list(F.struct("no", "slots"))).alias("of")  # BUNCH sources at most
    bunches = live.groupBy("bunch").agg(F.sum("slots").alias("all"), lists)
    bunches = saved(bunches.select("bunch", "all", "of.no", "of.slots"), "bunches")
    totals = sorted((r.bunch, r["all"]) for r in bunches.select("bunch", "all").collect())  # a row for BUNCH sources
    m = sum(n for _, n in totals)
    shards = spark.range(-(-m // slots)).select(
        F.col("id").alias("shard"), F.lit(-1).cast("long").alias("bunch"), F.least(F.lit(slots), m - F.col("id") * slots).alias("n")
    )
    first = spark.createDataFrame([([b for b, _ in totals], [n for _, n in totals])], "no array<long>, slots array<long>")
    by_bunch = _multinomial(shards.join(F.broadcast(first)), ["shard", "bunch", "n"], "shard long, bunch long, n long", seed)
    by_bunch = by_bunch.join(bunches, "bunch").select("shard", "bunch", "n", "no", "slots")
    return _multinomial(by_bunch, ["shard", "no", "n"], "shard long, no long, n long", seed)


def _draws(sources: DataFrame, slots: int, block: int, seed: int) -> DataFrame:
    """(shard, no, draw, block, words) of every slot of the mix."""
    counts = running(_drawn(sources, slots, seed), ["no"], ["shard"], F.col("n"), "first")
    quota = sources.select("no", F.col("slots").alias("quota"))
    counts = saved(counts.join(quota, "no").withColumn("kept", F.greatest(F.lit(0).cast("long"), F.least("n", F.col("quota") - F.col("first")))), "counts")
    kept = counts.where("kept > 0").select("shard", "no", F.explode(F.sequence("first", F.col("first") + F.col("kept") - 1)).alias("draw"))
    # Slots drawn beyond a source's quota go to sources that were drawn too rarely: as many, one by one.
    beyond = counts.where("n > kept").select("shard", "no", F.explode(F.sequence("kept", F.col("n") - 1)).alias("copy"))
    beyond, _ = numbered(beyond, ["shard", "no", "copy"])
    had = counts.groupBy("no").agg(F.sum("n").alias("had"))
    lack = quota.join(had, "no", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < quota")
    lack, _ = numbered(lack.select("no", F.explode(F.sequence("had", F.col("quota") - 1)).alias("draw")), ["no", "draw"])
    moved = beyond.select("shard", "number").join(lack, "number").select("shard", "no", "draw")
    rows = kept.unionAll(moved).join(sources.select("no", "blocks", "slots", "last"), "no")

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            no, draw, n, quota_, last = (b.column(c).to_numpy() for c in ("no", "draw", "blocks", "slots", "last"))
            at = permuted(draw % n, n, _key(seed, no, draw // n))
            words = np.where(draw == quota_ - 1, last, block)
            cols = [b.column("shard"), b.column("no"), b.column("draw"), pa.array(at), pa.array(words)]
            yield pa.RecordBatch.from_arrays(cols, ["shard", "no", "draw", "block", "words"])

    return saved(rows.mapInArrow(placed, "shard long, no long, draw long, block long, words long"), "draws")


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block: int = BLOCK,
    slots: int = SLOTS,
    seed: int = 20260701,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    """The mix of a corpus: sources by code point, null last, weigh `weights` again and again and share `share` times all words.

    Null and empty texts have no words and are never taken; null ids and a null source are values like others; rows that
    repeat are rows of their own.  No rows, or no words, give a mix without draws.  Other columns are not read.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    sources = sized.groupBy("source").agg(F.sum("size").alias("size")).withColumn("last", F.col("source").isNull())
    sources, _ = numbered(sources, ["last", "source"])
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sources = saved(sources.select(F.col("number").alias("no"), "source", "size", weight.alias("weight")), "sources")
    sources = saved(_quotas(_targets(sources, share, most), block, seed), "quotas")
    of = sources.select("no", F.col("source").alias("_source"))
    rows = sized.join(of, F.col("source").eqNullSafe(F.col("_source"))).select("no", "doc_id", "text_hash", "size")
    rows = saved(running(rows, ["no"], ["doc_id", "text_hash"], F.col("size"), "at"), "streams")
    return Mix(sources, rows, _draws(sources, slots, block, seed), block)


def _span(block: int) -> list[Column]:
    """A row's pieces: block, where the piece starts in the block and in the row, and its length."""
    start, end = F.greatest(F.col("at"), F.col("block") * block), F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block)
    return [(start - F.col("block") * block).alias("start"), (start - F.col("at")).alias("skip"), (end - start).alias("length")]


def _blocks_of(block: int) -> Column:
    return F.explode(F.sequence(F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))).alias("block")


def pieces(mix: Mix) -> DataFrame:
    """(no, block, start, skip, length) and the columns of the rows that have words: which of their words lie in which block."""
    rows = mix.docs.where("size > 0").select("*", _blocks_of(mix.block))
    return rows.select("*", *_span(mix.block))


def taken(mix: Mix) -> DataFrame:
    """doc_id, size, source_size, target and taken, the words that the mix takes of the row, for every row of the corpus."""
    draws = mix.draws.select("no", "block", "words")
    met = pieces(mix).join(draws, ["no", "block"], "left")
    words = F.greatest(F.lit(0), F.least("length", F.coalesce("words", F.lit(0)) - F.col("start")))
    used = met.groupBy("no", "at", "doc_id", "size").agg(F.sum(words).cast("long").alias("taken"))
    none = mix.docs.where("size = 0").select("no", "at", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    source = mix.sources.select("no", F.col("size").alias("source_size"), "target")
    return used.unionAll(none).join(source, "no").select("doc_id", "size", "source_size", "target", "taken")


def texts(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """shard, slot, source, block and text of every slot: the words of its block, joined by blanks; slots of a shard are shuffled."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), text.alias("text"))
    rows = rows.where(text.isNotNull()).withColumn("text_hash", F.xxhash64("text"))
    of = mix.sources.select("no", F.col("source").alias("_source"))
    rows = rows.join(of, F.col("source").eqNullSafe(F.col("_source"))).select("no", "doc_id", "text_hash", "text")
    # Rows that repeat have the same words, so a place of each needs the text once.
    rows = rows.groupBy("no", "doc_id", "text_hash").agg(F.first("text").alias("text"))
    same = [rows[c].eqNullSafe(mix.docs[c]) for c in ("no", "doc_id", "text_hash")]
    placed = mix.docs.where("size > 0").join(rows, same).select(mix.docs["no"], "at", "size", "text")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = placed.withColumn("words", words).select("no", "at", "size", "words", _blocks_of(mix.block)).select("*", *_span(mix.block))
    cut = cut.select("no", "block", "start", F.slice("words", (F.col("skip") + 1).cast("int"), F.col("length").cast("int")).alias("words"))
    whole = cut.groupBy("no", "block").agg(F.array_sort(F.collect_list(F.struct("start", "words"))).alias("pieces"))
    whole = whole.select("no", "block", F.flatten("pieces.words").alias("all"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64("shard", "no", "draw"), "no", "draw")  # SLOTS rows of a shard
    slot = mix.draws.withColumn("slot", F.row_number().over(order) - 1)
    met = slot.join(whole, ["no", "block"]).join(mix.sources.select("no", "source"), "no")
    return met.select("shard", "slot", "source", "block", F.array_join(F.slice("all", F.lit(1), F.col("words").cast("int")), " ").alias("text"))
