"""Token ids as bit planes: fixed-size blocks of ids, transposed, each plane compressed, with a chunk index.

A block holds `block_ids` ids (the last of a part fewer).  Its ids are written plane by plane: plane k holds bit k of
every id ("bit", no more planes than the largest id has bits) or byte k of every id ("byte"), and each plane is a
zstandard frame of its own.  The index of a block lists the frames' lengths and the documents, or pieces of
documents, that lie in it.  Blocks are rows of Parquet files, so they can be written to any store that Spark
reaches, and a write that loses executors leaves either whole files or none.

Parts follow the order of the ids (null first, equal ids by text), and so do the blocks within a part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplake.llm.tokens import encoder

BLOCK_IDS = 1 << 16

BLOCKS = """part int, block int, n_ids int, planes string, frames array<int>, payload binary,
    first_doc long, doc_ids array<long>, lengths array<int>, rest long"""
SEGMENTS = "part int, doc long, doc_id long, start long, n_ids long, rest long, ids binary"

_BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("n_ids", pa.int32()),
        ("planes", pa.string()),
        ("frames", pa.list_(pa.int32())),
        ("payload", pa.binary()),
        ("first_doc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("rest", pa.int64()),
    ]
)
_SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("doc", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_ids", pa.int64()),
        ("rest", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def pack(ids: np.ndarray, planes: str = "bit") -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, each compressed."""
    bits = int(ids.max()).bit_length() if len(ids) else 0
    if planes == "bit":
        # In the narrowest type that holds the ids, a plane is one shift over little memory.
        narrow = ids.astype(np.uint8 if bits <= 8 else np.uint16 if bits <= 16 else np.uint32)
        rows = [np.packbits(((narrow >> k) & 1).astype(np.uint8)) for k in range(bits)]
    else:
        raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
        rows = np.ascontiguousarray(raw[:, : (bits + 7) // 8].T)
    squeeze = zstandard.ZstdCompressor(level=3).compress
    return [squeeze(row.tobytes()) for row in rows]


def unpack(frames: list[bytes], n_ids: int, planes: str = "bit") -> np.ndarray:
    """What `pack` was given."""
    expand = zstandard.ZstdDecompressor().decompress
    rows = [np.frombuffer(expand(frame), np.uint8) for frame in frames]
    out = np.zeros(n_ids, "<u4")
    for k, row in enumerate(rows):
        if planes == "bit":
            out |= np.unpackbits(row, count=n_ids).astype(np.uint32) << np.uint32(k)
        else:
            out |= row.astype(np.uint32) << np.uint32(8 * k)
    return out


class _Part:
    """The blocks of one part, cut while its documents pass by."""

    def __init__(self, part: int, block_ids: int, planes: str):
        self.part, self.size, self.planes = part, 4 * block_ids, planes
        self.block, self.doc, self.held, self.segments = 0, 0, bytearray(), []

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[dict]:
        at = 0
        while at < len(ids):
            step = min(len(ids) - at, self.size - len(self.held))
            self.held += ids[at : at + step]
            at += step
            self.segments.append((self.doc, doc_id, step // 4))
            if len(self.held) == self.size:
                yield self.cut((len(ids) - at) // 4)
        self.doc += 1

    def cut(self, rest: int = 0) -> dict:
        frames = pack(np.frombuffer(self.held, "<u4"), self.planes)
        row = {
            "part": self.part,
            "block": self.block,
            "n_ids": len(self.held) // 4,
            "planes": self.planes,
            "frames": [len(f) for f in frames],
            "payload": b"".join(frames),
            "first_doc": self.segments[0][0],
            "doc_ids": [s[1] for s in self.segments],
            "lengths": [s[2] for s in self.segments],
            "rest": rest,
        }
        self.block, self.held, self.segments = self.block + 1, bytearray(), []
        return row


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
    planes: str = "bit",
) -> None:
    """Encode every whole text, append `end_id` and write the ids in ascending order of the document ids.

    Null texts are empty ones, so every row yields its end id.  Rows that repeat are kept, each as a document of its
    own.  Other columns are not read.  A task keeps one block and the document at hand.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words = _Part(TaskContext.get().partitionId(), block_ids, planes), encoder(tokenizer)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for row in part.add(doc_id, words.encode(text.as_py()) + end):
                    yield pa.RecordBatch.from_pylist([row], _BLOCKS)
        if part.held:
            yield pa.RecordBatch.from_pylist([part.cut()], _BLOCKS)

    in_order = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    in_order.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The ids of every document, in one piece for each block that holds some of them.

    `doc` numbers the documents of a part, `start` counts the part's ids before the piece and `rest` the ids of the same
    document after it.  `ids` are little-endian unsigned 32-bit integers.
    """

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cuts = np.cumsum([0, *row["frames"]])
                frames = [row["payload"][a:b] for a, b in zip(cuts, cuts[1:])]
                ids = unpack(frames, row["n_ids"], row["planes"]).tobytes()
                ends = np.cumsum(row["lengths"])
                starts, n = ends - row["lengths"], len(ends)
                columns = [
                    pa.array([row["part"]] * n, pa.int32()),
                    pa.array(range(row["first_doc"], row["first_doc"] + n), pa.int64()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["first_id"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array([0] * (n - 1) + [row["rest"]], pa.int64()),
                    pa.array([ids[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_SEGMENTS)

    blocks = spark.read.schema(BLOCKS).parquet(path)
    size = blocks.agg(F.max("n_ids").alias("size"))
    first = (F.col("block") * F.lit(size.first()[0] or 0).cast("long")).alias("first_id")
    return blocks.select("*", first).mapInArrow(decode, SEGMENTS)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """For every part, the ids of all parts before it: as many rows as the write had tasks."""
    parts = spark.read.schema(BLOCKS).parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def _shift_tables() -> list[list[int]]:
    """Table k maps each bit of a crc32 to what it becomes when 2**k zero bytes follow."""

    def apply(table: list[int], value: int) -> int:
        out, bit = 0, 0
        while value:
            if value & 1:
                out ^= table[bit]
            value >>= 1
            bit += 1
        return out

    one = [0xEDB88320] + [1 << i for i in range(31)]
    for _ in range(3):
        one = [apply(one, x) for x in one]
    tables = [one]
    while len(tables) < 48:
        tables.append([apply(tables[-1], x) for x in tables[-1]])
    return tables


_SHIFTS = _shift_tables()


def crc_before(crc: int, n_bytes: int) -> int:
    """What a piece with this crc32 adds, by exclusive or, to the crc32 of a text that goes on for n_bytes."""
    k = 0
    while n_bytes:
        if n_bytes & 1:
            crc, value, table, bit = 0, crc, _SHIFTS[k], 0
            while value:
                if value & 1:
                    crc ^= table[bit]
                value >>= 1
                bit += 1
        n_bytes >>= 1
        k += 1
    return crc


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""

    def crc(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rests = b.column("rest").to_pylist()
            crcs = [crc_before(zlib.crc32(x.as_buffer()), 4 * r) for x, r in zip(b.column("ids"), rests)]
            columns = [*(b.column(c) for c in ("part", "doc", "doc_id", "start", "n_ids")), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "doc", "doc_id", "start", "n_ids", "crc"])

    pieces = read_segments(spark, path).mapInArrow(crc, "part int, doc long, doc_id long, start long, n_ids long, crc long")
    whole = pieces.groupBy("part", "doc", "doc_id").agg(
        F.min("start").alias("start"), F.sum("n_ids").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32")
    )
    start = (F.col("start") + F.col("part_start")).alias("start")
    return whole.join(part_starts(spark, path), "part").select("doc_id", start, "n_tokens", "ids_crc32")
