"""Packing of token pieces into sequences of a fixed size, by linear grouping and best fit.

The pieces' lengths are counted; a plan is made for the counts, which are no more than `size` numbers whatever the corpus, and
the pieces then look up their places:

1. Lengths over size / SMALL are large.  In descending order they are cut into GROUPS groups of equal cardinality and
   rounded up to the largest of their group, which leaves few sizes.
2. Configurations of the few sizes are chosen: the largest size left is filled up by a knapsack over the sizes left,
   and the configuration is repeated as often as the groups allow.
3. The actual pieces take the slots of their group.  Sequences of the same actual lengths form a class: a range of
   sequence numbers with one amount of room.
4. Small lengths go, longest first, into the class with the least room that holds them, else into new sequences.

The plan is a list of runs: pieces of one length, from one rank on, go to consecutive sequences at one offset.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import BATCH_BYTES, mapped, saved
from shoplake.llm.tokens import encoder

GROUPS = 128
SMALL = 16

PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, rank long"


class Run(NamedTuple):
    """`count` pieces of this length, from that rank on, go to sequences from `sequence` on, each at `offset`."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def _groups(counts: Mapping[int, int], groups: int) -> list[list[list[int]]]:
    """Equal-cardinality groups of [length, first rank, count], longest first."""
    total = sum(counts.values())
    share, out = -(-total // groups) if total else 1, []
    room = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if not room:
                out.append([])
                room = share
            n = min(room, left)
            out[-1].append([length, rank, n])
            rank, left, room = rank + n, left - n, room - n
    return out


def _configuration(sizes: list[int], left: list[int], size: int) -> Counter:
    """The first group that has pieces left, and the fullest set of others beside it."""
    first = next(g for g, n in enumerate(left) if n)
    room, mask = size - sizes[first], (1 << (size - sizes[first] + 1)) - 1
    reach, steps = 1, []
    for g in range(first, len(sizes)):
        have = left[g] - (g == first)
        steps.append((g, reach))
        for _ in range(min(have, room // sizes[g])):
            reach |= (reach << sizes[g]) & mask
    at, out = reach.bit_length() - 1, Counter({first: 1})
    for g, before in reversed(steps):
        while not before >> at & 1:
            out[g] += 1
            at -= sizes[g]
    return out


def plan(counts: Mapping[int, int], size: int, groups: int = GROUPS, small: int = SMALL) -> tuple[list[Run], int]:
    """Runs for so many pieces of each length (1 .. size), and the number of sequences they fill."""
    runs, used = [], 0
    if counts.get(size):
        runs.append(Run(size, 0, counts[size], 0, 0))
        used = counts[size]
    large = {x: n for x, n in counts.items() if size // small < x < size and n}
    rooms: dict[int, list[tuple[int, int]]] = {}  # by room: ranges of sequences
    pieces = _groups(large, groups)
    sizes, left = [g[0][0] for g in pieces], [sum(s[2] for s in g) for g in pieces]
    while any(left):
        chosen = _configuration(sizes, left, size)
        copies = min(left[g] // n for g, n in chosen.items())
        slots = []
        for g, n in sorted(chosen.items()):
            left[g] -= n * copies
            for _ in range(n):  # the group's next pieces, one for each copy
                slices, need = [], copies
                while need:
                    head = pieces[g][0]
                    n_head = min(need, head[2])
                    slices.append([head[0], head[1], n_head])
                    head[1], head[2], need = head[1] + n_head, head[2] - n_head, need - n_head
                    if not head[2]:
                        pieces[g].pop(0)
                slots.append(slices)
        done = 0
        while done < copies:  # a class of sequences with the same actual lengths
            n, offset = min(s[0][2] for s in slots), 0
            for s in slots:
                runs.append(Run(s[0][0], s[0][1], n, used + done, offset))
                offset += s[0][0]
                s[0][1], s[0][2] = s[0][1] + n, s[0][2] - n
                if not s[0][2]:
                    s.pop(0)
            if offset < size:
                rooms.setdefault(size - offset, []).append((used + done, n))
            done += n
        used += copies
    for length in sorted((x for x in counts if x <= size // small and counts[x]), reverse=True):
        rank, need = 0, counts[length]
        full = sorted(r for r in rooms if r >= length)
        heapq.heapify(full)
        while need:
            while full and not rooms.get(full[0]):
                heapq.heappop(full)
            if not full:
                new = -(-need // (size // length))
                rooms.setdefault(size, []).append((used, new))
                heapq.heappush(full, size)
                used += new
            room = full[0]
            sequence, count = rooms[room].pop()
            n = min(count, need)
            if not rooms[room] and n == count:
                del rooms[room]
            elif n < count:
                rooms[room].append((sequence + n, count - n))
            runs.append(Run(length, rank, n, sequence, size - room))
            rank, need, rest = rank + n, need - n, room - length
            if rest:
                if rest not in rooms and rest >= length:
                    heapq.heappush(full, rest)
                rooms.setdefault(rest, []).append((sequence, n))
    return runs, used


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token ids of every whole text and `end_id`, cut into pieces of `size` where longer.

    Null texts are empty ones.  `part` is the task, `rank` counts the pieces of the same length in it, so the rows must be
    written before anything else.
    """
    end = np.array([end_id], "<u4").tobytes()
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words, ranks = TaskContext.get().partitionId(), encoder(tokenizer), Counter()
        names = [c.strip().split()[0] for c in PIECES.split(",")]
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    cut = ids[at : at + 4 * size]
                    n = len(cut) // 4
                    rows.append((doc_id, piece, at // 4, n, cut, part, ranks[n]))
                    ranks[n] += 1
                    held += len(cut)
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(rows, cut, PIECES)


def placed(rows: DataFrame, size: int, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """Adds `sequence_id` and `offset` to written pieces; replaces `part` and `rank`.

    A piece's rank among all of its length is its rank in its task and the counts of the tasks before.
    """
    counts = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(totals, size, groups, small)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 44) + table[:, 1]

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column("rank").to_numpy() + b.column("base").to_numpy()
            run = table[np.searchsorted(keys, (b.column("length").to_numpy() << 44) + rank, "right") - 1]
            columns = [*(b.column(c) for c in kept), pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    kept = [c for c in rows.columns if c not in ("part", "rank")]
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in kept) + ", sequence_id long, offset long"
    return mapped(rows.join(bases, ["part", "length"]), look_up, schema)


def packed(
    docs: DataFrame, tokenizer: str, end_id: int, size: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every piece with its ids and its place; rows that repeat are documents of their own."""
    return placed(saved(pieces(docs, tokenizer, end_id, size, id_col, text_col), "pieces", "zstd"), size)
