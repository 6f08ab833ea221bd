import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoplake.llm.packing import packed, plan
from shoplake.llm.queries import op5_grouped_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def fill(counts, size, **kw):
    """Sequences by number: (offset, length) of what lies in them."""
    runs, used = plan(counts, size, **kw)
    ranks, out = defaultdict(list), defaultdict(list)
    for r in runs:
        ranks[r.length] += range(r.rank, r.rank + r.count)
        for i in range(r.count):
            out[r.sequence + i].append((r.offset, r.length))
    assert {x: sorted(v) for x, v in ranks.items()} == {x: list(range(n)) for x, n in counts.items() if n}
    assert sorted(out) == list(range(used))
    for lengths in out.values():
        at = 0
        for offset, length in sorted(lengths):
            assert offset == at
            at += length
        assert at <= size
    return used


def best_fit(counts, size):
    rooms, used = Counter(), 0
    for length in sorted(Counter(counts).elements(), reverse=True):
        room = min((r for r in rooms if r >= length and rooms[r]), default=None)
        if room is None:
            room, used = size, used + 1
        else:
            rooms[room] -= 1
        rooms[room - length] += 1
    return used


@pytest.mark.parametrize("seed", range(8))
def test_plans_are_whole_and_tight(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 100, 512])
    draw = rng.choice([lambda: rng.randint(1, size), lambda: min(size, 1 + int(rng.expovariate(4 / size))), lambda: rng.randint(size // 3, size)])
    counts = Counter(draw() for _ in range(rng.randint(1, 4000)))
    used = fill(counts, size)
    assert used <= 1.02 * best_fit(counts, size) + 2
    assert used >= -(-sum(x * n for x, n in counts.items()) // size)


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(1)
    counts = Counter(min(4096, 1 + int(rng.expovariate(1 / 1200))) for _ in range(20000))
    small, _ = plan(counts, 4096)
    large, used = plan({x: n * 10**6 for x, n in counts.items()}, 4096)
    assert len(large) < 2 * len(small) + 20000
    assert used * 4096 < 1.01 * 10**6 * sum(x * n for x, n in counts.items())


def test_few_lengths():
    assert fill({}, 8) == 0
    assert fill({8: 3}, 8) == 3
    assert fill({1: 17}, 8) == 3
    assert fill({5: 4, 3: 4}, 8) == 4
    assert fill({4: 2, 2: 3, 1: 2}, 8) == 2


def check(rows, given, size):
    whole, got, sequences = Tokenizer.from_file(PATH), Counter(), defaultdict(list)
    for r in rows:
        crc = r.ids_crc32 if "ids_crc32" in r else zlib.crc32(bytes(r.ids))
        got[r.doc_id, r.piece, r.start, r.length, crc] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    want = Counter()
    for doc_id, text in given:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), size)):
            want[doc_id, k, at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes())] += 1
    assert got == want
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) <= 1.02 * best_fit(Counter(x for s in sequences.values() for _, x in s), size) + 2


def test_odd_rows(spark):
    given = [(1, None), (1, None), (2, ""), (None, "a b c"), (5, "word " * 100), (6, "x y " * 8), (6, "x y " * 8)]
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "1 as length", "2 as part", "3 as offset")
    check(packed(docs, PATH, 1, 32).collect(), given, 32)
    assert packed(docs.limit(0), PATH, 1).collect() == []


def test_query(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(op5_grouped_packing(spark, sf_dir).collect(), given, 4096)
