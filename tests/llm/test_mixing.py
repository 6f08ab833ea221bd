import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shoplake.llm import mixing
from shoplake.llm.queries import op12_multinomial_mix


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_targets(rows):
    """Sizes and targets of the sources, shared out round by round."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len(words(text))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        rest = sum(weight[s] for s in order if s not in full)
        left = total - sum(2 * size[s] for s in full)
        target = {s: 2.0 * size[s] if s in full else left * weight[s] / rest for s in order}
        new = {s for s in order if target[s] > 2 * size[s] and s not in full}
        if not new:
            return size, target
        full |= new


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.selectExpr("*", "1 as no", "2 as at", "3 as size", "4 as block").repartition(3)


def some_rows(n=300, seed=1):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "é", "Z", ""]
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(rng.randrange(60))), rng.choice(names)) for i in range(n)]
    return rows + [(n + i, " ".join(f"h{i}x{j}" for j in range(40)), "hot") for i in range(n)]


def check(spark, rows, block=16, slots=32):
    mix = mixing.mixed(frame(spark, rows), block=block, slots=slots)
    out = [tuple(r) for r in mixing.taken(mix).collect()]
    size, target = brute_targets(rows)
    wanted = sorted(((i, len(words(t)), size[s], round(target[s], 6)) for i, t, s in rows), key=repr)
    assert sorted(((i, n, s, round(t, 6)) for i, n, s, t, _ in out), key=repr) == wanted
    assert all(0 <= k <= 2 * n for _, n, _, _, k in out)
    return mix, out, size, target


def test_sizes_targets_and_totals(spark):
    rows = some_rows()
    mix, out, size, target = check(spark, rows)
    # By source: each takes its target to the word.
    of = {(i, len(words(t))): s for i, t, s in rows}
    got = Counter()
    for i, n, _, _, k in out:
        got[of[i, n]] += k
    assert {s: got[s] for s in target} == {s: round(t) for s, t in target.items()}
    again = mixing.taken(mixing.mixed(frame(spark, rows).repartition(7), block=16, slots=32)).collect()
    assert sorted(tuple(r) for r in again) == sorted(out)
    other = mixing.taken(mixing.mixed(frame(spark, rows), block=16, slots=32, seed=5)).collect()
    assert sorted(tuple(r) for r in other) != sorted(out)


def test_texts_are_the_words_that_were_taken(spark):
    rows = some_rows(80) + [(7, "x y z x", "d"), (7, "x y z x", "d"), (7, "q", "d"), (None, "null id words", None)]
    mix, out, _, _ = check(spark, rows, block=8, slots=16)
    got = mixing.texts(frame(spark, rows), mix).collect()
    told = Counter(w for r in got for w in r.text.split(" "))
    for i, text, _ in rows[:160]:  # their words are their own
        of = [k for j, n, _, _, k in out if j == i and n == len(words(text))]
        assert i == 7 or sum(told[w] for w in words(text)) == sum(of)
    assert sum(told.values()) == sum(k for *_, k in out)
    shards = Counter(r.shard for r in got)
    assert set(shards.values()) <= {16, len(got) % 16 or 16}
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in shards.items())
    assert len({(r.source, r.block) for r in got}) > 20
    assert len({r.source for r in got if r.shard == 0}) > 3  # shards are mixtures


def test_no_block_again_before_all_others(spark):
    mix, *_ = check(spark, some_rows(), block=16, slots=32)
    n = {r.no: r.blocks for r in mix.sources.collect()}
    turns = Counter((r.no, r.draw // n[r.no], r.block) for r in mix.draws.collect())
    assert set(turns.values()) == {1}


def test_multinomial_draws(spark):
    mix, *_ = check(spark, some_rows(), block=4, slots=64)
    hot = next(r for r in mix.sources.collect() if r.source == "hot")
    all_ = mix.sources.agg({"slots": "sum"}).first()[0]
    counts = [n for n in Counter(r.shard for r in mix.draws.collect() if r.no == hot.no).values()]
    mean = 64 * hot.slots / all_
    assert abs(np.mean(counts[:-1]) - mean) < 3 and 0.3 < np.var(counts[:-1]) / (mean * (1 - mean / 64)) < 3


def test_more_sources_than_a_bunch(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUNCH", 4)
    rows = [(i, "a b c d e f g " * (i % 5), f"s{i % 23}") for i in range(200)]
    check(spark, rows, block=4, slots=8)


def test_odd_rows(spark):
    mix, out, *_ = check(spark, [(1, None, "a"), (2, "", "b"), (3, " \t\n", None)])
    assert {k for *_, k in out} == {0} and mix.draws.count() == 0
    rows = [(1, None, None), (2, "one", None), (2, "one", None), (None, "a b c\x0bd", "x"), (3, "long " * 5000, "y"), (4, "", "z")]
    mix, out, _, target = check(spark, rows)
    assert sum(k for *_, k in out) == sum(round(t) for t in target.values())


def test_no_rows(spark):
    mix = mixing.mixed(frame(spark, []))
    assert mixing.taken(mix).collect() == [] and mixing.texts(frame(spark, []), mix).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4096, 4097])
def test_permutations(n):
    i = np.arange(n)
    for key in (1, 2):
        to = mixing.permuted(i, np.full(n, n), np.full(n, key))
        assert sorted(to) == list(i)
        assert list(mixing.permuted(to, np.full(n, n), np.full(n, key), inverse=True)) == list(i)


def test_word_counts():
    texts = [None, "", "a", " a", "a ", "\x0b\x0c a\tb\n", "\x1c\x85  ", "é è", "x" * 100, None, "b"]
    for a in (pa.array(texts), pa.array(["skip me", *texts]).slice(1), pa.array([None, ""]), pa.array([], pa.string())):
        assert list(mixing.word_counts(a)) == [len(words(t)) for t in a.to_pylist()]


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    size, target = brute_targets(rows)
    of = {i: (len(words(t)), s) for i, t, s in rows}
    out = op12_multinomial_mix(spark, sf_dir).collect()
    got = Counter()
    for r in out:
        assert (r["size"], r.source_size) == (of[r.doc_id][0], size[of[r.doc_id][1]]) and 0 <= r.taken <= 2 * r["size"]
        assert abs(r.target - target[of[r.doc_id][1]]) < 1e-6
        got[of[r.doc_id][1]] += r.taken
    assert len(out) == len(rows) and all(got[s] == round(t) for s, t in target.items())
