import random
import re

import numpy as np
import pytest

from shoplake.llm import neardup
from shoplake.llm.components import components


def words(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                comp[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(map(str, out))


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "2 as key", "3 as n", "'x' as sketch")
    got = neardup.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(str(tuple(r)) for r in got.collect())


def edited(rng, text, share):
    return " ".join(f"e{rng.randint(0, 10**6)}" if rng.random() < share else w for w in text.split())


def made_up(seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    common, rows = say(30), []
    for _ in range(25):
        base = say(rng.choice([3, 5, 6, 8, 12, 25, 60, 200, 500]))
        for _ in range(rng.randint(1, 6)):
            rows.append(edited(rng, base, rng.choice([0, 0.005, 0.02, 0.04, 0.08])))
    big = say(150)
    rows += [edited(rng, big, rng.uniform(0, 0.06)) for _ in range(90)]
    rows += [f"{common} {say(rng.randint(5, 40))}" for _ in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = made_up(seed)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = "long text " + " ".join(map(str, range(30000)))
    rows = [
        (7, "a b c d e f"), (3, "A  b\tc\nd e f "), (9, None), (8, ""), (10, " \n"), (4, "one"), (5, "one"), (6, "one two"), (None, "one"),
        (None, "alone here"), (11, long), (12, long + " more"), (3, "A  b\tc\nd e f "), (13, "É b c d e f"), (14, "é b c d e f"), (2, "x" * 100000),
    ]
    want = [r for r in brute(rows) if "None, 1, None" not in r] + ["(None, 1, None, True)"]
    assert run(spark, rows) == sorted(want)
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == ["(1, 0, 1, True)"]


def test_chains_are_one_component(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (502, 500)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}


def test_estimates_correct_for_collisions():
    rng = np.random.default_rng(0)
    pool = np.unique(rng.integers(0, 2**64, 6000, dtype=np.uint64))
    for share in (0, 0.5, 0.75, 1):
        found = []
        for _ in range(60):
            x = rng.permutation(pool)
            both = int(2 * 1000 * share / (1 + share))
            a, b = np.sort(x[:1000]), np.sort(np.concatenate([x[:both], x[1000 : 2000 - both]]))
            small = [neardup.small_registers(neardup.registers(s)[None]) for s in (a, b)]
            found.append(neardup.estimates(*small)[0, 0])
        assert abs(np.mean(found) - share) < 0.02


def test_thinned_links_reach_the_same(spark):
    from shoplake.llm.components import thinned

    rng = random.Random(9)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(3000)] + [(1000, n) for n in range(1001, 1400)]
    links += [(n, n + 1) for n in range(2000, 2050)] + [(5000, 5000), (3001, 3000), (3000, 3001)]
    got = [tuple(r) for r in thinned(spark.createDataFrame(links, "a long, b long")).collect()]
    assert len(got) < 2.2 * len({b for _, b in got}) and all(a < b for a, b in got)

    def classes(pairs):
        up = {}

        def root(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[max(root(a), root(b))] = min(root(a), root(b))
        return {x: root(x) for p in pairs for x in p if p[0] != p[1]}

    assert classes(got) == {x: r for x, r in classes(links).items() if any(x in p and p[0] != p[1] for p in links)}
