import hashlib
import random
import re

import pytest

from shoplake.llm.decontaminate import contaminated
from shoplake.llm.queries import op4_winnowed_benchmark

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items):
    spans = {}
    for i, t in items:
        w = words(t)
        for at in range(max(1, len(w) - 12)) if i is not None and w else ():
            spans.setdefault(tuple(w[at : at + 13]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, met = words(t), set(), set()
        for n in {len(s) for s in spans}:
            for at in range(len(w) - n + 1):
                if found := spans.get(tuple(w[at : at + n])):
                    hit |= set(range(at, at + n))
                    met |= found
        out.append((i, len(w), len(hit), sorted(met)))
    return out


def run(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as hash", "2 as at", "3 as n_words")
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as item", "4 as length")
    return sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in contaminated(docs, items).collect())))


def made_up(seed, n_docs=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ä", "ß9"]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.choice([13, 14, 20, 40]))) for i in range(12)]
    docs = []
    for i in range(n_docs):
        parts = [say(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(items)[1].split()
            a = rng.randint(0, len(text) - 1)
            parts += [" ".join(text[a : a + rng.randint(8, 30)]), say(rng.randint(0, 12))]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_span(spark, seed):
    docs, items = made_up(seed)
    assert run(spark, docs, items) == sorted(map(str, brute(docs, items)))


def test_short_items_and_odd_rows(spark):
    docs, items = made_up(3, 20)
    items += [(100, "w1 w2"), (101, "W3"), (102, ""), (103, None), (None, items[0][1]), (105, "w5 w6 w7 w8 w9 w1 w2"), (0, "w9 w9")]
    docs += [(1, None), (None, items[0][1]), (5, ""), (5, items[1][1]), (5, items[1][1]), (6, "w1 " * 5000 + items[2][1]), (7, "w1-w2")]
    assert run(spark, docs, items) == sorted(map(str, brute(docs, items)))


def test_empty_tables(spark):
    docs, items = made_up(4, 5)
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == sorted(map(str, brute(docs, [])))


def test_query(spark, sf_dir):
    read = lambda n, *c: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{n}.parquet").select(*c).collect()]
    want = []
    for i, n, hit, items in brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text")):
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        want.append((i, n, hit, len(items), digest, hit > 0 and 20 * hit >= n))
    assert sorted(tuple(r) for r in op4_winnowed_benchmark(spark, sf_dir).collect()) == sorted(want)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op4_winnowed_benchmark(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
