import hashlib
import random
import string
import zlib

import pytest
from pyspark.sql import functions as F

from shoplake.llm import merkle
from shoplake.llm.queries import op13_bitmap_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def climb(nodes):
    """Levels up to the last node, by plain lists."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        first = at // 8 * 8
        out.append((nodes[first:at], nodes[at + 1 : first + 8]))
        at //= 8
    return out


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = [(r[0] is not None, r[0] or 0, leaf_of(*r), r) for r in rows if r[2] == lang]
        own.sort(key=lambda x: x[:3])
        trees.append((own, climb([x[2] for x in own])))
    top = climb([levels[-1][0] for _, levels in trees])
    root, out = top[-1][0], []
    for no, (own, levels) in enumerate(trees):
        for at, (_, _, leaf, r) in enumerate(own):
            path = siblings(levels, at) + siblings(top, no)
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                node = leaf_of(r[0], r[1] and r[1].translate(LOWER), *r[2:])
            for left, right in path:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join("".join(left + right) for left, right in path))
            out.append((r[0], leaf, levels[-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def made(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "2 as tree", "3 as leaf", "4 as n").repartition(3)
    wrong = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return sorted((tuple(r) for r in merkle.manifest(df, wrong).collect()), key=repr)


def docs(n, lang, first=0, step=1, seed=1):
    rng = random.Random(seed)
    return [(first + i * step, rng.choice(["", "Abc ", "ÀÉ ", "x\ny "]) * rng.randrange(4), lang, "s", i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 65, 512, 513, 600, 4200])
def test_one_language(spark, n):
    rows = docs(n, "en", step=7)
    assert made(spark, rows) == brute(rows)


def test_many_languages_and_far_ids(spark):
    rows = docs(700, "en") + docs(1, "de") + docs(30, None) + docs(9, "") + docs(520, "é", first=-3000, step=11)
    rows += docs(40, "fr", first=(1 << 62), step=1 << 40) + docs(40, "fr", first=-(1 << 62), step=1 << 33)
    rows += [r for i in range(70) for r in docs(1 + i % 3, f"l{i}", first=i * 40000)]
    assert made(spark, rows) == brute(rows)


def test_nulls_and_repeated_rows(spark):
    rows = docs(20, "en") + docs(20, "en") + docs(900, "en", first=5, step=0) + docs(12, "en", first=6, step=40000)
    rows += [(None, "A", "en", None, None)] * 10 + [(None, None, "en", "s", 1), (None, None, None, None, None), (3, None, "en", "s", 0)]
    rows += [(8, "Z" * 100_000, "en", "s", 5)] + [(40_000, "b", "de", "s", 1)] * 600
    got = made(spark, rows)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_no_rows_and_nothing_tampered(spark):
    assert made(spark, []) == []
    df = spark.createDataFrame(docs(30, "en"), SCHEMA)
    assert all(r.verified for r in merkle.manifest(df).collect())


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = op13_bitmap_merkle(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
