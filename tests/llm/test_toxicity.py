import zlib

import pytest

from shoplake.llm import toxicity as t
from shoplake.llm.queries import op6_clause_toxicity


@pytest.fixture(scope="module")
def grammar():
    return t.Grammar({"grobian": 4.0}, {"lowei": 5.0})


def emitted(grammar, text):
    return {k for k, x in enumerate(grammar.clause(text)) if x}


def test_clauses_not_words(grammar):
    assert emitted(grammar, "this was stupid") == {t.MEANT}
    assert emitted(grammar, "you are stupid") == {t.AIMED_AT}
    assert emitted(grammar, "that is not at all stupid") == {t.NEGATED}
    assert emitted(grammar, "not one of all of these people was stupid") == {t.MEANT}
    assert emitted(grammar, "the paper called it stupid") == {t.QUOTED}
    assert emitted(grammar, "ich kill") == set()
    assert emitted(grammar, "kill them") == emitted(grammar, "you they kill") == {t.THREATENED}
    assert emitted(grammar, "ein loweirer grobian") == {t.MEANT}
    assert emitted(grammar, "nothing") == emitted(grammar, "") == set()


def test_documents(grammar):
    assert grammar.features("") == grammar.features("Nice day. Sunny.") == [0.0] * t.FEATURES
    assert grammar.features("Nice. Stupid day") == grammar.features("nice.\nSTUPID thing! ok")
    assert grammar.features("stupidly xstupid aloweis") == [0.0] * t.FEATURES
    one, two = grammar.features("stupid" + " a" * 100000), grammar.features("stupid. stupid." + " a" * 1000)
    assert 0 < one[t.MEANT] < two[t.MEANT]


def rows_of(spark, given, labels):
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "1 as toxic", "2 as score", "'x' as features")
    known = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "1 as quality", "'y' as text")
    return {r.doc_id: r.score for r in t.scored(docs, t.trained(docs, known)).collect()}


def test_learns_words_and_handles_odd_rows(spark):
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i * 7919 % 1000))
    given = [(i, f"some {name(i)} plain {name(i + 1)} words " + ("grumpfen here" if i % 3 == 0 else "good there")) for i in range(300)]
    labels = [(i, int(i % 3 == 0)) for i in range(300)] + [(1, None), (None, 1), (4, 7), (1000, 1)]
    given += [(400, None), (401, ""), (None, "x"), (402, "only grumpfen"), (402, "only grumpfen")]
    got = rows_of(spark, given, labels)
    assert all((got[i] >= 0.5) == (i % 3 == 0) for i in range(300))
    assert got[402] >= 0.5 > got[400] == got[401] == got[None] > 0


def test_without_labels_or_rows(spark):
    assert rows_of(spark, [], []) == {}
    got = rows_of(spark, [(1, "you stupid idiot"), (2, "fine")], [])
    assert got[1] >= 0.5 > got[2]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = op6_clause_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    bad = [p for y, p in held if y]
    # Some rows marked toxic hold no trace of it (cut, shouted or repeated texts), so not all can be found.
    assert sum(bad) >= 0.9 * len(bad) and sum(p for y, p in held if not y) <= 0.01 * len(held)


def test_documents_that_share_a_passage_all_count(spark):
    """Every row holds the same passage; the words beside it still count, and copies count once."""
    passage = " ".join(f"licence{a}{b}" for a in "abcdefghij" for b in "abcdefghij")
    rows = [(f"{passage} {'grumbold' if i % 2 else 'pleasant'} {'x' * (2 + i)}", i % 2) for i in range(80)]
    rows += [("an honest sentence with copyword", 1)] * 80
    words, _ = t.lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert "grumbold" in words and "pleasant" not in words and "copyword" not in words


@pytest.mark.parametrize("label", [0, 1])
def test_labels_of_one_class_leave_the_prior(spark, label):
    given = [(i, f"clean words number {i}") for i in range(60)] + [(99, ""), (98, "you stupid idiot")]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    known = spark.createDataFrame([(i, label) for i in range(60)], "doc_id long, toxic int")
    model = t.trained(docs, known)
    score = {r.doc_id: r.score for r in t.scored(docs, model).collect()}
    assert max(s for i, s in score.items() if i != 98) < 0.1 and score[98] > 0.5
    assert {r.doc_id for r in t.kept(docs, model).collect()} == set(score) - {98}
