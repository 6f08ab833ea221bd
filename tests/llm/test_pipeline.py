import numpy as np
import pyarrow as pa
import test_decontaminate
import test_neardup
import test_packing

import corpus_pipeline
from shoplake.llm import common, pii, toxicity
from shoplake.llm.common import saved, table, without


def test_without_keeps_null_and_other_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "doc_id long, text string")
    ids = spark.createDataFrame([(2,), (2,), (9,)], "id long")
    assert sorted(r.text for r in without(rows, ids, "doc_id").collect()) == ["a", "c"]
    ids = spark.createDataFrame([(None,)], "id long")
    assert sorted(r.text for r in without(rows, ids, "doc_id").collect()) == ["a", "b", "d"]
    assert without(rows, ids.limit(0), "doc_id").count() == 4


def test_rows_that_repeat_an_id(spark, sf_dir):
    """A row goes for its own text, not for another one under its id; of exact repeats one stays."""
    item = max((r.text for r in table(spark, sf_dir, "benchmark").where("text is not null").collect()), key=len)
    a, b, c = (" ".join(f"{word}{i}" for i in range(60)) for word in "abc")
    given = [(1, a), (5, a), (5, b), (6, c), (6, c), (6, c + " end"), (7, item), (7, "clean words"), (8, None), (8, None), (None, "x"), (None, "x"), (None, "y")]
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "5 as n_chars")
    stages, order = dict(corpus_pipeline.STAGES), lambda rows: sorted(rows, key=str)
    docs = saved(stages["near_dedup"](spark, docs, sf_dir), "stage")
    assert docs.columns == ["doc_id", "text", "n_chars"]
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    six = [r for r in kept if r[0] == 6]
    assert len(six) == 1 and six[0] in given
    rest = [(1, a), (5, b), (7, item), (7, "clean words"), (8, None), (None, "x"), (None, "y")]
    assert order(r for r in kept if r[0] != 6) == order(rest)
    clean = [(r.doc_id, r.text) for r in stages["decontamination"](spark, docs, sf_dir).collect()]
    assert order(clean) == order(r for r in kept if r != (7, item))


def test_stages_one_by_one(spark, sf_dir):
    """Every stage against the same decision made row by row."""
    docs = table(spark, sf_dir, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]

    def step(name, docs):
        out = saved(stages[name](spark, docs, sf_dir), "stage")
        assert name == "packing" or out.columns == columns
        return out, {r.doc_id: r for r in out.collect()} if name != "packing" else out.collect()

    given = {r.doc_id: r for r in docs.collect()}
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    grammar = toxicity.Grammar(model.words, model.starts)
    docs, rows = step("toxicity", docs)
    score = lambda t: model.score(np.array([grammar.features(t)]))[0]
    assert rows == {i: r for i, r in given.items() if score(r.text) < 0.5} != given

    docs, kept = step("near_dedup", docs)
    brute = test_neardup.brute([(i, r.text) for i, r in rows.items()])
    want = {int(b[1:].split(",")[0]) for b in brute if b.endswith("True)") or ", 0, None" in b}
    assert kept == {i: rows[i] for i in want}

    docs, clean = step("decontamination", docs)
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    found = test_decontaminate.brute([(i, r.text) for i, r in kept.items()], items)
    assert clean == {i: kept[i] for i, n, hit, _ in found if not (hit and 20 * hit >= n)}

    chooser = pii.trained(docs)
    docs, safe = step("pii", docs)
    for i, r in clean.items():
        base, more = chooser.selected(r.text)
        text = pii.masked(r.text, base + more)
        assert safe[i].text == text and safe[i].n_chars == len(text) and safe[i].source == r.source
    assert len(safe) == len(clean) and any("<EMAIL>" in r.text for r in safe.values())

    _, pieces = step("packing", docs)
    test_packing.check(pieces, [(i, r.text) for i, r in safe.items()], 4096)


FIRST = list(corpus_pipeline.STAGES)[:4]


def small_dir(spark, tmp_path, labels=(), items=()):
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_no_documents(spark, tmp_path):
    sf_dir = small_dir(spark, tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in FIRST:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.pack(spark, docs, sf_dir).collect() == []


def test_clashing_and_unorderable_columns_nulls_and_repeats(spark, tmp_path):
    """Columns named like those the stages work with stay as they are, and a map does not stop them."""
    item = " ".join(f"item{i}" for i in range(40))
    sf_dir = small_dir(spark, tmp_path, items=[("i", item)])
    given = [(1, None), (1, None), (2, ""), (3, "mail me: joe (at) mail [dot] org, 4111 1111 1111 1111"), (4, item), (None, "a b c"), (None, "a b c"), (5, "word " * 40_000)]
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr(
        "*", "7L as text_hash", "'x' as _text_hash", "map('k', doc_id) as tags", "1 as node", "2 as score", "3 as spans", "4 as comp"
    )
    want = {"toxicity": 8, "near_dedup": 6, "decontamination": 5, "pii": 5}
    columns = docs.columns
    for name, stage in FIRST:
        docs = saved(stage(spark, docs, sf_dir), "stage")
        rows = docs.collect()
        assert docs.columns == columns and len(rows) == want[name]
        assert {(r.text_hash, r._text_hash, r.node, r.comp) for r in rows} == {(7, "x", 1, 4)}
        assert all(r.tags == {"k": r.doc_id} for r in rows)
    assert {r.doc_id: r.text for r in rows}[3] == "mail me: joe (at) mail [dot] org, <CARD>" or "<EMAIL>" in {r.doc_id: r.text for r in rows}[3]
    pieces = corpus_pipeline.pack(spark, docs, sf_dir).collect()
    assert {r.doc_id for r in pieces} == {1, 2, 3, 5, None}


def test_batches_are_bounded_by_their_bytes(spark, tmp_path, monkeypatch):
    """Long texts and sets do not go to a worker in batches of many times their length."""
    most = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(common, "BATCH_BYTES", 1 << 20, raising=False)
    spark.conf.unset(most)
    docs = spark.range(0, 40, 1, 1).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 40000) as text")
    sf_dir = small_dir(spark, tmp_path, items=[("i", "none")])

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    try:
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) > 4 << 20
        for _, stage in FIRST[:2]:
            spark.conf.unset(most)
            stage(spark, docs, sf_dir)
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 2 << 20
        spark.conf.set(most, "8m")  # the user's bound stays
        assert common.mapped(docs, sizes, "n long").collect()[0].n > 4 << 20
    finally:
        spark.conf.unset(most)
