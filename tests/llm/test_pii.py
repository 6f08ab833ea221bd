import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark import RDD

from shoplake.llm import boosting, pii
from shoplake.llm.boosting import ONE, Boosted, coded, threshold
from shoplake.llm.queries import op7_boosted_pii
from shoplake.llm.spans import digests


def brute(text):
    """The patterns as the contract writes them."""
    text, out = text or "", []
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


TEXTS = [
    None, "", "nothing", "a@b.c", "é.x@y-z.co.uk, q@@r.s @t.u v@w", "a@b.c@d.e", "a@b@c.d", "x@y..z", "1.2.3.4", "1.2.3.4.5.6.7.8",
    "256.1.1.1 1.1.1.256.9 01.002.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "0" * 12, "0" * 11, "0" * 20,
    "+1 (456) 555-2186", "+123456789", "+1234567", "+1-2-3-4-5-6-7-8-9-", "++1 23456789+4(", "+1 2345678901234567", "tel 4111 1111 1111 1111 +49 30 1234567",
    "a" * 50000 + "@" + "b." * 5000 + "c", "1." * 30000, "1 " * 30000, "+1" + "(" * 30000, "@" * 3000, "mail me: joe (at) mail [dot] org", "9" * 4000 + ".1.1.1",
]


def check(rows, given):
    want = []
    for i, t in given:
        spans = brute(t)
        n = [sum(x.startswith(k) for x in spans) for k in pii.KINDS]
        want.append((i, *n, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert sorted(map(str, (r[:6] for r in rows))) == sorted(map(str, want))


def test_base_spans_of_odd_texts(spark):
    given = list(enumerate(TEXTS)) + [(None, TEXTS[3]), (3, TEXTS[3])]
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as kind", "3 as h")
    check([tuple(r) for r in digests(pii.found(docs, pii.trained(docs)), pii.KINDS).collect()], given)
    none = docs.limit(0)
    assert pii.found(none, pii.trained(none)).collect() == []


def test_base_spans_of_made_up_texts():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choices("a1@. +-(1.2é", k=rng.randint(0, 25)))
        got = [f"{k}:{a}:{b}" for k, a, b in pii.in_order(pii.base_spans(text), pii.KINDS)]
        assert got == brute(text), text


def test_masks_overlapping_spans():
    assert pii.masked("call +1 2345 678 901 now", [("card", 6, 20), ("phone", 5, 20)]) == "call <PHONE> now"
    assert pii.masked("a b", []) == "a b"
    assert pii.masked("x@y.z1.2.3.4", [("email", 0, 6), ("ip", 5, 12)]) == "<EMAIL>"


def test_trees_learn_a_rule_and_thresholds_keep_precision():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    p = Boosted().fit(x[:2000], y[:2000]).predict(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.97
    cut = threshold(p, y[2000:], 0.98)
    assert y[2000:][p >= cut].mean() >= 0.98 and (p >= cut).sum() > 400
    assert threshold(np.zeros(0), np.zeros(0), 0.9) == 2.0 == threshold(np.ones(9), np.zeros(9), 0.9)
    assert Boosted().fit(x[:0], y[:0]).predict(x[:2]).tolist() == [0.5, 0.5]


def test_finds_rewritten_data_and_leaves_other_digits(spark):
    rng = random.Random(4)
    number = lambda n: "".join(rng.choices("0123456789", k=n))

    def card():
        head = number(15)
        return next(head + c for c in "0123456789" if pii.luhn(head + c))

    given = []
    for i in range(900):
        kind = i % 3
        body = [f"+1 (456) 555-{number(4)}", " ".join(re.findall("....", card())), f"u{i}@mail.example.com"][kind]
        given.append((i, f"some words {'before it' * (i % 4)} {body} and after {number(2)}"))
    docs = spark.createDataFrame(given, "doc_id long, text string")
    model = pii.trained(docs)
    card_text = ".".join(re.findall("....", card()))
    base, more = model.selected(f"some words before it {card_text} and after")
    assert base == [] and more == [("card", 21, 40)]
    wrong = card_text[:-1] + str((int(card_text[-1]) + 1) % 10)
    assert model.selected(f"some words before it {wrong} and after") == ([], [])
    assert model.selected("just 12 words and 1999") == ([], [])


def made_up(n=900):
    """Texts with a phone, a card, a mail or an IP address each."""
    rng = random.Random(4)
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    out = []
    for i in range(n):
        card = number(15)
        card = next(card + c for c in "0123456789" if pii.luhn(card + c))
        body = [
            f"+1 ({rng.randint(200, 999)}) 555-{number(4)}", " ".join(re.findall("....", card)), f"u{i}@mail.example.com",
            ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        ][i % 4]
        out.append((i, f"some words {'before it' * (i % 3)} {body} and after {number(2)}"))
    return out


def test_phone_with_a_number_behind_it(spark):
    """The base pattern runs on into the number and fails; the phone itself is still proposed, and masked."""
    model = pii.trained(spark.createDataFrame(made_up(), "doc_id long, text string"))
    for phone, ip in (("(826) 555-4081", "190.137.223.204"), ("(843) 555-7672", "170.106.47.218")):
        text = f"words and +1 {phone} {ip} then more"
        assert [k for k, _, _ in pii.base_spans(text)] == ["ip"]
        at = text.index(phone)
        assert ("phone", at, at + len(phone)) in pii.proposals(text, pii.base_spans(text))
        base, more = model.selected(text)
        masked = pii.masked(text, base + more)
        assert phone not in masked and "555" not in masked and "<IP> then more" in masked, masked


def test_no_kind_is_off_in_a_small_table(spark):
    """Six base spans, as at sf0.001, and none at all: every kind has a threshold, and the same data are found."""
    for n in (24, 0):
        docs = spark.createDataFrame(made_up(24), "doc_id long, text string").limit(n)
        model = pii.trained(docs)
        assert all(c <= 1 for c in model.cuts.values()), model.cuts
        for kind, body in (
            ("email", "jane.doe [at] mail.example.com"), ("ip", "190[.]137[.]223[.]204"), ("card", "4111.1111.1111.1111"),
            ("phone", "(826) 555-4081"),
        ):
            _, more = model.selected(f"some words before it {body} and after")
            assert more == [(kind, 21, 21 + len(body))], (n, kind, more)
        assert model.selected("some words before it 4111.1111.1111.1112 and after") == ([], [])


def test_rare_kind_beside_a_common_one(spark):
    """The bound holds for each kind alone, over all documents; copies count once."""
    phones = [(i, f"call +1 (456) 555-{i:04d} now") for i in range(600)]
    rare = [(1000 + i, f"mail u{i % 20}@mail.example.com now") for i in range(40)]
    docs = spark.createDataFrame(phones + rare, "doc_id long, text string").repartition(7)
    spans = pii.training_spans(docs, 100)
    known = lambda kind, word: {t[s[1] : s[2]] for t, s, true, _ in spans if true and s[0] == kind and t.startswith(word)}
    assert known("email", "mail u") == {f"u{i}@mail.example.com" for i in range(20)}
    assert 60 < len(known("phone", "call +1 (456)")) < 140
    assert spans == pii.training_spans(docs.coalesce(1), 100)


def test_texts_full_of_digits_are_bounded_by_a_hash(spark):
    """A text with thousands of spans gives a bounded number; which ones does not hang on the order of rows or tasks."""
    full = [(i, " ".join(f"1.2.{i}.{k % 256}, 999.9.{i}.{k}," for k in range(2000))) for i in range(8)]
    docs = spark.createDataFrame(full + [(9, "host 9.8.7.6 up")], "doc_id long, text string")
    spans = pii.training_spans(docs.repartition(5), 300)
    for true in (True, False):
        of = [t[s[1] : s[2]] for t, s, right, _ in spans if s[0] == "ip" and right == true and not t.endswith(" up")]
        of = [b for b in of if b.startswith(("1.2.", "999.9."))]  # made-up ones come beside them
        texts = [b.split(".")[2] for b in of]
        assert 150 < len(of) < 450 and all(texts.count(str(i)) <= pii.SPANS_OF_A_TEXT for i in range(8)), len(of)
    assert spans == pii.training_spans(docs.orderBy(-docs.doc_id).coalesce(1), 300)


def test_phone_numbers_in_other_groups(spark):
    model = pii.trained(spark.createDataFrame(made_up(), "doc_id long, text string"))
    for phone in ("030 1234567", "06 12 34 56 78", "0049 30 1234567", "(826) 555-4081", "826.555.4081", "030/1234567"):
        text = f"some words before it {phone} and after"
        assert ("phone", 21, 21 + len(phone)) in pii.proposals(text), phone
        assert model.selected(text) == ([], [("phone", 21, 21 + len(phone))]), phone
    for other in ("2024-05-17", "17.05.2021", "1999-2003", "12.345.678", "5021 7733 1200 9191", "1 2 3", "12345678"):
        assert model.selected(f"some words before it {other} and after") == ([], []), other


@pytest.mark.parametrize("columns", [["doc_id", "text"], ["text", "doc_id"]])
def test_redacts_in_place(spark, columns):
    docs = spark.createDataFrame([(1, "a@b.c d"), (2, None), (3, "")], "doc_id long, text string").selectExpr(*columns, "5 as n")
    rows = pii.redacted(docs, pii.trained(docs))
    assert rows.columns == [*columns, "n"]
    assert {r.doc_id: r.text for r in rows.collect()} == {1: "<EMAIL> d", 2: None, 3: ""}


def test_query(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check([tuple(r) for r in op7_boosted_pii(spark, sf_dir).collect()], given)


@pytest.mark.parametrize("n", [1, 63, 64, 70, 100, 5000])
def test_addresses_are_proposed_whole(n):
    host = "h" * n + " (dot) " + ".".join(["part"] * 12)
    text = f"write to {'l' * n} (at) {host}, please"
    assert pii.proposals(text) == [("email", 9, len(text) - 8)]
    assert pii.proposals("x (at) " * 20_000 + "y.z")[-1][0] == "email"


def test_every_kind_learns_from_the_same_made_up_spans(spark):
    texts = [(i, f"call +1 (456) 555-{2000 + i} or 10.0.{i % 250}.1") for i in range(300)]
    for given in ([], texts[:3], texts):
        spans = pii.training_spans(spark.createDataFrame(given, "doc_id long, text string"))
        made = [(t, s) for t, s, true, h in spans if true and h < pii.MADE_UP]
        assert {k: sum(s[0] == k for _, s in made) for k in pii.KINDS} == dict.fromkeys(pii.KINDS, pii.MADE_UP)


def test_learns_from_every_span(spark):
    """Many spans of a kind, and many in one text, all count; together they weigh no more than `SPANS_OF_A_KIND`."""
    docs = [(i, f"call +1 (456) 555-{i:04d} now") for i in range(2500)]
    docs += [(i, f"call +1 (456) 555-{i:04d} now") for i in range(100)] + [(9, " ".join(f"10.0.{k // 200}.{k % 200}," for k in range(400)))]
    rows = pii.learning_rows(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).toArrow().to_pylist()
    of = lambda kind, true: 2 * pii.KINDS.index(kind) + true
    spans = {p: sum(r["spans"] for r in rows if r["part"] == p) for p in {r["part"] for r in rows}}
    assert (spans[of("phone", True)], spans[of("ip", True)], spans[-1]) == (2500, 400, pii.MADE_UP * len(pii.KINDS))
    first = pa.array([of("phone", True), of("ip", True), -1])
    weights = pii._weights(first, pa.array([2500, 400, 7]), spans) / ONE
    assert weights == pytest.approx([pii.SPANS_OF_A_KIND, 400, 7])


def test_trees_do_not_hang_on_how_rows_lie(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 9, size=(3000, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 3] > 2)).astype(float)
    cuts = [np.arange(8.0)] * 4
    n = np.ones(len(y))
    grown = []
    for parts in (1, 3, 7):
        blocks = [(coded(x[i], cuts), y[i], n[i], n[i]) for i in np.array_split(rng.permutation(len(y)), 3 * parts)]
        grown.append(Boosted().fit_blocks(spark.sparkContext.parallelize(blocks, parts), cuts))
    here = Boosted().fit(x, y)
    assert grown[0] == grown[1] == grown[2] and grown[0].nodes == here.nodes
    assert ((here.predict(x) > 0.5) == y).mean() == 1


def test_thresholds_from_counted_rows():
    p, y, w = np.array([0.9, 0.9, 0.4, 0.4]), np.array([1.0, 0, 1, 0]), np.array([99.0, 1, 50, 50])
    whole = threshold(np.repeat(p, w.astype(int)), np.repeat(y, w.astype(int)), 0.98)
    assert threshold(p, y, 0.98, w) == whole == 0.9


def test_sums_of_few_partitions_are_not_shuffled(spark, monkeypatch):
    """A tree takes a job for each level, so a shuffle in each of them costs more than the work itself."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (3000, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] > 8).astype(float)
    cuts = [np.arange(8.0)] * 4
    blocks = [(coded(x[i::24], cuts), y[i::24], *[np.ones(len(y[i::24]))] * 2) for i in range(24)]
    many = Boosted(trees=2)
    with monkeypatch.context() as m:
        m.setattr(boosting, "DIRECT", 4, raising=False)
        many.fit_blocks(spark.sparkContext.parallelize(blocks, 24), cuts)

    def shuffled(*_):
        raise AssertionError("a shuffle for a few partitions")

    monkeypatch.setattr(RDD, "partitionBy", shuffled)
    few = Boosted(trees=2).fit_blocks(spark.sparkContext.parallelize(blocks, 24), cuts)
    assert few.nodes == many.nodes and len(few.nodes[0]) > 1
