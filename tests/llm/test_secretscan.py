import hashlib
import random
import re

import pytest

from shoplake.llm import secretscan as s
from shoplake.llm.queries import op9_trigram_secrets
from shoplake.llm.spans import digests


def brute(text):
    text, out = text or "", []
    for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


TEXTS = [
    None, "", "nothing here", "password: hunter22", "PassWord = 'abc'", 'é "api_key" : "sk/live=1234"', "APIKEY:abcdef", "passwd=12345",
    "token=" + "x" * 100000, "secret  :  aaaaaa password:bbbbbb", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "xAKIAAKIA" + "Z9" * 10,
    "f" * 24, "f" * 23, "0123456789abcdef" * 5000, "ſecret: abcdefg toKen: abcdefg", "tok", "en: abcdefgh", "pass word: abcdefgh",
    "ghp_" + "aZ" * 18, "-----BEGIN RSA PRIVATE KEY-----", "eyJ" * 20000, "xoxb-1234567890-abcdefghij", "token:\nabcdefgh", "token: token=abcdef",
]


def rows_of(spark, given):
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as base", "3 as kind")
    return [tuple(r) for r in digests(s.scanned(docs), [r.kind for r in s.BASE]).collect()]


def check(rows, given):
    want = []
    for i, t in given:
        spans = brute(t)
        n = [sum(x.startswith(k) for x in spans) for k in ("assign", "access", "hex")]
        want.append((i, *n, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert sorted(map(str, (r[:5] for r in rows))) == sorted(map(str, want))


def test_odd_texts(spark):
    given = list(enumerate(TEXTS)) + [(None, TEXTS[3]), (3, TEXTS[3])]
    rows = rows_of(spark, given)
    check(rows, given)
    extra = {r[0]: r[5] for r in rows}
    assert extra[20] == "github:0:40" and extra[21] == "pem:0:31" and extra[23] == "slack:0:26"
    assert rows_of(spark, []) == []


def test_made_up_texts(spark):
    rng = random.Random(2)
    bits = ["password", "Secret", "token", "api", "_key", "key", ":", "=", " ", '"', "abcdef", "AKIA", "Q7" * 8, "0a" * 9, "ü", "\n"]
    given = [(i, "".join(rng.choices(bits, k=rng.randint(0, 12)))) for i in range(2000)]
    check(rows_of(spark, given), given)


def test_queries_of_rules():
    assert s.trigram_query(s.BASE[2]) is None
    assert s.trigram_query(s.BASE[1]) == (frozenset({b"aki", b"kia"}),)
    assert frozenset({b"tok", b"oke", b"ken"}) in s.trigram_query(s.BASE[0])
    assert frozenset({b"api", b"pik", b"ike", b"key"}) in s.trigram_query(s.BASE[0])


@pytest.mark.parametrize("pattern", ["ab|cd", "a.c", "x*", "[abc]{3}", "(foo)?", "ab?c"])
def test_rules_without_mandatory_trigrams(pattern):
    query = s.trigram_query(s.Rule("r", pattern))
    assert query is None or all(query)


def test_query(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check([tuple(r) for r in op9_trigram_secrets(spark, sf_dir).collect()], given)
