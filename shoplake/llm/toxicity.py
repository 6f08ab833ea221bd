"""Toxicity by a weighted pattern grammar over clauses.

A clause is read as a string of classes: insult, threat, target, negation, report, quote or other.  Five small
transducers read it side by side: `insult` and `threat` emit the weights of their words, `target` tells whether someone is
addressed, `negation` whether a negation stands a few words before, `report` whether the words are someone else's.  Their
composition labels each emission, so a document is scored by its matched clauses: how much weight was meant, aimed at
someone, negated, or reported.

Insult words and word beginnings are learned from labelled rows: those that a test of their counts sets apart, beside a
few fixed ones.  The labels' meaning - how much each kind of clause counts - is learned by logistic regression on the
same rows, with a prior for what the rows do not show.  At most about SAMPLE labelled rows are used, chosen by a hash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import mapped

SAMPLE = 20_000
LEXICON = 5_000  # learned entries at most; the test lets through far fewer
STARTS = (4, 5, 6, 7, 8)  # lengths of word beginnings that are learned beside whole words
WORDS_OF_A_START = 3  # a beginning that fewer words share says no more than the words themselves

# The grammar's own words.
INSULTS = (
    "idiot", "stupid", "moron", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "dumb", "ugly",
    "imbecile", "filth", "vermin", "bastard",
)
THREATS = ("kill", "hurt", "beat", "stab", "shoot", "strangle", "destroy", "töten", "umbringen", "tuer", "frapper", "matar", "golpear")
TARGETS = (
    "you", "your", "he", "him", "she", "her", "they", "them", "du", "dich", "dir", "ihr", "euch", "sie", "er",
    "tu", "toi", "vous", "il", "elle", "ils", "tú", "usted", "ustedes", "él", "ella", "ellos",
)
NEGATIONS = ("not", "no", "never", "none", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "ni")
REPORTS = (
    "said", "says", "called", "calls", "wrote", "claimed", "quoted", "sagte", "schrieb", "nannte", "dit", "écrit", "dijo",
    "escribió", "llamó",
)

_CLAUSE = re.compile(r"[^.!?;\n]+")
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
_INSULT, _THREAT, _TARGET, _NEGATION, _REPORT, _QUOTE, _OTHER = range(7)


@dataclass(frozen=True)
class Transducer:
    """Moves by (state, class); where no move is given the state stays."""

    states: int
    moves: dict[tuple[int, int], int]

    def step(self, state: int, kind: int) -> int:
        return self.moves.get((state, kind), state)


# A negation reaches three words on; a report to the end of the clause; a quote until it is closed.
NEGATION = Transducer(4, {(s, k): 3 if k == _NEGATION else max(0, s - 1) for s in range(4) for k in range(7)})
REPORTED = Transducer(3, {(0, _REPORT): 1, (1, _QUOTE): 2, (2, _QUOTE): 1})
AIMED = Transducer(2, {(0, _TARGET): 1})
ARMED = Transducer(2, {(0, _THREAT): 1})
PARTS = (NEGATION, REPORTED, AIMED, ARMED)

MEANT, AIMED_AT, NEGATED, QUOTED, THREATENED = range(5)
FEATURES = 5


def _compose() -> tuple[list[list[int]], list[list[int]]]:
    """The product of the parts: next states, and for each move the label of what it emits (-1: nothing)."""
    states = list(product(*(range(p.states) for p in PARTS)))
    number = {s: i for i, s in enumerate(states)}
    moves, labels = [], []
    for s in states:
        to = [tuple(p.step(x, k) for p, x in zip(PARTS, s)) for k in range(7)]
        moves.append([number[t] for t in to])
        line = []
        for k, t in enumerate(to):
            negated, reported, aimed, armed = s[0] > 0, s[1] > 0, t[2] > 0, t[3] > 0
            hit = k == _INSULT or (k in (_TARGET, _THREAT) and aimed and armed and not (s[2] and s[3]))
            if not hit:
                line.append(-1)
            elif reported:
                line.append(QUOTED)
            elif negated:
                line.append(NEGATED)
            elif k != _INSULT:
                line.append(THREATENED)
            else:
                line.append(AIMED_AT if aimed else MEANT)
        labels.append(line)
    return moves, labels


MOVES, LABELS = _compose()


class Grammar:
    """The transducers with a lexicon: whole words, and beginnings of words."""

    def __init__(self, words: dict[str, float], starts: dict[str, float]):
        import ahocorasick

        self.words = {w: 3.0 for w in (*INSULTS, *THREATS)} | words
        self.starts = starts
        fixed = ((TARGETS, _TARGET), (NEGATIONS, _NEGATION), (REPORTS, _REPORT), (THREATS, _THREAT))
        self.kinds = {w: k for ws, k in fixed for w in ws}
        self.search = ahocorasick.Automaton()
        for w in self.words:
            self.search.add_word(w, len(w))
        for w in starts:
            self.search.add_word(w, len(w))
        self.search.make_automaton()

    def _read(self, token: str) -> tuple[int, float]:
        kind = self.kinds.get(token)
        if kind is not None:
            return kind, self.words.get(token, 0.0)
        weight = self.words.get(token, 0.0) or max((self.starts.get(token[:n], 0.0) for n in STARTS), default=0.0)
        return (_INSULT, weight) if weight else (_QUOTE if not token.isalpha() else _OTHER, 0.0)

    def clause(self, text: str) -> list[float]:
        """What a clause emits, by label."""
        out, state, held = [0.0] * FEATURES, 0, 0.0
        for token in _TOKEN.findall(text):
            kind, weight = self._read(token)
            held = max(held, weight) if kind == _THREAT else held
            label = LABELS[state][kind]
            if label >= 0:
                out[label] += weight if kind == _INSULT else held
            state = MOVES[state][kind]
        return out

    def features(self, text: str) -> list[float]:
        """Sums over the matched clauses, on a scale that lets a first clause count most."""
        text, out, end = text.lower(), [0.0] * FEATURES, -1
        hits = [at for at, n in self.search.iter(text) if at - n < 0 or not text[at - n].isalpha()]
        if hits:
            hit, clauses = iter(hits), _CLAUSE.finditer(text)
            at, m = next(hit, None), next(clauses, None)
            while at is not None and m is not None:
                if m.end() <= at:
                    m = next(clauses, None)
                    continue
                if end != m.end():
                    end = m.end()
                    out = [a + b for a, b in zip(out, self.clause(m[0]))]
                at = next(hit, None)
        return [math.log1p(x) for x in out]


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    starts: dict[str, float]
    weights: tuple[float, ...]  # the first is the constant

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + features @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def lexicon(rows: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings whose counts in toxic rows (text, toxic) chance does not explain, with log odds as weights.

    Rows with the same words in the same order, as copies have, count once.  An entry is kept if its log likelihood ratio
    beats the logarithm of the number of entries tried, and it is twenty times as frequent in toxic rows.
    """
    docs = rows.select("toxic", F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 1).alias("said"))
    docs = docs.select("toxic", F.xxhash64("said").alias("copy"), F.array_distinct("said").alias("words"))
    docs = docs.groupBy("copy", "toxic").agg(F.min("words").alias("words"))
    starts = [F.transform(F.filter("words", lambda w: F.length(w) > n), lambda w: F.concat(F.left(w, F.lit(n)), F.lit("*"))) for n in STARTS]
    units = docs.select("toxic", F.explode_outer(F.array_distinct(F.concat("words", *starts))).alias("unit"))
    counts = units.groupBy("unit").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    stems = F.array(*(F.when(F.length("unit") > n, F.concat(F.left("unit", F.lit(n)), F.lit("*"))) for n in STARTS))
    stems = counts.where(~F.col("unit").endswith("*")).select(F.explode_outer(F.array_compact(stems)).alias("unit"))
    shared = stems.groupBy("unit").count().where(F.col("count") >= WORDS_OF_A_START).select("unit")
    counts = counts.where(F.col("bad") + F.col("good") >= 3)
    is_start = F.col("unit").endswith("*")
    counts = counts.where(~is_start).unionAll(counts.where(is_start).join(shared, "unit", "left_semi"))
    sizes = docs.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    bad, good = sizes.bad or 0, sizes.good or 0
    if not bad or not good:
        return {}, {}
    base = bad / (bad + good)
    share = F.col("bad") / (F.col("bad") + F.col("good"))
    part = lambda n, p, q: F.when(n > 0, n * F.log(p / q)).otherwise(0.0)
    ratio = part(F.col("bad"), share, base) + part(F.col("good"), 1 - share, 1 - base)
    weight = F.log(((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1)))
    tried = counts.count()
    scored = counts.select("unit", ratio.alias("ratio"), weight.alias("weight"))
    scored = scored.where((F.col("ratio") > math.log(max(tried, 1)) + 1) & (F.col("weight") > math.log(20)))
    found = scored.orderBy(F.desc("ratio"), "unit").limit(LEXICON).collect()
    return (
        {r.unit: r.weight for r in found if not r.unit.endswith("*")},
        {r.unit[:-1]: r.weight for r in found if r.unit.endswith("*")},
    )


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a prior: meant and aimed insults and threats count, negated and reported ones hardly.

    Labels of one class say nothing on what sets the classes apart, so the prior holds.
    """
    prior = np.array([-3.0, 2.5, 2.5, 0.3, 0.3, 2.5])
    if len(np.unique(y)) < 2:
        return tuple(map(float, prior))
    x, w, ridge = np.column_stack([np.ones(len(x)), x.reshape(-1, FEATURES)]), prior.copy(), np.array([0.1, 1, 1, 1, 1, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (y - p) - ridge * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def _mapped(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns to keep and `features` of the text."""
    words, starts = model.words, model.starts

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, starts)
        for b in batches:
            out = [grammar.features(t.as_py() or "") for t in b.column(len(keep))]
            columns = [*(b.column(i) for i in range(len(keep))), pa.array(out, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "features"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", features array<double>"
    return mapped(rows.select(*keep, "text"), read, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from; a null id counts as one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def trained(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Lexicon and weights from labelled rows that are not held out.  Without labels the fixed words and the prior hold."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(sample / n * (1 << 20)))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(known), "doc_id")  # about `sample` rows of two numbers
    words, starts = lexicon(rows)
    blank = Model(words, starts, ())
    got = _mapped(rows, blank, ["toxic"]).toArrow()
    x = np.array(got.column("features").to_pylist(), float).reshape(-1, FEATURES)
    return Model(words, starts, _fit(x, np.array(got.column("toxic").to_pylist(), float)))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts get the score of a text without a match."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    z = F.lit(model.weights[0])
    for k, w in enumerate(model.weights[1:]):
        z = z + F.get("features", F.lit(k)) * w
    return _mapped(rows, model, ["doc_id"]).select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def kept(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all columns, whose score is below a half.

    Null and empty texts get the score of a text without a match; rows that repeat are judged alike.  No rows give no rows.
    """
    words, starts, at = model.words, model.starts, docs.columns.index(text_col)

    def drop(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, starts)
        for b in batches:
            x = np.array([grammar.features(t.as_py() or "") for t in b.column(at)], float).reshape(-1, FEATURES)
            yield b.filter(pa.array(model.score(x) < 0.5))

    return mapped(docs, drop, docs.schema)
