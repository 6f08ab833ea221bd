"""Secret rules over whole texts, by a trigram index of each segment.

From every rule's regular expression a Boolean query is derived: one of several sets of three-byte strings, one set for each
alternative of the expression, must all occur in a matching text.  Texts are read in segments (an Arrow batch, bounded in
bytes).  Of each segment the postings of the queries' trigrams are built, without regard to the case of A-Z; the
postings are intersected, and only texts left are matched with the rule.  Rules with an alternative that needs no
trigram match every text.

A segment's index lives as long as the segment is in the task, so nothing is shuffled and a lost task is simply
repeated.
"""

from __future__ import annotations

import re
import re._constants as ops
import re._parser as parser
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.spans import SPANS, in_order

_FEW = 64  # alternatives that a query may have; beyond it, parts of the expression are left out of the query
_CHUNK = 4 << 20


@dataclass(frozen=True)
class Rule:
    """Matches of a pattern (ASCII), leftmost and not overlapping, whose `group` has `least` characters or more."""

    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The base rules.  A run of hex digits is one match, so asking for 24 in the pattern drops the same runs.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Rules of the method: public forms of well-known keys.  Each starts at the border of a word, so a scan stays linear.
MORE = (
    Rule("github", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"(?<![A-Za-z0-9-])xox[abprs]-[A-Za-z0-9-]{16,}"),
    Rule("google", r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)

_GAP = None  # in an alternative: any text may stand here


def _fold(code: int) -> str:
    c = chr(code)
    return c.lower() if c.isascii() else c


def _product(left: list[list], right: list[list]) -> list[list]:
    if len(left) * len(right) > _FEW:
        return [x + [_GAP] for x in left]
    return [x + y for x in left for y in right]


def _alternatives(nodes: Iterable) -> list[list]:
    """Lists of letters and gaps; every match holds one of them, with some text for each gap."""
    out: list[list] = [[]]
    for op, arg in nodes:
        if op is ops.LITERAL:
            out = _product(out, [[_fold(arg)]])
        elif op is ops.IN:
            letters = {_fold(x) for kind, x in arg if kind is ops.LITERAL}
            plain = all(kind is ops.LITERAL for kind, _ in arg)
            out = _product(out, [[x] for x in sorted(letters)] if plain and len(letters) <= 8 else [[_GAP]])
        elif op is ops.BRANCH:
            out = _product(out, [x for branch in arg[1] for x in _alternatives(branch)])
        elif op is ops.SUBPATTERN:
            out = _product(out, _alternatives(arg[-1]))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            low, high, item = arg
            once = _alternatives(item)
            if (low, high) == (0, 1):
                out = _product(out, [[], *once])
            else:
                for _ in range(min(low, 4)):
                    out = _product(out, once)
                if high != low or low > 4:
                    out = [x + [_GAP] for x in out]
        elif op not in (ops.AT, ops.ASSERT, ops.ASSERT_NOT):
            out = [x + [_GAP] for x in out]
    return out


@lru_cache
def trigram_query(rule: Rule) -> tuple[frozenset[bytes], ...] | None:
    """Sets of trigrams, one of which must be complete in a text that matches; None if the rule must scan all."""
    query = set()
    for letters in _alternatives(parser.parse(rule.pattern, re.ASCII)):
        runs = "".join("\0" if x is _GAP else x for x in letters).split("\0")
        grams = frozenset(b[i : i + 3] for r in runs for b in [r.encode()] for i in range(len(b) - 2))
        if not grams:
            return None
        query.add(grams)
    return tuple(q for q in query if not any(other < q for other in query))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Segment:
    """The postings of some trigrams in the texts of one Arrow array."""

    def __init__(self, texts: pa.StringArray, grams: list[bytes], slots: np.ndarray):
        n = self.n = len(texts)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        seen = [np.zeros(0, np.int64)]
        for at in range(0, max(0, len(raw) - 2), _CHUNK):
            b = _LOWER[raw[at : at + _CHUNK + 2]].astype(np.int32)
            slot = slots[b[:-2] << 16 | b[1:-1] << 8 | b[2:]]
            where = np.flatnonzero(slot)
            text = np.searchsorted(ends, where + at, "right") - 1
            inside = where + at + 2 < ends[text + 1]
            seen.append(np.unique((slot[where[inside]].astype(np.int64) - 1) * n + text[inside]))
        keys = np.unique(np.concatenate(seen))
        cuts = np.searchsorted(keys, np.arange(len(grams) + 1) * n)
        self.postings = {g: keys[a:b] - i * n for i, (g, a, b) in enumerate(zip(grams, cuts, cuts[1:]))}

    def candidates(self, query: tuple[frozenset[bytes], ...] | None) -> np.ndarray:
        """Numbers of the texts that can match."""
        if query is None:
            return np.arange(self.n)
        out = [np.zeros(0, np.int64)]
        for grams in query:
            lists = sorted((self.postings[g] for g in grams), key=len)
            left = lists[0]
            for other in lists[1:]:
                left = np.intersect1d(left, other, assume_unique=True)
            out.append(left)
        return np.unique(np.concatenate(out))


def _slots(rules: tuple[Rule, ...]) -> tuple[list[bytes], np.ndarray]:
    """The queries' trigrams, and a number from 1 for each of them by its three bytes."""
    grams = sorted({g for r in rules for q in trigram_query(r) or () for g in q})
    slots = np.zeros(1 << 24, np.uint16)
    for i, g in enumerate(grams):
        slots[int.from_bytes(g)] = i + 1
    return grams, slots


def scanned(
    docs: DataFrame,
    base: tuple[Rule, ...] = BASE,
    more: tuple[Rule, ...] = MORE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, `base` and `spans` (base and more) of every row; null and empty texts have none.

    Spans of one rule don't overlap, those of different rules may.  Every row is scanned whole; other columns are not read.
    """
    rules = (*base, *more)
    kinds, n_base = [r.kind for r in rules], {r.kind for r in base}

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, slots = _slots(rules)
        patterns = [(r, r.compiled(), trigram_query(r)) for r in rules]
        for batch in batches:
            texts = batch.column(1).fill_null("")
            segment = Segment(texts, grams, slots)
            found: dict[int, list] = {}
            for rule, pattern, query in patterns:
                for i in segment.candidates(query).tolist():
                    for m in pattern.finditer(texts[i].as_py()):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found.setdefault(i, []).append((rule.kind, m.start(), m.end()))
            rows = [in_order(found.get(i, ()), kinds) for i in range(len(texts))]
            named = lambda spans: [dict(zip(("kind", "start", "end"), s)) for s in spans]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            first = pa.array([named(s for s in r if s[0] in n_base) for r in rows], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), first, pa.array(map(named, rows), kind)], ["doc_id", "base", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, base {SPANS}, spans {SPANS}")
