"""Personal data in whole texts: generators propose spans, boosted trees choose among them.

The base spans (e-mail, IPv4, card, phone; fixed patterns and checks) always count.  Beside them, wide generators propose
spans that the patterns miss: e-mail addresses and IPv4 addresses written against robots, cards with other separators, phone
numbers without a plus sign, in any 2 to 6 groups of 7 to 15 digits in all.  Trees that see format and context give each proposal a score, and a threshold for each
kind, set on rows that the trees have not seen, selects.

The training rows come from all documents: from every distinct base span, and every distinct span that fails its kind's
check, copies once.  Nothing is sampled; the spans of a kind and truth that has more than `SPANS_OF_A_KIND` weigh less, so
that together they weigh as much as so many, and a common kind does not outweigh a rare one.  The trees are grown on sums
over all rows, added up by the tasks.  Base spans and the same data rewritten in
the other forms are true; failing spans, rewritten spans with digits changed until they fail, and other readings that overlap
a rewritten span and other groups of digits (days, amounts, card numbers that fail) are false.  A kind with fewer than `MADE_UP` base spans is filled up with made-up ones, so that no kind is
left out because a table is small or a kind rare; should a threshold still lack rows it is `FIXED_CUT`.
Numbers are put beside some of the true spans, so that a number that follows does not by itself speak against one.

Patterns start at the border of a run and never go back into it, so a scan takes time in proportion to the text.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.boosting import ONE, Boosted, coded, provable, threshold
from shoplake.llm.common import mapped, saved
from shoplake.llm.spans import SPANS, in_order

KINDS = ("email", "ip", "card", "phone")
SPANS_OF_A_KIND = 1000  # what the distinct spans of a kind weigh together at most, true and false ones each
SPANS_OF_A_TEXT = 50  # in a sample to look at, at most so many spans of one text, those of least hash
MADE_UP = 200  # made-up spans that every kind learns from beside its own
PRECISION = 0.98
LEAST_CUT = 0.5  # what the trees rather take for false is never selected, however well the held-out rows are told apart
FIXED_CUT = 0.9  # where even right rows would be too few to show the precision
AROUND = 80  # characters of context on either side that a training span keeps
Span = tuple[str, int, int]

# Fixed patterns of the base spans, written so that no search goes back.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Wide generators.
_AT = re.compile(r"\x20?[\[(](?:at|AT)[\])]\x20?")
_SPELT = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++")
_WIDE = {
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\x20\.\x20)[0-9]{1,3}+){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}+(?:[._/]|\x20-\x20|\x20\x20)[0-9]{4,6}+(?:(?:[._/]|\x20-\x20|\x20\x20)[0-9]{3,5}+){1,3}(?![0-9])"),
}
# Phone numbers: 2 to 6 groups of digits, 7 to 15 digits in all; what may stand between two groups.
_GROUP = re.compile(r"[0-9]++")
_GAP = re.compile(r"\)?(?:\x20-\x20|[\x20./-])?\(?")
GROUPS, FEWEST, MOST = 6, 7, 15
_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "pay", "credit"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid(kind: str, text: str) -> bool:
    """The kind's check of its digits."""
    digits = _digits(text)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in re.findall("[0-9]+", text))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_LETTERS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield "email", start, end
        else:
            end = max(end, at + 1)  # what lies before this sign cannot begin a later match
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """The fixed kinds: leftmost, not overlapping within a kind, failing matches dropped."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if _valid("ip", m[0])]
        found += [("card", *m.span()) for m in _CARD.finditer(text) if _valid("card", m[0])]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if _valid("phone", m[0])]
    return found


def _phones(text: str) -> Iterator[Span]:
    """Every reading of neighbouring groups as a phone number: the short ones and the longer ones."""
    groups = [m.span() for m in _GROUP.finditer(text)]
    for i, (first, end) in enumerate(groups):
        start, n = first, end - first
        if text[end : end + 1] == ")":  # the bracket and the plus sign belong to the group
            if text[max(0, start - 2) : start] == "(+":
                start -= 2
            elif text[max(0, start - 1) : start] == "(":
                start -= 1
        start -= text[max(0, start - 1) : start] == "+"
        for a, b in groups[i + 1 : i + GROUPS]:
            if a - end > 4 or not _GAP.fullmatch(text, end, a):
                break
            n, end = n + b - a, b
            if n > MOST:
                break
            if n >= FEWEST and text.count("(", start, end) == text.count(")", start, end):
                yield "phone", start, end


def proposals(text: str, base: Iterable[Span] = ()) -> list[Span]:
    """What the wide generators add; spans may overlap each other, those within a base span are left out."""
    found = []
    if "(" in text or "[" in text:
        for m in _AT.finditer(text):
            start, host = m.start(), _SPELT.match(text, m.end())
            while start and text[start - 1] in _LOCAL_LETTERS:
                start -= 1
            if start < m.start() and host:
                found.append(("email", start, host.end()))
    if _DIGIT.search(text):
        for kind, pattern in _WIDE.items():
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
        found += _phones(text)
    return [s for s in found if not any(a < s[2] and s[1] < b for _, a, b in base)] if found else found


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span; nothing tells the base forms from the others."""
    kind, start, end = span
    body, before, after = text[start:end], text[max(0, start - 40) : start].lower(), text[end : end + 40].lower()
    digits = _digits(body)
    groups = re.findall("[0-9]+", body)
    others = {c for c in body if not c.isalnum()}
    return [
        *(float(kind == k) for k in KINDS),
        float(_valid(kind, body)),
        len(digits),
        len(groups),
        len(groups[0]) if groups else 0,
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        max((int(g[:9]) for g in groups), default=0) if kind == "ip" else -1,
        len(body) - len(digits),
        len(others),
        sum(c.isalpha() for c in body),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        sum(c.isdigit() for c in before + after),
        float(any(w in before for w in _WORDS[kind])),
        float(len({len(g) for g in groups}) <= 1),
        len(set(digits)),
        *(body.count(c) for c in " .-/("),
        float(digits.startswith("0")),
        float(digits.startswith("00")),
        len(groups[-1]) if groups else 0,
        float(after[:1] in others and after[1:2].isdigit()),
        float(before[-1:] in others and before[-2:-1].isdigit()),
        float(bool(re.match("[^0-9a-z]?[0-9]", after))),
        float(bool(re.search("[0-9][^0-9a-z]?$", before))),
    ]


def _rewritten(kind: str, body: str, rng: random.Random) -> str:
    """The same data in a form that only the wide generators know."""
    digits = _digits(body)
    if kind == "email":
        return body.replace("@", rng.choice([" (at) ", "[at]", " [at] "])).replace(".", rng.choice([".", " (dot) ", "[dot]"]))
    if kind == "ip":
        return body.replace(".", rng.choice(["[.]", "(.)", " . "]))
    if kind == "card":
        return rng.choice([".", "_", " - ", "/"]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = digits[-10:]
    form = rng.choice(["({}) {}-{}", "{}-{}-{}", "{} {} {}", "{}.{}.{}", "pairs", "00", "0{} {}", "0{}/{}", "local"])
    if form == "pairs":
        return rng.choice(" .-").join(f"0{digits[-9:]}"[i : i + 2] for i in range(0, 10, 2))
    if form == "00":
        k = rng.randint(2, 3)
        return rng.choice(["00{} {} {}{}", "00{} {} {} {}"]).format(rng.choice([1, 33, 34, 44, 49]), digits[:k], digits[k:-4], digits[-4:])
    if form == "local":
        return f"{digits[-7:-4]}-{digits[-4:]}"
    if form[0] == "0":
        k = rng.randint(2, 4)
        return form.format(digits[:k], digits[k:])
    return form.format(digits[:-7], digits[-7:-4], digits[-4:])


def _spoilt(kind: str, body: str, rng: random.Random) -> str:
    """The same form with digits that fail the kind's check."""
    if kind == "card":
        i = rng.choice([k for k, c in enumerate(body) if c.isdigit()])
        return body[:i] + str((int(body[i]) + rng.randint(1, 9)) % 10) + body[i + 1 :]
    if kind == "ip":
        return re.sub("[0-9]+", lambda m: str(rng.randint(256, 999)), body, count=rng.randint(1, 4))
    if kind == "phone":
        return re.sub("[0-9]{2,}", lambda m: m[0][:1], body)
    return re.sub(r"[A-Za-z]+$", "0", body)


def _number(rng: random.Random) -> str:
    """A number as it may stand beside personal data."""
    n = rng.randint
    return rng.choice([f"{n(0, 255)}.{n(0, 255)}.{n(0, 255)}.{n(0, 255)}", str(n(1, 9999)), f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)}"])


def _decoy(rng: random.Random) -> str:
    """Groups of digits that are no phone number: days, times, years, amounts, versions, book and card numbers."""
    n = rng.randint
    year, month, day, hour, minute = n(1900, 2040), f"{n(1, 12):02d}", f"{n(1, 28):02d}", f"{n(0, 23):02d}", f"{n(0, 59):02d}"
    thousands = [f"{n(0, 999):03d}" for _ in range(n(2, 3))]
    card = _spoilt("card", " ".join(f"{n(0, 9999):04d}" for _ in range(4)), rng)
    if luhn(_digits(card)):
        card = card[:-1] + str((int(card[-1]) + 1) % 10)
    return rng.choice([
        f"{year}-{month}-{day}", f"{year}-{month}-{day} {hour}", f"{year}/{month}/{day}", f"{day}.{month}.{year}", f"{day}/{month}/{year}",
        f"{year}-{year + n(1, 20)}", f"{year} {n(100, 9999)}", f"{year}{month}{day}-{hour}{minute}{day}", f"{year} - {year + 1}",
        ".".join([str(n(1, 999)), *thousands]), " ".join([str(n(1, 999)), *thousands]), f"{n(1, 40)}.{n(0, 99)}.{n(1000, 99999)}",
        f"{n(10000, 99999)}.{n(10, 99999)}", f"{n(100, 99999)} {n(100, 99999)} {n(1, 999)}", f"{n(1, 99)} {n(1, 99)} {n(1, 99)} {n(1, 99)}.{n(0, 99)}",
        f"{n(100, 9999)} {n(1000, 9999)}", f"978-{n(0, 9)}-{n(10, 999)}-{n(10000, 99999)}-{n(0, 9)}", card, card.replace(" ", rng.choice("-./")),
        f"{n(0, 99)} {n(10**6, 10**9)}", f"{n(1, 1000)}-{n(10**5, 10**8)}-{n(1, 99)}",
    ])


def training_rows(text: str, span: Span, true: bool, seed: int) -> tuple[list[list[float]], list[int], list[str]]:
    """Features, truth and kinds of the rows that a span gives."""
    rng, x, y, kinds = random.Random(seed), [], [], []

    def add(text: str, span: Span, true: bool) -> None:
        x.append(features(text, span))
        y.append(int(true))
        kinds.append(span[0])

    add(text, span, true)
    if not true:
        return x, y, kinds
    kind, start, end = span
    form = _rewritten(kind, text[start:end], rng)
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    beside = f" {_number(rng)} "
    for body, right, tail in (
        (form, True, after), (form, True, beside + after), (text[start:end], True, beside + after), (_spoilt(kind, form, rng), False, after),
    ):
        whole, at = before + body + tail, len(before)
        own = (kind, at, at + len(body))
        if kind == "phone" and right != (FEWEST <= len(_digits(body)) <= MOST):
            continue
        add(whole, own, right)
        for other in proposals(whole, base_spans(whole)):
            inner = right and other[0] == kind and own[1] <= other[1] and other[2] <= own[2]  # a part of the truth
            if other[1] < own[2] and own[1] < other[2] and not inner:
                add(whole, other, False)
    whole = before + _decoy(rng) + after
    for other in proposals(whole, base_spans(whole)):
        if other[1] < len(whole) - len(after) and other[2] > len(before):
            add(whole, other, False)
    return x, y, kinds


def _candidates(text: str) -> Iterator[tuple[Span, bool]]:
    """The spans of a text that tell something: base spans are true, spans that fail their kind's check are false."""
    base = base_spans(text)
    yield from ((s, True) for s in base)
    yield from ((s, False) for s in proposals(text, base) if s[0] != "phone" and not _valid(s[0], text[s[1] : s[2]]))
    for pattern, kind in ((_IP, "ip"), (_CARD, "card"), (_PHONE, "phone")):
        for m in pattern.finditer(text):
            if 6 < len(m[0]) and not _valid(kind, m[0]):
                yield (kind, *m.span()), False


def _made_up(kind: str, i: int) -> tuple[str, Span]:
    """A text with a base span of the kind, the same for the same number."""
    rng = random.Random(f"{kind} {i}")
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    if kind == "email":
        body = f"{word()}{rng.choice(['.', '_', ''])}{word()}{rng.choice(['', number(2)])}@{word()}.{rng.choice(['com', 'org', 'net', 'co.uk'])}"
    elif kind == "ip":
        body = ".".join(str(rng.randint(0, 255)) for _ in range(4))
    elif kind == "card":
        body = number(15)
        body += next(c for c in "0123456789" if luhn(body + c))
        body = rng.choice(["", " ", "-"]).join(body[k : k + 4] for k in range(0, 16, 4))
    else:
        body = rng.choice(["+1 ({}) {}-{}", "+49 {} {} {}", "+33-{}-{}-{}"]).format(number(3), number(3), number(4))
    before = " ".join([*(word() for _ in range(rng.randint(0, 6))), rng.choice([*_WORDS[kind], word(), word()]), ""])
    return f"{before}{body}{rng.choice(['.', ',', ''])} {word()} {word()}", (kind, len(before), len(before) + len(body))


def _scores(trees: Boosted, x: np.ndarray) -> np.ndarray:
    """In steps of 0.0001, so that there are few to choose a threshold from."""
    return np.round(trees.predict(x), 4)


@dataclass(frozen=True)
class Model:
    trees: Boosted
    cuts: dict[str, float]

    def selected(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and the proposals whose score reaches the threshold of their kind; of those that overlap the longest."""
        base = base_spans(text)
        wide = [s for s in proposals(text, base) if self.cuts[s[0]] <= 1]
        if not wide:
            return base, []
        scores = _scores(self.trees, np.array([features(text, s) for s in wide], float))
        chosen: list[Span] = []
        for p, s in sorted(zip(scores, wide), key=lambda x: (x[1][1] - x[1][2], -x[0], x[1])):
            if p >= self.cuts[s[0]] and not any(a < s[2] and s[1] < b for _, a, b in chosen):
                chosen.append(s)
        return base, chosen


def _hashed(text: str) -> Iterator[tuple[Span, bool, int]]:
    """The candidates, and a hash of what is written there."""
    for span, true in _candidates(text):
        yield span, true, xxhash.xxh64_intdigest(f"{span[0]} {text[span[1] : span[2]]}") >> 1


def _least(text: str) -> Iterator[tuple[Span, bool, int]]:
    """Of the candidates of each kind and truth, `SPANS_OF_A_TEXT` distinct ones of least hash, with all their places."""
    groups: dict[tuple[str, bool], dict[int, list[Span]]] = {}
    for span, true, h in _hashed(text):
        groups.setdefault((span[0], true), {}).setdefault(h, []).append(span)
    for (_, true), places in groups.items():
        for h in sorted(places)[:SPANS_OF_A_TEXT]:
            yield from ((span, true, h) for span in places[h])


_DRAWS = 1 << 20
_AT_ONCE = 10_000  # rows that a task holds before it passes them on


def _drawn(docs: DataFrame, text_col: str, bounds: dict[tuple[str, bool], int] | None = None) -> DataFrame:
    """The distinct candidates of all texts, with the text around; with bounds the least of each text, below their bound."""

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed_on(out: Iterable[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 6
            types = (pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["kind", "true", "h", "text", "start", "end"])

        for b in batches:
            out: dict[tuple, None] = {}
            for t in b.column(0):
                text = t.as_py()
                for (kind, start, end), true, h in _hashed(text) if bounds is None else _least(text):
                    if bounds is None or h % _DRAWS < bounds.get((kind, true), 0):
                        first = max(0, start - AROUND)
                        out[kind, true, h, text[first : end + AROUND], start - first, end - first] = None
                    if len(out) >= _AT_ONCE:
                        yield passed_on(out)
                        out.clear()
            yield passed_on(out)

    text = F.col(text_col)
    rows = docs.where(text.rlike("[0-9@]")).select(text)
    rows = mapped(rows, draw, "kind string, true boolean, h long, text string, start int, end int")
    # Of the places of a span the one with the least text around, so that the choice hangs on the data alone.
    place = F.min(F.struct("text", "start", "end")).alias("place")
    return rows.groupBy("kind", "true", "h").agg(place).select("kind", "true", "h", "place.*")


def training_spans(docs: DataFrame, sample: int = SPANS_OF_A_KIND, text_col: str = "text") -> list[tuple[str, Span, bool, int]]:
    """A sample to look at of what `trained` learns from: texts with a span each, whether it is true, and its hash.

    About `sample` spans of each kind and truth, and made-up ones.
    """
    every = {(k, t): _DRAWS for k in KINDS for t in (True, False)}
    sizes = _drawn(docs, text_col, every).groupBy("kind", "true").agg(F.count("h").alias("n")).collect()
    bounds = {(r.kind, r.true): _DRAWS if r.n <= sample else int(sample / r.n * _DRAWS) for r in sizes}
    rows = _drawn(docs, text_col, bounds).toArrow()
    out = [(r["text"], (r["kind"], r["start"], r["end"]), r["true"], r["h"]) for r in rows.to_pylist()]
    for kind in KINDS:
        out += [(*_made_up(kind, i), True, i) for i in range(min(MADE_UP, sample))]
    return sorted(out, key=lambda r: (r[1][0], r[2], r[3]))


def learning_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The training rows of all distinct spans and of the made-up ones, one span in three held out to set the thresholds.

    `part` tells kind and truth of the span, -1 for the made-up ones; `kind` and `y` are the row's own kind and truth, `x` its
    features as doubles.  Equal rows come as one: `n` is their number, `spans` that of the spans that they are the first row of.
    """

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.bool_(), pa.binary())
        for b in batches:
            out: list[tuple] = []
            for kind, true, h, text, start, end, made in zip(*(c.to_pylist() for c in b.columns)):
                part = -1 if made else 2 * KINDS.index(kind) + true
                for i, (x, y, of) in enumerate(zip(*training_rows(text, (kind, start, end), true, h))):
                    out.append((part, i == 0, h % 3 == 0, of, bool(y), np.array(x, float).tobytes()))
                if len(out) >= _AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["part", "first", "held", "kind", "y", "x"]
    made = [(k, True, i, text, span[1], span[2]) for k in KINDS for i in range(MADE_UP) for text, span in [_made_up(k, i)]]
    spans = _drawn(docs, text_col)
    given = docs.sparkSession.createDataFrame(made, spans.schema)
    spans = spans.withColumn("made", F.lit(False)).unionAll(given.withColumn("made", F.lit(True)))
    # A span is small, but what is made of it takes a millisecond: dealt by number, not by bytes.
    spans = spans.repartition(2 * docs.sparkSession.sparkContext.defaultParallelism, "h")
    rows = mapped(spans, learn, "part int, first boolean, held boolean, kind string, y boolean, x binary")
    return rows.groupBy("part", "held", "kind", "y", "x").agg(F.count("x").alias("n"), F.count_if("first").alias("spans"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(len(column), -1)


def _weights(part: pa.Array, n: pa.Array, sizes: dict[int, int]) -> np.ndarray:
    """Whole numbers, `ONE` for a weight of 1."""
    each = [max(1, ONE * SPANS_OF_A_KIND // max(SPANS_OF_A_KIND, sizes.get(p, 0))) for p in part.to_pylist()]
    return np.array(each, np.int64) * n.to_numpy()


def _feature_cuts(rows: DataFrame, sizes: dict[int, int], bins: int) -> list[np.ndarray]:
    """The quantiles of each feature over all rows, by weight: values that end one of `bins` parts of equal weight."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = _weights(b.column(0), b.column(1), sizes)
            for f, x in enumerate(_matrix(b.column(2)).T if len(w) else ()):
                values, at = np.unique(x, return_inverse=True)
                total = np.zeros(len(values), np.int64)
                np.add.at(total, at, w)
                yield pa.RecordBatch.from_arrays([pa.array([f] * len(values), pa.int32()), pa.array(values), pa.array(total)], ["f", "v", "w"])

    by_feature = Window.partitionBy("f")
    up_to = F.sum("w").over(by_feature.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    counts = mapped(rows.select("part", "n", "x"), counted, "f int, v double, w long").groupBy("f", "v").agg((F.sum("w") / ONE).alias("w"))
    sums = counts.select("f", "v", "w", up_to.alias("s"), F.sum("w").over(by_feature).alias("total"))
    below, after = F.ceil((F.col("s") - F.col("w")) * bins / F.col("total")), F.floor(F.col("s") * bins / F.col("total"))
    found = sums.where(F.greatest(below, F.lit(1)) <= F.least(after, F.lit(bins - 1))).select("f", "v").collect()
    cuts: list[list[float]] = [[] for _ in range(1 + max((r.f for r in found), default=-1))]
    for r in found:
        cuts[r.f].append(r.v)
    return [np.array(sorted(c)) for c in cuts]


def _blocks(rows: DataFrame, sizes: dict[int, int], cuts: Sequence[np.ndarray]) -> DataFrame:
    """Many rows in one: bins of the features, truth, weight, number."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                n, y = b.column(1).to_numpy().astype(float), np.array(b.column(3).to_pylist(), float)
                columns = coded(_matrix(b.column(2)), cuts), y, _weights(b.column(0), b.column(1), sizes) / ONE, n
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names)

    names = ["codes", "y", "w", "n"]
    return mapped(rows.select("part", "n", "x", "y"), packed, ", ".join(f"{n} binary" for n in names))


def _held_scores(rows: DataFrame, sizes: dict[int, int], trees: Boosted) -> DataFrame:
    """Weight of the rows of each kind, score and truth."""

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p, w = pa.array(_scores(trees, _matrix(b.column(2)))), pa.array(_weights(b.column(0), b.column(1), sizes))
                yield pa.RecordBatch.from_arrays([b.column(3), b.column(4), p, w], ["kind", "y", "p", "w"])

    rows = mapped(rows.select("part", "n", "x", "kind", "y"), scored, "kind string, y boolean, p double, w long")
    return rows.groupBy("kind", "y", "p").agg(F.sum("w").alias("w"))


def trained(docs: DataFrame, text_col: str = "text") -> Model:
    """Trees from all distinct spans of all texts; the rows of one span in three set the thresholds."""
    rows = saved(learning_rows(docs, text_col), "learning_rows")
    sizes = {r.part: r.n for r in rows.where("part >= 0").groupBy("part").agg(F.sum("spans").alias("n")).collect()}
    learned, held = rows.where("not held"), rows.where("held")
    trees = Boosted()
    cuts = _feature_cuts(learned, sizes, trees.bins)
    blocks = saved(_blocks(learned, sizes, cuts), "learning_blocks").rdd.map(
        lambda r: (np.frombuffer(r.codes, np.uint8).reshape(-1, len(cuts)), *map(np.frombuffer, (r.y, r.w, r.n)))
    )
    trees.fit_blocks(blocks, cuts)
    # At most 10,001 scores of each kind and truth, however many rows were held.
    scores = _held_scores(held, sizes, trees).toArrow()
    kinds, y, p, w = (scores.column(c).to_numpy() for c in ("kind", "y", "p", "w"))
    y, w, cuts_of = y.astype(float), w / ONE, {}
    for k in KINDS:
        of = kinds == k
        enough = provable((y * w)[of].sum(), PRECISION)
        cuts_of[k] = max(LEAST_CUT, threshold(p[of], y[of], PRECISION, w[of])) if enough else FIXED_CUT
    return Model(trees, cuts_of)


def found(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, `base` and `spans` (base and selected) of every row; null and empty texts have none."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        named = lambda spans: [dict(zip(("kind", "start", "end"), s)) for s in in_order(spans, KINDS)]
        for batch in batches:
            first, every = [], []
            for text in batch.column(1):
                base, more = model.selected(text.as_py() or "")
                first.append(named(base))
                every.append(named(base + more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(first, kind), pa.array(every, kind)], ["doc_id", "base", "spans"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(rows, scan, f"doc_id long, base {SPANS}, spans {SPANS}")


def masked(text: str, spans: Iterable[Span]) -> str:
    """The text with <KIND> in place of every span; of spans that overlap, the first names the whole."""
    out, end, name = [], 0, ""
    for kind, a, b in in_order(list(spans), KINDS):
        if a >= end or not name:
            out += [text[end:a], f"<{kind.upper()}>"]
            end, name = b, kind
        else:
            end = max(end, b)
    return "".join(out) + text[end:]


def redacted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns, with the selected spans of the text masked."""
    at = docs.columns.index(text_col)

    def mask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                base, more = model.selected(text or "")
                texts.append(masked(text, base + more) if base or more else text)
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(texts, batch.schema.field(at).type))

    return mapped(docs, mask, docs.schema)
