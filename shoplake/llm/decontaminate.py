"""Documents that contain passages of test items, by winnowed fingerprints.

Every text becomes a list of words; each run of K words has a hash, and from every WINDOW neighbouring runs the least hash is
kept with its place.  Two texts that share SPAN = WINDOW + K - 1 words share a whole window, hence a kept hash, so the join of
kept hashes misses no shared span of that length.  Around each place that was met, the spans of SPAN words that hold it are
compared with the items' spans by their digests, which extends hits to whole passages and removes chance meetings.

Items shorter than SPAN, which winnowing cannot promise to meet, are one span each: for every such length that occurs among
the items, all runs of that length are hashed and met in the same way.

Lists are unrolled with the outer form of explode: the plain form adds a filter on the list's size, which the optimizer
would push below the steps that build the list, and so build it anew inside each of them.

Only DataFrame functions are used.  Texts with the same id are told apart by a hash; null texts have no words; items
without an id or words take no part; rows that repeat get the same answer each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import ascii_lower, near, saved

K, SPAN = 5, 13
WINDOW = SPAN - K + 1
# A kept hash and its place in one number, so that the least one also has the first place.
_HASH, _PLACE = (1 << 32) - 1, (1 << 31) - 1


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and letters beyond ASCII, A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _runs(hashes: str, length: int) -> Column:
    """The hash of every run of so many words."""
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (length - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *(F.get(hashes, i + k) for k in range(1, length))))


def _least(values: str, step: int) -> Column:
    """The least of each three values that lie `step` apart."""
    starts = F.slice(values, 1, F.greatest(F.size(values) - 2 * step, F.lit(0)))
    return F.transform(starts, lambda x, i: F.least(x, F.get(values, i + step), F.get(values, i + 2 * step)))


def hashed(texts: DataFrame, *keys: str) -> DataFrame:
    """The keys, `n_words` and `hashes`, the hash of every word.

    Each list is a column of its own that is used more than once, so that Spark builds it once for a row.
    """
    rows = texts.select(*keys, words(F.col("text")).alias("words"))
    return rows.select(*keys, F.size("words").alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))


def winnowed(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys, `n_words` and `kept`, the kept hashes with their places.  `rows` come from `hashed`."""
    packed = F.transform(
        _runs("hashes", K), lambda x, i: F.shiftleft(x.bitwiseAND(_HASH), 31).bitwiseOR(i.cast("long"))
    )
    rows = rows.select(*keys, "n_words", packed.alias("runs"))
    rows = rows.select(*keys, "n_words", _least("runs", 1).alias("threes"))
    rows = rows.select(*keys, "n_words", _least("threes", 3).alias("nines"))
    return rows.select(*keys, "n_words", F.array_distinct("nines").alias("kept"))


def _places(kept: DataFrame, *keys: str) -> DataFrame:
    """One row for each kept hash."""
    rows = kept.select(*keys, F.explode_outer("kept").alias("v"))
    return rows.select(*keys, F.shiftright("v", 31).alias("hash"), F.col("v").bitwiseAND(_PLACE).cast("int").alias("at"))


def _digest(words: str, at: Column, length: Column) -> Column:
    return F.md5(F.array_join(F.slice(words, at + 1, length), " "))


def item_spans(items: DataFrame) -> DataFrame:
    """digest, length and item of every span of the items."""
    rows = items.select("item", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(SPAN))
    last = F.size("words") - length
    spans = F.transform(F.sequence(F.lit(0), last), lambda at: _digest("words", at, length))
    return rows.select("item", length.alias("length"), F.explode_outer(spans).alias("digest")).distinct()


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit (words inside a shared span) and `items` (ids as text, sorted) of every row."""
    return matched(docs, items, id_col, text_col, item_col, item_text_col).drop("text_hash")


def matched(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """What `contaminated` gives, with `text_hash`, which tells rows of one id apart."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    key = ["doc_id", "text_hash"]
    items = items.where(F.col(item_col).isNotNull())
    items = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    spans = saved(item_spans(items), "item_spans")
    item_words = hashed(items, "item")
    marks = saved(_places(winnowed(item_words, "item"), "item").select("hash").distinct(), "item_marks")
    lengths = sorted(r.length for r in spans.where(F.col("length") < SPAN).select("length").distinct().collect())

    kept = saved(winnowed(hashed(docs, *key), *key), "winnowed")
    met = _places(kept, *key).join(marks, "hash")
    around = F.sequence(F.greatest(F.col("at") - (WINDOW - 1), F.lit(0)), F.col("at"))
    starts = met.select(*key, F.explode_outer(around).alias("at"), F.lit(SPAN).alias("length"))
    for length in lengths:
        runs = lambda df, *keys: df.select(*keys, F.posexplode_outer(_runs("hashes", length)).alias("at", "hash"))  # noqa: B023, E731
        short = runs(item_words.where(F.col("n_words") == length), "item").select("hash").distinct()
        short = saved(short, "short_marks")
        hits = runs(hashed(docs, *key), *key).join(short, "hash")
        starts = starts.unionAll(hits.select(*key, "at", F.lit(length).alias("length")))
    likely = saved(starts.groupBy(*key).agg(F.collect_set(F.struct("at", "length")).alias("starts")), "likely")

    some = near(docs, likely.select(*key))
    same = some["doc_id"].eqNullSafe(likely["doc_id"]) & (some["text_hash"] == likely["text_hash"])
    texts = some.join(likely, same).select(some["doc_id"], some["text_hash"], words(F.col("text")).alias("words"), "starts")
    inside = F.filter("starts", lambda s: s["at"] + s["length"] <= F.size("words"))
    spelt = F.transform(
        inside, lambda s: F.struct(s["at"].alias("at"), _digest("words", s["at"], s["length"]).alias("digest"))
    )
    found = texts.select(*key, F.explode_outer(spelt).alias("s")).select(*key, "s.at", "s.digest").join(spans, "digest")
    cover = F.aggregate(
        F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("length")).alias("end")))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["at"], a["reach"]))).alias("n"),
            F.greatest(a["reach"], s["end"]).alias("reach"),
        ),
        lambda a: a["n"],
    )
    per_doc = found.groupBy(*key).agg(cover.alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items"))
    same = kept["doc_id"].eqNullSafe(per_doc["doc_id"]) & (kept["text_hash"] == per_doc["text_hash"])
    return kept.join(per_doc, same, "left").select(
        kept["doc_id"],
        kept["text_hash"],
        kept["n_words"].cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """A twentieth of the words, or more, lies inside shared spans."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)
