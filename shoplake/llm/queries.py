"""The operators' queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import (
    bitplanes, decontaminate, hardneg, merkle, mixing, neardup, packing, pii, secretscan, sharding, spans, topk, toxicity, urlfilter,
)
from shoplake.llm.common import fresh_path, saved, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
PACK_END_ID, PACK_SIZE = 1, 4096

# The URL rules (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    bitplanes.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return bitplanes.digests(spark, path)


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urlfilter.judged(table(spark, sf_dir, "pages"), rules)


OP2_SQL = """
with cut as (
    select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
    from pages),
rules(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
judged as (
    select c.*, (select r.h || r.p || ' ' || r.v from rules r
        where (c.host = r.h or ends_with(c.host, '.' || r.h)) and starts_with(c.path, r.p)
        order by length(r.h || r.p) desc limit 1) as best
    from cut c)
select page_id, host, path, split_part(best, ' ', 1) as rule, coalesce(split_part(best, ' ', 2), 'allow') as verdict
from judged
"""


def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(table(spark, sf_dir, "documents"), shards=8)
    none = F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", none)


def op4_winnowed_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


OP4_SQL = r"""
with item_words as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where text is not null and item_id is not null),
doc_words as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
item_spans as (
    select distinct item_id, n, array_to_string(w[a : a + n - 1], ' ') as span
    from (select *, unnest(range(1, len(w) - n + 2)) as a from (select *, least(13, len(w)) as n from item_words where len(w) > 0))),
doc_spans as (
    select r, a, n, array_to_string(w[a : a + n - 1], ' ') as span
    from (select *, unnest(range(1, greatest(len(w) - n + 2, 1))) as a
        from doc_words cross join (select distinct n from item_spans))),
met as (select r, a, n, item_id from doc_spans join item_spans using (span, n)),
hit as (select r, count(*) as n_hit from (select distinct r, unnest(range(a, a + n)) as place from met) group by r),
named as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct r, item_id::varchar as item from met) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join hit using (r) left join named using (r)
"""


def op5_grouped_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    pieces = packing.pieces(table(spark, sf_dir, "documents"), path, PACK_END_ID, PACK_SIZE)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.placed(saved(digests, "pieces"), PACK_SIZE)


def op6_clause_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.scored(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))
    held_out = toxicity.held_out(F.col("doc_id")).alias("held_out")
    return rows.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spans.digests(pii.found(docs, pii.trained(docs)), pii.KINDS)


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
with recursive spelt as (
    select row_number() over () as r, doc_id, [x for x in regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+') if x <> ''] as w
    from documents),
shingles as (
    select distinct r, array_to_string(w[a : a + 4], ' ') as s
    from (select *, unnest(range(1, greatest(len(w) - 3, 2))) as a from spelt where len(w) > 0)),
sizes as (select r, count(*) as n from shingles group by r),
pairs as (
    select x.r as a, y.r as b, count(*) as common
    from shingles x join shingles y on x.s = y.s and x.r <> y.r group by 1, 2),
links as (
    select a, b from pairs join sizes p on p.r = a join sizes q on q.r = b
    where 100 * common >= 75 * (p.n + q.n - common)),
reach(a, b) as (select r, r from spelt union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a as r, min(doc_id) as component_id from reach join spelt on spelt.r = reach.b group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id,
    coalesce(doc_id = component_id, component_id is null) as kept
from spelt left join sizes using (r) left join least using (r)
"""


def op9_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scanned(table(spark, sf_dir, "documents"))
    return spans.digests(found, [r.kind for r in secretscan.BASE])


def op10_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


OP10_SQL = """
with whole as (
    select vec_id, [floor(64 * x::double)::bigint for x in embedding] as v
    from embeddings
    where embedding is not null
        and len([1 for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint as score
    from whole q join whole c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0)
select query_id, rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
where rank <= 20
"""


def op11_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mined(rows.withColumn("label", changed), F.col("vec_id") % 50 == 0)


OP11_SQL = """
with whole as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * x::double)::bigint for x in embedding] as v
    from embeddings
    where embedding is not null and label is not null and vec_id is not null
        and len([1 for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
scored as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
        list_dot_product(a.v::double[], c.v::double[])::bigint as score
    from whole a join whole c on a.vec_id <> c.vec_id
    where a.vec_id % 50 = 0),
positive as (
    select anchor_id, vec_id as positive_id, score as positive_score
    from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as r from scored where same)
    where r <= 5),
met as (
    select p.*, s.vec_id as negative_id, s.score as negative_score,
        row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
    from positive p join scored s on s.anchor_id = p.anchor_id and not s.same
        and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from met where rank <= 3
"""


def op12_multinomial_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mixed(table(spark, sf_dir, "documents")))


def op13_bitmap_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), wrong)


def queries() -> dict[str, Query]:
    return {
        "op1_bitplane_ids": op1_bitplane_ids,
        "op2_url_rules": op2_url_rules,
        "op3_feistel_shards": op3_feistel_shards,
        "op4_winnowed_benchmark": op4_winnowed_benchmark,
        "op5_grouped_packing": op5_grouped_packing,
        "op6_clause_toxicity": op6_clause_toxicity,
        "op7_boosted_pii": op7_boosted_pii,
        "op8_hyperminhash": op8_hyperminhash,
        "op9_trigram_secrets": op9_trigram_secrets,
        "op10_norm_bucket_topk": op10_norm_bucket_topk,
        "op11_hilbert_negatives": op11_hilbert_negatives,
        "op12_multinomial_mix": op12_multinomial_mix,
        "op13_bitmap_merkle": op13_bitmap_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_rules": OP2_SQL,
        "op4_winnowed_benchmark": OP4_SQL,
        "op8_hyperminhash": OP8_SQL,
        "op10_norm_bucket_topk": OP10_SQL,
        "op11_hilbert_negatives": OP11_SQL,
    }
