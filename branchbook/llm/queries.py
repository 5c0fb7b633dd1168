"""Registered queries of the corpus operators, one per operator, with their contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchbook.llm import decontam, hardneg, langid, mcdrules, minhash, packing, periodic, puquality, recompress, simhash, sufdedup, toxicity, warc

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sufdedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return puquality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_mcd_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcdrules.judged(table(spark, sf_dir, "documents"))


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), rank_file(), added=rank_file("byte_bpe_50k.json"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(hardneg.quantised(rows.withColumn("label", moved), "vec_id", "label", "embedding"), F.col("id") % 100 == 0)


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True).drop("collapsed", "runs")


ORACLE["op4_warc"] = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, octet_length(encode(h))::bigint as payload_bytes, sha256(h) as payload_digest from p),
r as (select *, min(page_id) over (partition by payload_digest) as least from q)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id > least then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id > least then least end as refers_to
from r
"""
ORACLE["op1_decontamination"] = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, least(10, len(w)) as k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as g
       from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
dw as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as g
       from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from bw) where len(w) >= k)),
hit as (select doc_id, item_id, i, dw.k from dw join bw on dw.g = bw.g and dw.k = bw.k),
words as (select doc_id, count(distinct p)::bigint as n_hit from (select distinct doc_id, unnest(range(i, i + k)) as p from hit) group by doc_id),
items as (select doc_id, count(*)::bigint as n_items, string_agg(s, ',' order by s) as l from (select distinct doc_id, item_id::varchar as s from hit) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(l, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""
ORACLE["op6_recompression"] = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13)),
f as (select g, min(doc_id) as least from g group by g),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as p from g join f using (g) where doc_id > least),
w as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
k as (select w.doc_id, count(*)::bigint as n_words, count(gone.p)::bigint as n_removed,
             coalesce(string_agg(word, ' ' order by w.p) filter (where gone.p is null), '') as kept
      from w left join gone on gone.doc_id = w.doc_id and gone.p = w.p group by w.doc_id)
select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (doc_id)
"""
ORACLE["op12_hard_negatives"] = """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as v
           from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, list_inner_product(a.v, b.v)::bigint as score
      from (select distinct * from r where vec_id % 100 = 0) a, r b),
p as (select anchor_id, vec_id as positive_id, score as positive_score
      from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as k from s where same and vec_id <> anchor_id)
      where k <= 5),
n as (select p.*, s.vec_id as negative_id, s.score as negative_score,
             row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank
      from p join s on s.anchor_id = p.anchor_id and not same and 100 * s.score between 80 * positive_score and 100 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""
