"""Registered queries of the training-data operators, with production
parameters, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    forest_dup,
    hard_negatives,
    line_dedup,
    mixing,
    near_dup,
    packing,
    periodic,
    pii,
    quality,
    stream_dedup,
    topk,
    training_order,
    warc,
)
from tidewater.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return deco


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"), with_text=False).drop("redacted")


@query(
    """
with p as (select page_id, coalesce(html, '') as html from pages),
keyed as (select page_id, octet_length(encode(html)) as n, sha1(html) as digest from p),
top as (select digest, max(page_id) as top from keyed where n >= 1000 group by digest)
select page_id, n as payload_bytes, k.digest as payload_digest,
       case when n >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id <> top then top end as refers_to
from keyed k left join top t on k.digest = t.digest"""
)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_records(warc.read_chunks(files))


@query()
def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(table(spark, sf_dir, "documents")).drop("path")


@query(
    """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id,
  list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20"""
)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query(
    f"""
with docs as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
keyed as (select doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from docs),
frequent as (select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (key in (select key from frequent)) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (key not in (select key from frequent)), ''))
       as kept_sha256
from keyed group by doc_id"""
)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=2, similarity=80)


@query(
    f"""
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256({LOWERED}) as text_sha256
from documents window g as (partition by {LOWERED})"""
)
def op9_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.dedup_stream(table(spark, sf_dir, "documents")).drop("locator")


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query(
    """
with recursive v as (select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_inner_product(a.v, b.v) >= 0.9 * sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))),
reach(vec_id, other) as (select vec_id, vec_id from embeddings
  union select r.vec_id, l.b from reach r join links l on r.other = l.a),
least as (select vec_id, min(other) as component_id from reach group by vec_id),
counts as (select a, count(*) as n from links group by a)
select l.vec_id, coalesce(n, 0)::bigint as n_links, component_id, l.vec_id = component_id as kept
from least l left join counts c on c.a = l.vec_id"""
)
def op11_forest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_dup.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.with_planted_runs(table(spark, sf_dir, "documents")))
    longest = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr("*", f"{longest} as longest").selectExpr(
        "doc_id",
        "cast(size(runs) as long) as n_runs",
        "-longest.start as start",
        "longest.length as length",
        "-longest.period as period",
        "1000 * longest.length div -longest.period as exponent_milli",
        f"sha2({listed}, 256) as runs_sha256",
        "sha2(collapsed, 256) as collapsed_sha256",
    )


@query(
    """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
mined as (select p.*, vec_id as negative_id, score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank
  from positives p join scored s on p.anchor_id = s.anchor_id and not same
    and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from mined where rank <= 10"""
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label))
