"""Registered queries of this package: one per operator over its whole table,
and the corpus pipeline.  ``ORACLE_SQL`` holds DuckDB SQL where SQL can
express the result; the others are tested against brute force in
``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from gearbox.llm import byte_bpe, conversations, embedding_dedup, hard_negatives, line_dedup, mixing, packing, pii, quality, simhash, spotsigs, token_counts, toxicity
from gearbox.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


@query("op3_simhash_near_duplicates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op5_source_mixing", f"""
with d as (
  select doc_id, source, md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), '')) as place,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (
  select *, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight,
    1.5::double * (select sum(source_size)::double from s) as total from s),
o as (
  select *, coalesce(sum(2 * source_size) over before, 0) as full_before,
    sum(weight) over () - coalesce(sum(weight) over before, 0) as weight_left
  from w
  window before as (order by 2 * source_size / weight::double, source nulls last rows between unbounded preceding and 1 preceding)),
c as (select *, (total - full_before) / weight_left * weight > 2 * source_size as capped from o),
l as (
  select (any_value(total) - coalesce(sum(2 * source_size) filter (capped), 0))
    / nullif(sum(weight) filter (not capped), 0) as level from c),
t as (
  select source, source_size, case when capped then 2.0 * source_size else level * weight end::double as target
  from c cross join l),
r as (
  select d.doc_id, d.size, t.source_size, t.target, floor(t.target)::bigint as quota,
    coalesce(sum(d.size) over (partition by d.source order by d.place, d.doc_id nulls last, d.size
                               rows between unbounded preceding and 1 preceding), 0) as before
  from d join t on d.source is not distinct from t.source)
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(case when source_size = 0 then 0 else (quota // source_size) * size
    + greatest(0, least(size, quota % source_size - before)) end as bigint) as taken
from r""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document belongs to its one source."""
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", F.col("source_size")[0].alias("source_size"),
                    F.col("target")[0].alias("target"), "taken"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id")))
    return toxicity.score(docs, model).withColumn("held_out", toxicity.held_out("doc_id"))


@query("op6_spotsigs")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited(table(spark, sf_dir, "documents"))


@query("op8_quality_resampling")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are drawn."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_personal_data")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.extract(table(spark, sf_dir, "documents")))


@query("op1_line_dedup", """
with l as (
  select doc_id, i as pos, line,
    trim(regexp_replace(line, '[ \\t\\x0b\\x0c\\r]+', ' ', 'g'), ' ') as x
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i from documents)),
d as (
  select x, min({'d': doc_id, 'p': pos}) as first, string_split(x, ' ') as w, len(string_split(x, ' ')) as n
  from l where x <> '' group by x),
g as (
  select x, first, gap, array_to_string(list_concat(w[1:gap - 1], w[gap + 1:]), ' ') as v
  from (select x, first, w, unnest(range(1, n + 1)) as gap from d where n >= 5)),
changed as (select x from (select x, first, min(first) over (partition by v, gap) as e from g) where e < first),
longer as (select g.x from g join d on d.x = g.v where d.first < g.first),
shorter as (select d.x from d join g on d.x = g.v where g.first < d.first),
near as (select x from changed union select x from longer union select x from shorter),
k as (
  select l.doc_id, l.pos, l.line,
    l.x = '' or (d.first = {'d': l.doc_id, 'p': l.pos} and near.x is null) as keep
  from l left join d on d.x = l.x left join near on near.x = l.x)
select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (keep), '') as text,
  count(*) as n_lines, count(*) filter (not keep) as n_removed
from k group by doc_id""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.clean(docs, counts=True)


@query("op2_embedding_near_duplicates", """
with v as (
  select vec_id, embedding::double[] as e from embeddings),
g as (
  select vec_id, e, len(e) as dim, sqrt(list_dot_product(e, e)) as norm from v
  where len(e) > 0 and len(list_filter(e, lambda c: c is null or not isfinite(c))) = 0),
u as (select vec_id, dim, list_transform(e, lambda c: c / norm) as e from g where norm > 0),
p as (
  select a.vec_id as a, b.vec_id as b from u a join u b
  on a.dim = b.dim and a.vec_id <> b.vec_id and list_dot_product(a.e, b.e) >= 0.95),
r as (
  with recursive t(a, c) as (
    select a, a from (select distinct a from p)
    union
    select p.b, t.c from t join p on p.a = t.a)
  select a, min(c) as c from t group by a)
select v.vec_id, (select count(*) from p where p.a = v.vec_id) as n_links,
  coalesce(r.c, v.vec_id) as component_id, coalesce(r.c, v.vec_id) = v.vec_id as kept
from v left join r on r.a = v.vec_id""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op13_byte_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"))))


@query("op12_hard_negatives", """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding::double[], lambda c: floor(256 * c)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (
  select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id as id, list_dot_product(a.v, r.v)::bigint as score
  from r a join r on a.vec_id <> r.vec_id and len(a.v) = len(r.v) where a.vec_id % 100 = 0),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.positive_id, (row_number() over w)::int as rank, s.id as negative_id, p.positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
  and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by s.score desc, s.id)
qualify row_number() over w <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", relabelled.alias("label")), anchor=F.col("id") % 100 == 0)


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_report(table(spark, sf_dir, "conversations"))
