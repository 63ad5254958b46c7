"""Registered queries: price bands, layout and splits, statistics, features, metrics and CV in SQL form."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import Window
from pyspark.sql import functions as F

from gearbox.operators.clean import drop_any_null
from gearbox.operators.features import (
    assembled_entries,
    bucket,
    category_index,
    encoder_stages,
    feature_width,
    fit_encoders,
    one_hot_entries,
)
from gearbox.operators.layout import (
    contiguous_split_by_key,
    keyed_split,
    kfold,
    partition_sizes,
    random_split,
    rebalance,
    repartition_rows,
)
from gearbox.operators.metrics import (
    classification_metrics,
    cv_group_mean,
    fold_average,
    group_mean_model,
    predict_group_mean,
    regression_metrics,
)
from gearbox.operators.sketches import merged_percentiles, part_sketches
from gearbox.operators.sparse import CategoryIndex, sparse_vectors
from gearbox.operators.stats import (
    approx_percentiles,
    category_frequencies,
    exact_percentiles,
    row_counts,
)
from gearbox.operators.ordering import partitions_for_rows
from gearbox.plans.price_bands import band_thresholds, banded_listings, price_band_summary
from gearbox.plans.registry import NOT_NULL_LISTINGS, register, sql
from gearbox.schema import GBT_CATEGORICALS, KEY, MLP_CATEGORICALS, NUMERIC_FEATURES
from gearbox.session import scratch_path
from gearbox.sinks.writers import write_parquet
from gearbox.sources.fixtures import listings_table, table

LINEITEM_ROW_BYTES = 128  # a row in a shuffle

@register("price_band_summary", ("F2", "A2x", "E5", "A1"), sql("""
select cast(case when price >= p67 then 2 when price >= p33 then 1 else 0 end as double) as label,
       count(*) as n, round(avg(price), 4) as avg_price, min(price) as min_price, max(price) as max_price
from listings, terciles
where """ + NOT_NULL_LISTINGS + """
group by 1""", "listings", "terciles"))
def q_price_band_summary(spark, sf_dir):
    return price_band_summary(listings_table(spark, sf_dir))


# --------------------------------------------------------------------------- shared inputs
def keyed_listings_table(spark, sf_dir):
    """listings + keyed 80/20 ``split`` + 3-way ``fold`` (both from md5 of the key)."""
    return kfold(keyed_split(listings_table(spark, sf_dir), KEY), KEY, 3)


def baseline_scored(spark, sf_dir, key="engine_hp"):
    """Train mean price per ``key`` (overall train mean for unseen keys),
    scored on every row; ``label`` = price."""
    data = keyed_listings_table(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    model, overall = group_mean_model(train, key)
    return predict_group_mean(data, model, overall, key).withColumnRenamed("price", "label")


BASELINE_SQL = """
select k.listing_id, k.split, k.price as label, coalesce(m.km, g.gm) as prediction
from keyed k
left join (select engine_hp, avg(price) as km from keyed where split = 'train' group by engine_hp) m
  on m.engine_hp = k.engine_hp,
(select avg(price) as gm from keyed where split = 'train') g"""

REGRESSION_SQL = """count(*) as n,
  round(sqrt(sum((label - prediction) * (label - prediction)) / count(*)), 4) as rmse,
  round(sum(abs(label - prediction)) / count(*), 4) as mae,
  round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) as r2"""

CV_KEYS = ["engine_hp", "transmission", "make"]
CV_ALPHAS = [0.0, 10.0, 100.0]

CV_PER_FOLD_SQL = """
tr as (select fold, price, engine_hp, transmission, make from keyed where split = 'train'),
long as (select fold, price, 'engine_hp' as key_col, cast(engine_hp as varchar) as key_value from tr
         union all select fold, price, 'transmission', transmission from tr
         union all select fold, price, 'make', make from tr),
pfk as (select fold, key_col, key_value, sum(price) as s, count(*) as c from long group by all),
pk as (select key_col, key_value, sum(s) as ss, sum(c) as cc from pfk group by all),
fm as (select fold, ((select sum(price) from tr) - sum(price)) / ((select count(*) from tr) - count(*)) as m
       from tr group by fold),
comp as (select pfk.fold, pfk.key_col, pfk.key_value, ss - s as ks, cc - c as kc
         from pfk join pk on pfk.key_col = pk.key_col and pfk.key_value = pk.key_value),
scored as (select l.fold, l.key_col, l.price, comp.ks, comp.kc, fm.m from long l
           join comp on l.fold = comp.fold and l.key_col = comp.key_col and l.key_value = comp.key_value
           join fm on l.fold = fm.fold),
alphas as (select unnest([0.0, 10.0, 100.0])::double as alpha),
per_fold as (
  select key_col, alpha, fold, count(*) as n,
         round(sqrt(sum(power(price - case when kc + alpha > 0 then (ks + alpha * m) / (kc + alpha) else m end, 2))
                    / count(*)), 4) as rmse
  from scored, alphas group by all),
fold_avg as (select key_col, alpha, round(avg(rmse), 4) as avg_rmse, count(*) as folds
             from per_fold group by all)"""


def _cv_fold_average(spark, sf_dir):
    train = keyed_listings_table(spark, sf_dir).where(F.col("split") == "train")
    return fold_average(cv_group_mean(train, CV_KEYS, CV_ALPHAS), ["key_col", "alpha"])


def _index_sql(cols):
    freq = " union all ".join(
        f"select '{c}' as feature, {c} as value, count(*) as count from listings group by {c}" for c in cols)
    return f"""(select feature, value, count,
        cast(row_number() over (partition by feature order by count desc, value) - 1 as integer) as index
      from ({freq}))"""


# --------------------------------------------------------------------------- layout
@register("contiguous_split", ("W1",), sql("""
select o_orderkey, cast(ntile(3) over (order by o_orderkey) as integer) as part from orders"""))
def q_contiguous_split(spark, sf_dir):
    return contiguous_split_by_key(table(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey", 3)


@register("repartition_content", ("L1",), sql("select * from lineitem"))
def q_repartition_content(spark, sf_dir):
    return repartition_rows(table(spark, sf_dir, "lineitem"), 8)


@register("rebalance_content", ("L2", "X4"), sql("select * from lineitem"))
def q_rebalance_content(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    parts = max(4, partitions_for_rows(spark, li.count(), LINEITEM_ROW_BYTES))
    return rebalance(li, parts, key=F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))


@register("partition_counts", ("L4", "L2", "L1", "X4"), sql("""
select kind, count(*) as n_rows, 8::bigint as partitions, true as balanced
from lineitem, (select unnest(['keyed', 'random', 'round_robin']) as kind) group by kind"""))
def q_partition_counts(spark, sf_dir):
    """Physical partitions of a keyed and a random rebalance and a round-robin
    repartition: all rows, 8 partitions, the largest at most 1.5 times the mean."""
    li = table(spark, sf_dir, "lineitem")
    out = None
    for kind, df in (("keyed", rebalance(li, 8, key=F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))),
                     ("random", rebalance(li, 8)), ("round_robin", repartition_rows(li, 8))):
        part = (partition_sizes(df).agg(F.sum("rows").alias("n_rows"), F.lit(df.rdd.getNumPartitions()).cast("long").alias("partitions"),
                                        (F.max("rows") * 8 <= 1.5 * F.sum("rows")).alias("balanced"))
                .select(F.lit(kind).alias("kind"), "n_rows", "partitions", "balanced"))
        out = part if out is None else out.union(part)
    return out


@register("random_split", ("L5",), sql("""
select count(*) as n_rows, 0::bigint as unlabelled, true as in_bounds, true as both_used, count(distinct listing_id) as keys
from listings""", "listings"))
def q_random_split(spark, sf_dir):
    """Every row once with one label, the shares near 80 / 20 (five standard deviations)."""
    split = random_split(listings_table(spark, sf_dir).select(KEY, "price"), (0.8, 0.2), seed=42)
    n, train = F.count(F.lit(1)), F.count_if(F.col("split") == "train")
    return split.agg(n.alias("n_rows"), F.count_if(~F.col("split").isin("train", "test") | F.col("split").isNull()).alias("unlabelled"),
                     (F.abs(train - 0.8 * n) <= 5 * F.sqrt(0.16 * n)).alias("in_bounds"),
                     ((train > 0) & (train < n)).alias("both_used"), F.count_distinct(KEY).alias("keys"))


@register("keyed_split", ("L5x",), sql("select listing_id, split from keyed", "listings", "keyed"))
def q_keyed_split(spark, sf_dir):
    return keyed_split(listings_table(spark, sf_dir), KEY).select(KEY, "split")


@register("kfold_assign", ("L6",), sql("select listing_id, fold from keyed", "listings", "keyed"))
def q_kfold_assign(spark, sf_dir):
    return kfold(listings_table(spark, sf_dir), KEY, 3).select(KEY, "fold")


@register("first_rows", ("T1",), sql("select * from orders order by o_orderkey limit 5"))
def q_first_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(5)


# --------------------------------------------------------------------------- statistics
@register("row_counts", ("A1",), sql("""
select count(*) as n_rows,
       count(*) filter (where split = 'train') as n_train, count(*) filter (where split = 'test') as n_test,
       count(*) filter (where fold = 0) as n_fold0, count(*) filter (where fold = 1) as n_fold1,
       count(*) filter (where fold = 2) as n_fold2
from keyed""", "listings", "keyed"))
def q_row_counts(spark, sf_dir):
    s, f = F.col("split"), F.col("fold")
    return row_counts(keyed_listings_table(spark, sf_dir), {
        "n_train": s == "train", "n_test": s == "test",
        "n_fold0": f == 0, "n_fold1": f == 1, "n_fold2": f == 2})


@register("percentile_approx", ("A2",), sql(f"""
select count(*) as n, true as p33_in_bounds, true as p67_in_bounds from listings where {NOT_NULL_LISTINGS}""", "listings"))
def q_percentile_approx(spark, sf_dir):
    """Measured rank error of the approximate percentiles: the requested rank lies
    within n / accuracy (and the rounding to a whole rank) of the ranks that the returned value has."""
    data = drop_any_null(listings_table(spark, sf_dir)).select("price")
    q = approx_percentiles(data, "price", (0.33, 0.67)).first()
    n, error = F.count(F.lit(1)), F.count(F.lit(1)) / F.lit(10000.0) + F.lit(1)

    def ok(p, v):
        below, upto = F.count_if(F.col("price") < F.lit(v)), F.count_if(F.col("price") <= F.lit(v))
        return (below - error <= F.lit(p) * n) & (F.lit(p) * n <= upto + error)
    return data.agg(n.alias("n"), ok(0.33, q["p33"]).alias("p33_in_bounds"), ok(0.67, q["p67"]).alias("p67_in_bounds"))


@register("percentile_by_parts", ("A2", "S2"), sql(f"""
select fuel_type as part, count(*) as n, true as within from listings where price is not null group by fuel_type
union all select 'all', count(*), true from listings where price is not null""", "listings"))
def q_percentile_by_parts(spark, sf_dir):
    """Stored sketches of the parts: the medians of each part and of all parts merged lie within half
    a percent of their ranks."""
    data = listings_table(spark, sf_dir).select(F.col("fuel_type").alias("part"), "price").where(F.col("price").isNotNull())
    path = write_parquet(part_sketches(data, "price", "part"), scratch_path(spark, "sketches"))
    stored = spark.read.parquet(path)
    each = merged_percentiles(stored, (0.5,), ("v",), by=["part"])
    whole = merged_percentiles(stored, (0.5,), ("v",)).select(F.lit("all").alias("part"), "n", "v")
    rows = data.union(data.select(F.lit("all"), "price"))
    asked = F.broadcast(each.union(whole).withColumnsRenamed({"part": "of", "n": "counted"}))  # a row for each part
    n = F.count(F.lit(1))
    below, upto = F.count_if(F.col("price") < F.col("v")), F.count_if(F.col("price") <= F.col("v"))
    return (rows.join(asked, F.col("part").eqNullSafe(F.col("of"))).groupBy("part")
            .agg(n.alias("n"), ((F.max("counted") == n) & (below <= n * 0.505) & (upto >= n * 0.495)).alias("within")))


@register("tercile_thresholds", ("A2x",), sql("select p33, p67 from terciles", "listings", "terciles"))
def q_tercile_thresholds(spark, sf_dir):
    return exact_percentiles(drop_any_null(listings_table(spark, sf_dir)), "price", (33, 67))


@register("category_frequencies", ("A6",), sql(" union all ".join(
    f"select '{c}' as feature, {c} as value, count(*) as count from listings group by {c}"
    for c in MLP_CATEGORICALS), "listings"))
def q_category_frequencies(spark, sf_dir):
    return category_frequencies(listings_table(spark, sf_dir), MLP_CATEGORICALS)


# --------------------------------------------------------------------------- features
@register("category_index", ("E1",), sql(f"select * from {_index_sql(MLP_CATEGORICALS)}", "listings"))
def q_category_index(spark, sf_dir):
    return category_index(listings_table(spark, sf_dir), MLP_CATEGORICALS)


@register("one_hot", ("E1", "E2"), sql(f"""
select l.listing_id, i.feature, i.index as slot
from ({" union all ".join(f"select listing_id, '{c}' as feature, {c} as value from listings" for c in GBT_CATEGORICALS)}) l
join {_index_sql(GBT_CATEGORICALS)} i on i.feature = l.feature and i.value = l.value
join (select feature, count(*) as card from {_index_sql(GBT_CATEGORICALS)} group by feature) k on k.feature = i.feature
where i.index < k.card - 1""", "listings"))
def q_one_hot(spark, sf_dir):
    df = listings_table(spark, sf_dir)
    model = Pipeline(stages=encoder_stages(GBT_CATEGORICALS, NUMERIC_FEATURES)[:2]).fit(df)
    return one_hot_entries(model.transform(df), KEY, GBT_CATEGORICALS)


def _assemble_sql():
    nums = " union all ".join(
        f"select listing_id, {i} as slot, {c} as value from listings where {c} != 0"
        for i, c in enumerate(NUMERIC_FEATURES))
    cats = " union all ".join(f"select listing_id, '{c}' as feature, {c} as value from listings"
                              for c in GBT_CATEGORICALS)
    order = " ".join(f"when '{c}' then {i}" for i, c in enumerate(GBT_CATEGORICALS))
    return f"""
with idx as {_index_sql(GBT_CATEGORICALS)},
card as (select feature, count(*) as card, case feature {order} end as pos from idx group by feature),
offs as (select feature, card, {len(NUMERIC_FEATURES)} + coalesce(sum(card - 1) over (order by pos
           rows between unbounded preceding and 1 preceding), 0) as off from card)
select listing_id, cast(slot as integer) as slot, value from ({nums})
union all
select l.listing_id, cast(o.off + i.index as integer) as slot, 1.0 as value
from ({cats}) l join idx i on i.feature = l.feature and i.value = l.value
join offs o on o.feature = i.feature
where i.index < o.card - 1"""


@register("assemble", ("E1", "E2", "E3", "E6", "E7"), sql(_assemble_sql(), "listings"))
def q_assemble(spark, sf_dir):
    df = listings_table(spark, sf_dir)
    model = fit_encoders(df, GBT_CATEGORICALS, NUMERIC_FEATURES)
    return assembled_entries(model.transform(df), KEY)


@register("sparse_assemble", ("E1", "E2", "E3", "E6", "E7"), sql(_assemble_sql(), "listings"))
def q_sparse_assemble(spark, sf_dir):
    df = listings_table(spark, sf_dir)
    vectors = sparse_vectors(df, CategoryIndex(df, GBT_CATEGORICALS), NUMERIC_FEATURES, keep=[KEY])
    return assembled_entries(vectors, KEY)


@register("feature_width", ("E4",), sql(f"""
select cast({len(NUMERIC_FEATURES)} + sum(c - 1) as integer) as width
from ({" union all ".join(f"select count(distinct {c}) as c from listings" for c in MLP_CATEGORICALS)})""",
    "listings"))
def q_feature_width(spark, sf_dir):
    return feature_width(listings_table(spark, sf_dir), MLP_CATEGORICALS, len(NUMERIC_FEATURES))


@register("price_bands", ("E5", "A2x", "F2"), sql(f"""
select listing_id, price,
       cast(case when price >= p67 then 2 when price >= p33 then 1 else 0 end as double) as label
from listings, terciles where {NOT_NULL_LISTINGS}""", "listings", "terciles"))
def q_price_bands(spark, sf_dir):
    return banded_listings(listings_table(spark, sf_dir)).select(KEY, "price", "label")


# --------------------------------------------------------------------------- metrics (baseline model)
@register("regression_metrics", ("A4",), sql(f"""
select {REGRESSION_SQL} from ({BASELINE_SQL}) p where split = 'test'""", "listings", "keyed"))
def q_regression_metrics(spark, sf_dir):
    return regression_metrics(baseline_scored(spark, sf_dir).where(F.col("split") == "test"))


@register("train_test_metrics", ("M8", "A4"), sql(f"""
select split, {REGRESSION_SQL} from ({BASELINE_SQL}) p group by split""", "listings", "keyed"))
def q_train_test_metrics(spark, sf_dir):
    return regression_metrics(baseline_scored(spark, sf_dir), by=["split"])


@register("classification_metrics", ("A5", "E5"), sql(f"""
with tt as (
  select min(price) filter (where rn * 100 >= 33 * n) as lo, min(price) filter (where rn * 100 >= 67 * n) as hi
  from (select price, row_number() over (order by price) as rn, count(*) over () as n
        from keyed where split = 'train')),
b as (select case when p.label >= hi then 2.0 when p.label >= lo then 1.0 else 0.0 end as label,
             case when p.prediction >= hi then 2.0 when p.prediction >= lo then 1.0 else 0.0 end as prediction
      from ({BASELINE_SQL}) p, tt where p.split = 'test'),
conf as (select label, prediction, count(*) as c from b group by all),
per as (select a.label, a.actual, a.tp, coalesce(pr.pred, 0) as pred from
        (select label, sum(c) as actual, sum(case when label = prediction then c else 0 end) as tp
         from conf group by label) a
        left join (select prediction as label, sum(c) as pred from conf group by prediction) pr on pr.label = a.label),
m as (select actual, tp, case when pred > 0 then tp / pred else 0.0 end as pr, tp / actual as rc from per)
select cast(sum(actual) as bigint) as n,
       round(sum(tp) / sum(actual), 6) as accuracy,
       round(sum(actual * pr) / sum(actual), 6) as weighted_precision,
       round(sum(actual * rc) / sum(actual), 6) as weighted_recall,
       round(sum(actual * case when pr + rc > 0 then 2 * pr * rc / (pr + rc) else 0.0 end) / sum(actual), 6)
         as weighted_f1
from m""", "listings", "keyed"))
def q_classification_metrics(spark, sf_dir):
    scored = baseline_scored(spark, sf_dir)
    # the bounds need the training prices only, not the scored join
    low, high = band_thresholds(keyed_listings_table(spark, sf_dir).where(F.col("split") == "train"), "price")
    splits = [0.0, low, high, float("inf")]
    test = scored.where(F.col("split") == "test")
    banded = test.select(bucket("label", splits).alias("label"), bucket("prediction", splits).alias("prediction"))
    return classification_metrics(banded)


@register("fold_average", ("A7", "L6"), sql("with " + CV_PER_FOLD_SQL + " select * from fold_avg",
                                            "listings", "keyed"))
def q_fold_average(spark, sf_dir):
    return _cv_fold_average(spark, sf_dir)


@register("top_configs", ("T2", "A7"), sql("with " + CV_PER_FOLD_SQL + """
select cast(row_number() over (order by avg_rmse, key_col, alpha) as integer) as rank, key_col, alpha, avg_rmse
from fold_avg order by avg_rmse, key_col, alpha limit 5""", "listings", "keyed"))
def q_top_configs(spark, sf_dir):
    fa = _cv_fold_average(spark, sf_dir)
    return (fa.orderBy("avg_rmse", "key_col", "alpha").limit(5)
              .withColumn("rank", F.row_number().over(Window.orderBy("avg_rmse", "key_col", "alpha")))
              .select("rank", "key_col", "alpha", "avg_rmse"))


@register("best_model", ("T4", "M6"), sql("with " + CV_PER_FOLD_SQL + """
select arg_min(key_col, avg_rmse) as best_key_col, arg_min(alpha, avg_rmse) as best_alpha,
       min(avg_rmse) as best_avg_rmse from fold_avg""", "listings", "keyed"))
def q_best_model(spark, sf_dir):
    fa = _cv_fold_average(spark, sf_dir)
    best = F.min_by(F.struct("key_col", "alpha"), F.col("avg_rmse"))
    return fa.agg(best.alias("_b"), F.min("avg_rmse").alias("best_avg_rmse")).select(
        F.col("_b.key_col").alias("best_key_col"), F.col("_b.alpha").alias("best_alpha"), "best_avg_rmse")
