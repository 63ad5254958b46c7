"""Property and edge-case tests for the operators (planted nulls, ties, small n,
write->read round trips, plan shape)."""

import os

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Bucketizer, StringIndexer
from pyspark.sql import Window
from pyspark.sql import functions as F

from settings import SF_SMALL
from gearbox.functions.columns import resolve_column
from gearbox.operators.clean import cast_target, drop_any_null, missing_rows, present_rows, quarantine_split
from gearbox.operators.features import bucket, category_index, fit_encoders, one_hot_entries, vector_width
from gearbox.operators.layout import (
    contiguous_split,
    keyed_split,
    kfold,
    partition_sizes,
    random_split,
    rebalance,
    union_parts,
)
from gearbox.operators.metrics import classification_metrics, regression_metrics
from gearbox.operators.ordering import target_partitions, with_global_index
from gearbox.operators.stats import exact_percentiles, row_counts
from gearbox.plans.jobs import clean_part_job, quarantine_job
from gearbox.schema import GBT_CATEGORICALS, KEY, MLP_CATEGORICALS, NUMERIC_FEATURES
from gearbox.sinks.writers import write_csv, write_if_nonempty, write_parquet
from gearbox.sources.fixtures import listings, listings_raw, table
from gearbox.sources.readers import read_csv, read_existing_parquet, read_first_available, read_parquet


@pytest.fixture(scope="module")
def raw(spark):
    return listings_raw(spark, SF_SMALL).persist()


@pytest.fixture(scope="module")
def lst(spark):
    return listings(spark, SF_SMALL).persist()


# --------------------------------------------------------------------------- ordering
@pytest.mark.parametrize("parts", [1, 3, 7])
def test_global_index_matches_row_number(spark, parts):
    orders = table(spark, SF_SMALL, "orders", "o_orderkey")
    idx, counts = with_global_index(orders, ["o_orderkey"], "i", num_partitions=parts)
    expect = orders.select("o_orderkey", (F.row_number().over(Window.orderBy("o_orderkey")) - 1).alias("i"))
    assert sorted(idx.collect()) == sorted(expect.collect())
    assert counts.agg(F.sum("_gx_n")).first()[0] == orders.count()


@pytest.mark.parametrize("values", [[5.0], [3.0, 1.0, 2.0], [1.0] * 10 + [2.0] * 5 + [3.0] * 2,
                                    list(np.random.default_rng(1).integers(0, 50, 997).astype(float))])
def test_exact_percentiles_brute_force(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = exact_percentiles(df, "x", (33, 67)).first()
    s = sorted(values)
    n = len(s)

    def brute(p):
        return next(v for rn, v in enumerate(s, 1) if rn * 100 >= p * n)
    assert (got["p33"], got["p67"]) == (brute(33), brute(67))


def test_exact_percentiles_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    got = exact_percentiles(df, "x").first()
    assert got["p33"] is None and got["p67"] is None


# --------------------------------------------------------------------------- layout
@pytest.mark.parametrize("n", [1, 3, 7])
def test_contiguous_split_sizes_like_array_split(spark, n):
    orders = table(spark, SF_SMALL, "orders", "o_orderkey")
    parts = contiguous_split(orders, ["o_orderkey"], n)
    sizes = [r["count"] for r in parts.groupBy("part").count().orderBy("part").collect()]
    keys = [r[0] for r in orders.orderBy("o_orderkey").collect()]
    expect = [len(a) for a in np.array_split(np.array(keys), n)]
    assert sizes == expect
    # contiguous: max key of part i < min key of part i+1
    b = parts.groupBy("part").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")) \
        .orderBy("part").collect()
    assert all(b[i]["hi"] < b[i + 1]["lo"] for i in range(len(b) - 1))


def test_keyed_split_disjoint_covering_and_layout_independent(spark, lst):
    a = keyed_split(lst, KEY).select(KEY, "split", "price")
    b = keyed_split(lst.repartition(7), KEY).select(KEY, "split", "price")
    assert sorted(a.collect()) == sorted(b.collect())
    counts = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == lst.count()
    assert 0.75 < counts["train"] / lst.count() < 0.85


def test_kfold_three_folds(spark, lst):
    folds = kfold(lst, KEY, 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2]
    assert sum(r["count"] for r in folds) == lst.count()


def test_random_split_disjoint_and_covering(spark, lst):
    s = random_split(lst.select(KEY, "slot", "price"))
    assert s.count() == lst.count()
    assert s.select(KEY, "slot", "price").exceptAll(lst.select(KEY, "slot", "price")).count() == 0
    frac = s.where(F.col("split") == "train").count() / lst.count()
    assert 0.75 < frac < 0.85


def test_rebalance_keeps_content_and_balances(spark, lst):
    r = rebalance(lst, 4, key=KEY)
    assert r.exceptAll(lst).count() == 0 and lst.exceptAll(r).count() == 0
    sizes = [x["rows"] for x in partition_sizes(r).collect()]
    assert len(sizes) == 4 and max(sizes) < 1.3 * min(sizes)


def test_union_parts_by_name_with_missing_column(spark, raw):
    a = raw.where(F.col("slot") >= 10).drop("seller_type")
    b = raw.where(F.col("slot") < 10).select(*reversed(raw.columns))
    u = union_parts([a, b])
    assert u.count() == a.count() + b.count()
    assert u.where(F.col("slot") >= 10).where(F.col("seller_type").isNotNull()).count() == 0


# --------------------------------------------------------------------------- cleaning
def test_planted_defects_are_found(spark, raw):
    missing = missing_rows(raw)
    assert sorted(r["slot"] for r in missing.select("slot").distinct().collect()) == [0, 1, 2]
    clean, quarantined = quarantine_split(raw)
    assert clean.count() + quarantined.count() == raw.count()
    assert clean.where(F.col("slot").isin(0, 1, 2)).count() == 0


def test_cast_target_bad_text_is_null(spark, raw):
    c = cast_target(raw)
    assert dict(c.dtypes)["price"] == "double"
    assert c.where(F.col("slot") == 3).where(F.col("price").isNotNull()).count() == 0
    assert c.where(F.col("slot") > 6).where(F.col("price").isNull()).count() == 0


def test_drop_any_null_drops_nan_too(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert drop_any_null(df).collect() == df.dropna().collect()


def test_dropna_conjunction_pushes_down(spark, tmp_dir):
    path = write_parquet(listings_raw(spark, SF_SMALL), os.path.join(tmp_dir, "raw"))
    plan = drop_any_null(read_parquet(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(price)" in plan and "IsNotNull(mileage)" in plan


def test_projection_prunes_scan(spark):
    plan = table(spark, SF_SMALL, "lineitem").select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_resolve_column_case_insensitive_and_keyerror(spark, raw):
    up = raw.withColumnRenamed("price", "PRICE")
    assert resolve_column(up, "price") == "PRICE"
    with pytest.raises(KeyError):
        resolve_column(raw.drop("price"), "price")


# --------------------------------------------------------------------------- sources / sinks
def test_missing_inputs_raise(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_parquet(spark, os.path.join(tmp_dir, "nope"))
    with pytest.raises(FileNotFoundError):
        read_existing_parquet(spark, [os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")])
    with pytest.raises(FileNotFoundError):
        read_first_available(spark, os.path.join(tmp_dir, "p"), os.path.join(tmp_dir, "c"))


def test_first_available_prefers_parquet(spark, tmp_dir):
    orders = table(spark, SF_SMALL, "orders")
    p = write_parquet(orders.limit(10), os.path.join(tmp_dir, "o.parquet"))
    c = write_csv(orders, os.path.join(tmp_dir, "o.csv"))
    assert read_first_available(spark, p, c).count() == 10
    assert read_first_available(spark, p + "x", c, csv_schema=orders.schema).count() == orders.count()


def test_csv_roundtrip_keeps_blanks_and_nulls(spark, raw, tmp_dir):
    path = write_csv(raw, os.path.join(tmp_dir, "raw_csv"))
    back = read_csv(spark, path, schema=raw.schema)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_csv_inferred_types(spark, lst, tmp_dir):
    path = write_csv(lst, os.path.join(tmp_dir, "l_csv"))
    inferred = dict(read_csv(spark, path, infer_schema=True).dtypes)
    assert inferred["price"] == "double" and inferred["make"] == "string"
    assert set(dict(read_csv(spark, path).dtypes).values()) == {"string"}


def test_write_if_nonempty(spark, tmp_dir):
    orders = table(spark, SF_SMALL, "orders")
    assert not write_if_nonempty(orders.where("false"), os.path.join(tmp_dir, "empty"))
    assert not os.path.exists(os.path.join(tmp_dir, "empty"))
    assert write_if_nonempty(orders, os.path.join(tmp_dir, "full"))


def test_quarantine_job_and_clean_job(spark, raw, tmp_dir):
    src = write_parquet(raw, os.path.join(tmp_dir, "combined.parquet"))
    res = quarantine_job(spark, src, os.path.join(tmp_dir, "c.csv"), os.path.join(tmp_dir, "q.parquet"),
                         os.path.join(tmp_dir, "q.csv"))
    assert res.count == missing_rows(raw).count() == res.rows.count()
    assert read_csv(spark, res.csv).count() == res.count
    clean_src = write_parquet(present_rows(raw), os.path.join(tmp_dir, "clean.parquet"))
    none = quarantine_job(spark, clean_src, "x", os.path.join(tmp_dir, "q2"), os.path.join(tmp_dir, "q2.csv"))
    assert none.count == 0 and none.rows.schema == raw.schema and not os.path.exists(os.path.join(tmp_dir, "q2"))
    part = write_csv(raw, os.path.join(tmp_dir, "part1.csv"))
    cleaned = clean_part_job(spark, part, os.path.join(tmp_dir, "processed1"))
    assert dict(cleaned.dtypes)["price"] == "double"
    assert cleaned.count() == cast_target(raw).where(F.col("price").isNotNull()).count()


# --------------------------------------------------------------------------- features
def test_category_index_matches_string_indexer(spark, lst):
    model = StringIndexer(inputCols=MLP_CATEGORICALS, outputCols=[c + "_i" for c in MLP_CATEGORICALS],
                          stringOrderType="frequencyDesc").fit(lst)
    ours = category_index(lst, MLP_CATEGORICALS)
    for c, labels in zip(MLP_CATEGORICALS, model.labelsArray):
        got = [r["value"] for r in ours.where(F.col("feature") == c).orderBy("index").collect()]
        assert got == list(labels), c


def test_one_hot_rows_have_at_most_one_slot(spark, lst):
    enc = fit_encoders(lst, GBT_CATEGORICALS, NUMERIC_FEATURES)
    e = one_hot_entries(enc.transform(lst), KEY, GBT_CATEGORICALS)
    per = e.groupBy(KEY, "feature").count()
    assert per.where(F.col("count") > 1).count() == 0 or lst.groupBy(KEY).count().where("count > 1").count() > 0
    assert vector_width(enc.transform(lst)) == 6 + sum(
        lst.select(c).distinct().count() - 1 for c in GBT_CATEGORICALS)


def test_bucket_matches_bucketizer(spark):
    vals = [(0.0,), (5.0,), (9.999,), (10.0,), (15.0,), (20.0,), (1e9,)]
    df = spark.createDataFrame(vals, "x double")
    splits = [0.0, 10.0, 20.0, float("inf")]
    ours = df.select("x", bucket("x", splits).alias("b")).orderBy("x").collect()
    ref = Bucketizer(splits=splits, inputCol="x", outputCol="b").transform(df).orderBy("x").collect()
    assert [r["b"] for r in ours] == [r["b"] for r in ref]
    with pytest.raises(Exception):
        spark.createDataFrame([(-1.0,)], "x double").select(bucket("x", splits)).collect()
    nan = spark.createDataFrame([(float("nan"),)], "x double")
    assert nan.select(bucket("x", splits, "keep").alias("b")).first()["b"] == 3.0


# --------------------------------------------------------------------------- metrics
def test_regression_metrics_equal_evaluator(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(100, 20, 500)
    p = y + rng.normal(0, 5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    ours = regression_metrics(df).first()
    ev = RegressionEvaluator()
    assert ours["rmse"] == pytest.approx(ev.evaluate(df, {ev.metricName: "rmse"}), abs=1e-4)
    assert ours["mae"] == pytest.approx(ev.evaluate(df, {ev.metricName: "mae"}), abs=1e-4)
    assert ours["r2"] == pytest.approx(ev.evaluate(df, {ev.metricName: "r2"}), abs=1e-6)


def test_classification_metrics_equal_evaluator_with_unpredicted_class(spark):
    rows = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 4 + [(2.0, 1.0)] * 3 + [(2.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = classification_metrics(df).first()
    ev = MulticlassClassificationEvaluator()
    for ours_name, ml in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                          ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        assert ours[ours_name] == pytest.approx(ev.evaluate(df, {ev.metricName: ml}), abs=1e-6), ours_name


def test_row_counts_single_pass(spark, lst):
    r = row_counts(kfold(lst, KEY), {f"f{i}": F.col("fold") == i for i in range(3)}).first()
    assert r["f0"] + r["f1"] + r["f2"] == r["n_rows"] == lst.count()


def test_require_schema_and_schema_table(spark, raw):
    from pyspark.sql import types as T
    from gearbox.schema import LISTINGS_RAW
    from gearbox.sources.readers import require_schema, schema_table
    assert require_schema(raw, LISTINGS_RAW) is raw
    with pytest.raises(ValueError):
        require_schema(raw.withColumn("slot", F.col("slot").cast("int")), LISTINGS_RAW)
    with pytest.raises(ValueError):
        require_schema(raw.drop("make"), LISTINGS_RAW)
    rows = schema_table(raw).orderBy("position").collect()
    assert [r["column_name"] for r in rows] == raw.columns
    assert rows[0]["data_type"] == "string" and rows[1]["data_type"] == "bigint"
    assert isinstance(LISTINGS_RAW["price"].dataType, T.StringType)


def test_null_tokens_like_pandas(spark, raw, tmp_dir):
    from gearbox.schema import LISTINGS_RAW
    path = write_csv(raw, os.path.join(tmp_dir, "tok"))
    got = read_csv(spark, path, schema=LISTINGS_RAW, null_tokens=["n/a", "NA"])
    assert got.where(F.col("price").isNull()).count() == raw.where(F.col("slot").isin(0, 3)).count()
    assert got.where(F.col("price") == "").count() == raw.where(F.col("slot") == 1).count()
    single = read_csv(spark, path, schema=LISTINGS_RAW, null_value="n/a")
    assert single.where(F.col("price").isNull()).count() == raw.where(F.col("slot").isin(0, 3)).count()


def test_random_split_depends_on_layout_keyed_split_does_not(spark, lst):
    """Defect D2 of the original: same seed, different partitioning, different rows."""
    base = lst.select(KEY, "slot", "price")
    r1 = {tuple(r) for r in random_split(base.coalesce(1)).where("split = 'train'").collect()}
    r4 = {tuple(r) for r in random_split(base.repartition(4, KEY)).where("split = 'train'").collect()}
    k1 = {tuple(r) for r in keyed_split(base.coalesce(1), KEY).where("split = 'train'").collect()}
    k4 = {tuple(r) for r in keyed_split(base.repartition(4, KEY), KEY).where("split = 'train'").collect()}
    assert k1 == k4
    assert r1 != r4


def test_schema_profile_counts_non_null(spark, raw):
    from gearbox.sources.readers import schema_profile
    prof = {r["column_name"]: r["non_null"] for r in schema_profile(raw).collect()}
    assert prof["price"] == raw.where(F.col("price").isNotNull()).count()
    assert prof["listing_id"] == raw.count()


def test_global_index_spreads_a_hot_value(spark):
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") % 100).cast("double")).alias("x"))
    _, counts = with_global_index(df, ["x"], "i", num_partitions=6)
    sizes = [r["_gx_n"] for r in counts.collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * min(sizes)
    assert target_partitions(df) >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_percentile_approx_rank_error_bound(spark, lst):
    from gearbox.operators.stats import approx_percentiles
    acc = 1000
    got = approx_percentiles(lst, "price", (0.33, 0.67), accuracy=acc).first()
    prices = sorted(r[0] for r in lst.select("price").collect())
    n = len(prices)
    for p, v in ((0.33, got["p33"]), (0.67, got["p67"])):
        lo = sum(1 for x in prices if x < v) / n
        hi = sum(1 for x in prices if x <= v) / n
        assert lo - 1.0 / acc <= p <= hi + 1.0 / acc


def test_unseen_category_error_or_keep(spark, lst):
    train = lst.where(F.col("make") != "Brand#1")
    test = lst.where(F.col("make") == "Brand#1")
    assert test.count() > 0
    strict = fit_encoders(train, GBT_CATEGORICALS, NUMERIC_FEATURES)
    with pytest.raises(Exception):
        strict.transform(test).select("features").collect()
    keep = fit_encoders(train, GBT_CATEGORICALS, NUMERIC_FEATURES, handle_invalid="keep")
    assert keep.transform(test).select("features").count() == test.count()
    assert vector_width(keep.transform(test)) == vector_width(strict.transform(train)) + len(GBT_CATEGORICALS)


def test_sized_broadcast_only_under_the_limit(spark):
    from gearbox.operators.joins import sized_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no automatic broadcasts
    try:
        big = spark.range(0, 20000).withColumnRenamed("id", "k")
        small = spark.range(0, 100).withColumnRenamed("id", "k")
        plan = big.join(sized_broadcast(small), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        plan = big.join(sized_broadcast(small, max_bytes=100), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listings_table_rederived_when_sources_change(spark, tmp_dir):
    import shutil
    import time as _time

    import pyarrow.parquet as pq
    from gearbox.sources.fixtures import SOURCE_TABLES, listings_table
    src = os.path.join(tmp_dir, "sf")
    os.makedirs(src)
    for t in SOURCE_TABLES:
        shutil.copyfile(os.path.join(SF_SMALL, f"{t}.parquet"), os.path.join(src, f"{t}.parquet"))
    first = listings_table(spark, src)
    assert listings_table(spark, src).inputFiles() == first.inputFiles()  # reused
    before = {r["seller_type"] for r in first.select("seller_type").distinct().collect()}
    region = pq.read_table(os.path.join(src, "region.parquet")).to_pandas()
    region["r_name"] = region["r_name"] + "_X"
    _time.sleep(1.1)  # a visibly newer modification time
    pq.write_table(__import__("pyarrow").Table.from_pandas(region, preserve_index=False),
                   os.path.join(src, "region.parquet"))
    second = listings_table(spark, src)
    assert second.inputFiles() != first.inputFiles()
    after = {r["seller_type"] for r in second.select("seller_type").distinct().collect()}
    assert after == {b + "_X" for b in before}


def test_read_one_part_by_file_uri(spark, tmp_dir):
    from gearbox.sources.readers import read_part
    orders = table(spark, SF_SMALL, "orders")
    parts = contiguous_split(orders, ["o_orderkey"], 3)
    base = write_parquet(parts, os.path.join(tmp_dir, "parts"), partition_by=["part"])
    direct = read_parquet(spark, "file://" + os.path.join(base, "part=2"))
    pruned = read_part(spark, base, 2)
    assert direct.count() == pruned.count() == parts.where("part = 2").count()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part" in plan


def test_rebalance_without_key_and_bucket_skip(spark, lst):
    r = rebalance(lst, 3)
    assert r.count() == lst.count() and len(partition_sizes(r).collect()) == 3
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    got = [r["b"] for r in df.select(bucket("x", [0.0, 5.0, float("inf")], "skip").alias("b")).collect()]
    assert got == [None, 0.0, None]


def test_stored_entries_equal_vector_expansion(spark, lst):
    from pyspark.ml.functions import vector_to_array
    from gearbox.operators.features import assembled_entries
    train = lst.where(F.col("make") != "Brand#1")
    enc = fit_encoders(train, GBT_CATEGORICALS, NUMERIC_FEATURES, handle_invalid="keep").transform(lst)
    fast = assembled_entries(enc, KEY)
    slow = (enc.select(KEY, F.posexplode(vector_to_array("features")).alias("slot", "value"))
            .where("value <> 0").select(KEY, F.col("slot").cast("int").alias("slot"), "value"))
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    assert fast.count() == slow.count()


def test_constant_label_has_the_metrics_of_mllib(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from gearbox.operators.metrics import regression_metrics
    for rows in ([(1.0, 1.0), (1.0, 2.0)], [(1.0, 1.0), (1.0, 1.0)]):
        df = spark.createDataFrame(rows, "label double, prediction double")
        ours = regression_metrics(df).first()["r2"]
        theirs = RegressionEvaluator(metricName="r2").evaluate(df)
        assert ours == theirs or (np.isnan(ours) and np.isnan(theirs))


def test_cv_keeps_null_keys(spark):
    from gearbox.operators.metrics import cv_group_mean
    rows = [(i % 3, float(i % 7), None if i % 5 == 0 else str(i % 4)) for i in range(60)]
    df = spark.createDataFrame(rows, "fold int, price double, k string")
    got = {(r["alpha"], r["fold"]): (r["n"], r["rmse"]) for r in cv_group_mean(df, ["k"], [0.0, 5.0]).collect()}
    for a in (0.0, 5.0):
        for f in range(3):
            train = [(p, k) for g, p, k in rows if g != f]
            m = np.mean([p for p, _ in train])
            err = []
            for g, p, k in rows:
                if g == f:
                    same = [q for q, j in train if j == k]
                    pred = (sum(same) + a * m) / (len(same) + a) if len(same) + a > 0 else m
                    err.append((p - pred) ** 2)
            assert got[a, f] == (len(err), pytest.approx(np.sqrt(np.mean(err)), abs=1e-4))


def test_fold_average_plan_has_no_join(spark):
    import __spark_entry__ as entry
    plan = entry.queries()["fold_average"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_fold_totals_hold_no_vocabulary_in_one_window(spark):
    from gearbox.operators.metrics import cv_group_mean
    df = spark.createDataFrame([(i % 3, float(i), str(i % 7)) for i in range(60)], "fold int, price double, k string")
    plan = cv_group_mean(df, ["k"], [1.0])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("key_value" in w for w in windows)


def test_clean_and_quarantine_lose_no_row(spark, raw):
    from gearbox.operators.clean import clean_and_quarantine
    clean, quarantine = clean_and_quarantine(raw)
    assert clean.count() + quarantine.count() == raw.count()
    reasons = {r["reason"]: r["count"] for r in quarantine.groupBy("reason").count().collect()}
    assert set(reasons) == {"null", "blank", "unparseable"} and min(reasons.values()) > 0
    assert clean.where("price is null").count() == 0


def test_percentiles_with_a_value_that_holds_a_third(spark):
    from gearbox.operators.stats import exact_percentiles, values_at_ranks
    values = [float(i) for i in range(4000)] + [1500.5] * 2000
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    s = sorted(values)
    got = exact_percentiles(df, "x", (1, 25, 33, 50, 67, 100), accuracy=100).first()
    for p in (1, 25, 33, 50, 67, 100):
        assert got[f"p{p}"] == next(v for rn, v in enumerate(s, 1) if rn * 100 >= p * len(s))
    assert values_at_ranks(df, "x", parts=7, accuracy=100) == [
        s[k] for k in np.cumsum([len(c) for c in np.array_split(np.arange(len(s)), 7)])[:-1]]


def test_percentiles_narrow_many_distinct_values(spark, monkeypatch):
    from gearbox.operators import stats
    monkeypatch.setattr(stats, "MAX_WINDOW_ROWS", 50)
    values = [((i * 7919) % 5003) / 3 for i in range(5003)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    s = sorted(values)
    got = stats.exact_percentiles(df, "x", (5, 50, 95), accuracy=20).first()
    assert [got[f"p{p}"] for p in (5, 50, 95)] == [next(v for rn, v in enumerate(s, 1) if rn * 100 >= p * len(s)) for p in (5, 50, 95)]


def test_contiguous_split_by_key(spark):
    from gearbox.operators.layout import contiguous_split_by_key
    for n_rows, n in ((0, 3), (2, 3), (10, 3), (101, 7)):
        df = spark.createDataFrame([(i * 3,) for i in range(n_rows)], "k long").repartition(3)
        got = [r["part"] for r in contiguous_split_by_key(df, "k", n).orderBy("k").collect()]
        assert got == [i + 1 for i, c in enumerate(np.array_split(np.arange(n_rows), n)) for _ in c]
    plan = contiguous_split_by_key(df, "k", 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def test_csv_fields_with_line_breaks(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c"), (3, "d\r\n e ")], "i long, t string")
    path = write_csv(df, os.path.join(tmp_dir, "breaks"))
    back = read_csv(spark, path, schema=df.schema, multi_line=True)
    assert sorted(r["i"] for r in back.collect()) == [1, 2, 3]
    assert {r["i"]: r["t"].replace("\r\n", "\n") for r in back.collect()} == {1: "a\nb", 2: "c", 3: "d\n e "}


def test_encoder_and_assembler_run_in_the_registered_queries(spark):
    import __spark_entry__ as entry
    for name in ("one_hot", "assemble"):
        plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "_vec" in plan or "features" in plan
        assert plan.count("UDF") > 2  # the encoder's functions besides the indexer's
