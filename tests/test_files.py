"""Work done by the files' own order, footers and sizes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearbox.operators.layout import contiguous_split_by_file, rebalance_by_size, steady_file_blocks
from gearbox.plans.jobs import clean_quarantine_job
from gearbox.sinks.writers import write_csv, write_parquet
from gearbox.sources.readers import footer_profile, footer_session, read_csv


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def in_file_order(spark, path, fmt):
    """The ids of every file, one file after the other by path."""
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    one = {"parquet": spark.read.parquet, "csv": lambda f: read_csv(spark, f)}[fmt]
    return np.concatenate([[int(r["id"]) for r in one(os.path.join(path, f)).coalesce(1).collect()] for f in files])


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("parts", [1, 2, 5, 7])
def test_split_by_file_order(spark, tmp_dir, fmt, parts):
    path = os.path.join(tmp_dir, "rows")
    shuffled = spark.range(5003).withColumn("key", F.xxhash64("id")).orderBy("key").repartitionByRange(4, "key")
    {"parquet": write_parquet, "csv": write_csv}[fmt](shuffled.select("id", F.repeat(F.lit("x"), 40).alias("pad")), path)
    expect = np.array_split(in_file_order(spark, path, fmt), parts)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several blocks a file
    try:
        with steady_file_blocks(spark):
            got = contiguous_split_by_file(spark.read.parquet(path) if fmt == "parquet" else read_csv(spark, path), parts)
            assert "Exchange" not in plan_of(got)
            found = got.select("part", F.col("id").cast("long")).toPandas()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for p in range(parts):
        assert sorted(found.id[found.part == p + 1]) == sorted(expect[p].tolist())


def test_split_by_file_of_few_rows(spark, tmp_dir):
    path = write_parquet(spark.range(2).coalesce(1), os.path.join(tmp_dir, "two"))
    assert sorted(r["part"] for r in contiguous_split_by_file(spark.read.parquet(path), 5).collect()) == [1, 2]
    none = write_parquet(spark.range(0), os.path.join(tmp_dir, "none"))
    assert contiguous_split_by_file(spark.read.parquet(none), 3).count() == 0
    rows = spark.read.parquet(write_parquet(spark.range(100).coalesce(1), os.path.join(tmp_dir, "many")))
    with pytest.raises(ValueError, match="filtered"):
        contiguous_split_by_file(rows.where("id % 3 = 0"), 4)


def test_steady_file_blocks_leaves_the_setting(spark):
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    with steady_file_blocks(spark):
        assert spark.conf.get(name, None) is not None
    assert spark.conf.get(name, None) == before


def test_clean_and_quarantine_in_one_pass(spark, tmp_dir):
    rows = spark.createDataFrame([("a", "1.5"), ("b", None), ("c", " "), ("d", "dear"), ("e", "2"), ("f", "NaN")], "k string, price string")
    part = write_csv(rows, os.path.join(tmp_dir, "part.csv"))
    res = clean_quarantine_job(spark, part, os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "quarantine"))
    assert res.counts == {"clean": 2, "null": 1, "blank": 1, "unparseable": 2}
    assert sorted(tuple(r) for r in res.clean.collect()) == [("a", 1.5), ("e", 2.0)]
    assert {(r["k"], r["price"], r["reason"]) for r in res.quarantine.collect()} == {
        ("b", None, "null"), ("c", " ", "blank"), ("d", "dear", "unparseable"), ("f", "NaN", "unparseable")}
    assert not os.path.exists(os.path.join(tmp_dir, "quarantine.writing"))


@pytest.mark.parametrize("price,counts", [("3", (2, 0)), ("", (0, 2))])
def test_one_side_without_rows(spark, tmp_dir, price, counts):
    part = write_csv(spark.createDataFrame([("a", price), ("b", price)], "k string, price string"), os.path.join(tmp_dir, "part.csv"))
    res = clean_quarantine_job(spark, part, os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "quarantine"))
    assert (res.clean.count(), res.quarantine.count()) == counts
    assert dict(res.clean.dtypes)["price"] == "double" and dict(res.quarantine.dtypes)["price"] == "string"


@pytest.mark.parametrize("nulls", [False, True])
def test_footer_profile(spark, tmp_dir, nulls):
    rows = spark.range(1000).select(
        "id", F.when(F.col("id") % 4 > 0, F.col("id") / 2).alias("half"), F.concat(F.lit("t"), "id").alias("a.text"), F.array("id").alias("many"))
    if nulls:  # a column whose footers have no range
        rows = rows.withColumn("none", F.lit(None).cast("int"))
    path = write_parquet(rows.repartition(3), os.path.join(tmp_dir, "rows"))
    found = {r["column_name"]: tuple(r)[1:] for r in footer_profile(spark, path).collect()}
    expect = {"id": (1000, 0.0, 999.0), "half": (750, 0.5, 499.5), "a.text": (1000, None, None)}
    assert found == (expect | {"none": (0, None, None)} if nulls else expect)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_footer_aggregates_are_pushed_down(spark, tmp_dir):
    path = write_parquet(spark.range(10), os.path.join(tmp_dir, "rows"))
    footers = footer_session(spark)
    plan = plan_of(footers.read.parquet(path).agg(F.count("id"), F.min("id"), F.max("id")))
    assert "PushedAggregation: [COUNT(id), MIN(id), MAX(id)]" in plan


def test_rebalance_splits_a_hot_key(spark, tmp_dir):
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("key"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(name)
    spark.conf.set(name, "1MB")
    try:
        path = write_parquet(rebalance_by_size(rows, "key"), os.path.join(tmp_dir, "rows"))
    finally:
        spark.conf.set(name, kept)
    sizes = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet")]
    assert spark.read.parquet(path).count() == 200_000
    assert len(sizes) > 5 and max(sizes) < 2.5 * sorted(sizes)[len(sizes) // 2]


def test_compressed_csv_reads_back(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "a,b", 0.1), (2, "", None), (3, None, -0.0), (4, " \"q\" ", 1e300)], "id long, text string, x double").repartition(2)
    path = write_csv(rows, os.path.join(tmp_dir, "rows"), compression="snappy")
    assert all(f.endswith(".csv.snappy") for f in os.listdir(path) if f.startswith("part-"))
    assert sorted(map(str, read_csv(spark, path, schema=rows.schema).collect())) == sorted(map(str, rows.collect()))
