"""Command-line jobs end to end on small inputs."""

import glob
import os

import numpy as np
import pandas as pd
import pytest

from settings import GBT_QUICK, GBT_QUICK_GRID, MLP_QUICK, SF_SMALL
from gearbox.plans import cli
from gearbox.plans.cli import parser, run
from gearbox.sinks.writers import write_csv, write_parquet
from gearbox.sources.fixtures import listings_raw, listings_table, table


def job(spark, *argv):
    return run(spark, parser().parse_args(list(argv)))


def test_split_keeps_file_order_and_sizes(spark, tmp_dir):
    src = os.path.join(tmp_dir, "orders_csv")
    write_csv(table(spark, SF_SMALL, "orders").orderBy("o_custkey", "o_orderkey").coalesce(1), src)
    out = job(spark, "split", src, os.path.join(tmp_dir, "parts"), "--parts", "3")
    original = pd.read_csv(glob.glob(os.path.join(src, "part-*.csv"))[0])
    expect = np.array_split(original["o_orderkey"].to_numpy(), 3)
    got = []
    for i in (1, 2, 3):
        files = sorted(glob.glob(os.path.join(tmp_dir, "parts", f"part_node{i}.csv", "part-*.csv")))
        frames = [f for f in (pd.read_csv(x) for x in files) if len(f)]
        keys = pd.concat(frames)["o_orderkey"].to_numpy() if frames else np.array([])
        got.append(sorted(keys.tolist()))
    assert [sorted(e.tolist()) for e in expect] == got
    assert sum(out["parts"].values()) == len(original)


def test_split_run_twice_replaces_its_parts(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "orders_csv"), os.path.join(tmp_dir, "parts")
    orders = table(spark, SF_SMALL, "orders")
    write_csv(orders, src)
    job(spark, "split", src, out)
    write_csv(orders.limit(90), src)
    second = job(spark, "split", src, out)
    assert sorted(second["parts"].values()) == [30, 30, 30]
    assert [spark.read.option("header", True).csv(f"{out}/part_node{i}.csv").count() for i in (1, 2, 3)] == [30, 30, 30]


def test_prepare_jobs(spark, tmp_dir):
    raw = listings_raw(spark, SF_SMALL)
    p1, p2 = os.path.join(tmp_dir, "p1.csv"), os.path.join(tmp_dir, "p2.csv")
    write_csv(raw.where("slot < 10"), p1)
    write_csv(raw.where("slot >= 10"), p2)
    merged = job(spark, "merge", p1, p2, "--output-csv", os.path.join(tmp_dir, "combined.csv"),
                 "--output-parquet", os.path.join(tmp_dir, "combined.parquet"))
    assert merged["rows"] == raw.count() and spark.read.parquet(merged["parquet"]).count() == raw.count()
    c1 = job(spark, "clean-part", p1, os.path.join(tmp_dir, "processed1.parquet"))
    c2 = job(spark, "clean-part", p2, os.path.join(tmp_dir, "processed2.parquet"))
    mp = job(spark, "merge-parts", os.path.join(tmp_dir, "processed1.parquet"),
             os.path.join(tmp_dir, "processed2.parquet"), os.path.join(tmp_dir, "processed3.parquet"),
             "--output", os.path.join(tmp_dir, "merged.parquet"))
    assert mp["rows"] == c1["rows"] + c2["rows"] and sum(mp["split_counts"].values()) == mp["rows"]
    rp = job(spark, "repartition", os.path.join(tmp_dir, "merged.parquet"), os.path.join(tmp_dir, "rep.parquet"),
             "--partitions", "2")
    assert rp["rows"] == mp["rows"]
    cp = job(spark, "csv-to-parquet", p1, os.path.join(tmp_dir, "p1.parquet"))
    assert cp["rows"] == raw.where("slot < 10").count()
    write_parquet(raw, os.path.join(tmp_dir, "raw.parquet"))
    fn = job(spark, "find-null", "--input-parquet", os.path.join(tmp_dir, "raw.parquet"),
             "--input-csv", p1, "--out-parquet", os.path.join(tmp_dir, "null.parquet"),
             "--out-csv", os.path.join(tmp_dir, "null.csv"))
    ins = job(spark, "inspect", os.path.join(tmp_dir, "raw.parquet"))
    assert fn["missing"] == ins["missing_target"] > 0
    assert [c["column_name"] for c in ins["schema"]] == raw.columns


@pytest.mark.parametrize("argv", [["gbt", "--preset", "quick"], ["mlp", "--preset", "quick"],
                                  ["mlp", "--preset", "quick", "--part", "2"]])
def test_model_jobs(spark, tmp_dir, argv, monkeypatch):
    monkeypatch.setitem(cli.GBT_PRESETS, "quick", GBT_QUICK)
    monkeypatch.setitem(cli.MLP_PRESETS, "quick", MLP_QUICK)
    src = os.path.join(tmp_dir, "listings")
    from pyspark.sql import functions as F
    lt = listings_table(spark, SF_SMALL).withColumn("part", (F.col("slot") % 3 + 1).cast("int"))
    write_parquet(lt, src)
    out = job(spark, argv[0], src, *argv[1:], "--report", os.path.join(tmp_dir, "report"))
    assert {m["split"] for m in out["metrics"]} == {"train", "test"}
    assert spark.read.parquet(os.path.join(tmp_dir, "report")).count() > 10


def test_stream_clean_job(spark, tmp_dir):
    from pyspark.sql import functions as F
    raw = listings_raw(spark, SF_SMALL)
    write_csv(raw, os.path.join(tmp_dir, "in", "a"))
    ddl = "listing_id string, slot bigint, price string, mileage double, seller_type string, make string, " \
          "transmission string"
    out = job(spark, "stream-clean", os.path.join(tmp_dir, "in", "*"), "--clean-dir", os.path.join(tmp_dir, "c"),
              "--quarantine-dir", os.path.join(tmp_dir, "q"), "--checkpoint", os.path.join(tmp_dir, "ck"),
              "--schema", ddl)
    assert out["batch"] is not None
    clean = spark.read.parquet(os.path.join(tmp_dir, "c"))
    assert clean.count() == raw.where(F.col("price").try_cast("double").isNotNull()).count()


def test_gbt_cv_job_quick_grid(spark, tmp_dir, monkeypatch):
    monkeypatch.setitem(cli.GBT_GRIDS, "quick", GBT_QUICK_GRID)
    src = os.path.join(tmp_dir, "listings")
    write_parquet(listings_table(spark, SF_SMALL), src)
    out = job(spark, "gbt-cv", src, "--grid", "quick", "--output", os.path.join(tmp_dir, "cv"),
              "--report", os.path.join(tmp_dir, "cv_report"))
    assert {m["split"] for m in out["metrics"]} == {"train", "test"}
    assert {r["section"] for r in spark.read.parquet(os.path.join(tmp_dir, "cv_report")).collect()} >= {"grid", "ranking", "best"}
    configs = out["configs"]
    assert len(configs) == 8 and sum(c["best"] for c in configs) == 1
    best = [c for c in configs if c["best"]][0]
    assert best["avg_rmse"] == min(c["avg_rmse"] for c in configs)
    assert spark.read.parquet(os.path.join(tmp_dir, "cv")).count() == 8
