"""What is worked out part by part and merged: percentile sketches and column types."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearbox.operators.sketches import merged_percentiles, part_sketches
from gearbox.sources.infer import column_types, merged_types, typed


def test_percentiles_of_merged_parts(spark, tmp_path):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=20_000), np.full(10_000, 0.25), rng.exponential(size=5_000)])
    rows = spark.createDataFrame([(int(i % 4), float(v)) for i, v in enumerate(values)], "part int, v double")
    path = f"{tmp_path}/sketches"
    part_sketches(rows.where("part < 3"), "v", "part").write.parquet(path)
    part_sketches(rows.where("part = 3"), "v", "part").write.mode("append").parquet(path)  # a part that comes later
    stored = spark.read.parquet(path)
    got = merged_percentiles(stored, (0.1, 0.5, 0.9)).first()
    assert got["n"] == len(values)
    for p in (10, 50, 90):
        v = got[f"p{p}"]
        assert (values < v).mean() - 0.005 <= p / 100 <= (values <= v).mean() + 0.005
    one = merged_percentiles(stored.where("part in (0, 2)"), (0.5,)).first()
    some = values[np.arange(len(values)) % 2 == 0]
    assert one["n"] == len(some) and abs((some <= one["p50"]).mean() - 0.5) < 0.4


def test_percentiles_of_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, float("nan"))], "part int, v double")
    assert [r["n"] for r in part_sketches(rows, "v", "part").collect()] == [0, 0]
    assert tuple(merged_percentiles(part_sketches(rows, "v", "part"), (0.5,)).first()) == (0, None)
    assert merged_percentiles(part_sketches(rows.limit(0), "v", "part"), (0.5,)).first()["n"] == 0


@pytest.mark.parametrize("values,want", [
    (["1", "-2", None], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5"], "double"), (["1e3", ".5"], "double"), (["true", "False"], "boolean"),
    (["1", "true"], "string"), (["2020-01-31"], "date"), (["2020-01-31", "2020-02-01 10:00:00"], "timestamp"), (["2020-02-30"], "string"),
    (["2020"], "int"), (["1d"], "string"), (["", "1"], "string"), ([None, None], "string"), ([" 7 "], "int"), (["9" * 30], "double")])
def test_narrowest_type(spark, values, want):
    text = spark.createDataFrame([(v,) for v in values], "c string")
    assert merged_types(column_types(text)).first()["type"] == want


def test_types_of_parts_are_joined(spark):
    text = spark.createDataFrame([("a", "1", "x"), ("a", "2", None), ("b", "2.5", None), ("b", None, None)], "part string, n string, s string")
    parts = column_types(text, by=["part"])
    types = {r["column"]: r["type"] for r in merged_types(parts).collect()}
    assert types == {"n": "double", "s": "string"}
    assert {r["column"]: r["type"] for r in merged_types(parts.where("part = 'a'")).collect()}["n"] == "int"
    table = typed(text.drop("part"), merged_types(parts))
    assert dict(table.dtypes) == {"n": "double", "s": "string"} and table.agg(F.sum("n")).first()[0] == 5.5
    assert merged_types(column_types(text.limit(0))).where("type <> 'string'").count() == 0
