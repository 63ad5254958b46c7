"""Randomised properties (hypothesis): exact percentiles, contiguous split,
buckets and one-hot rows on generated inputs."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from settings import SF_SMALL
from gearbox.operators.features import bucket, fit_encoders, vec_cols
from gearbox.operators.layout import contiguous_split
from gearbox.operators.stats import exact_percentiles
from gearbox.schema import MLP_CATEGORICALS, NUMERIC_FEATURES
from gearbox.sources.fixtures import listings_table

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=40), min_size=1, max_size=300),
       st.sampled_from([1, 2, 5]), st.integers(min_value=1, max_value=99))
def test_exact_percentile_equals_brute_force(spark, values, parts, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(parts)
    got = exact_percentiles(df, "x", (p,)).first()[f"p{p}"]
    s = sorted(values)
    assert got == next(v for rn, v in enumerate(s, 1) if rn * 100 >= p * len(s))


@SETTINGS
@given(st.integers(min_value=1, max_value=400), st.integers(min_value=1, max_value=9))
def test_contiguous_split_is_array_split(spark, n_rows, n_parts):
    df = spark.range(0, n_rows).select((F.col("id") * 7919 % 100003).alias("k"))
    sizes = {r["part"]: r["count"] for r in contiguous_split(df, ["k"], n_parts).groupBy("part").count().collect()}
    expect = [len(a) for a in np.array_split(np.arange(n_rows), n_parts)]
    assert [sizes.get(i + 1, 0) for i in range(n_parts)] == expect


@SETTINGS
@given(st.lists(st.floats(min_value=0, max_value=1000, allow_nan=False), min_size=1, max_size=50),
       st.lists(st.floats(min_value=0.5, max_value=999, allow_nan=False), min_size=1, max_size=4, unique=True))
def test_bucket_matches_numpy_digitize(spark, values, inner):
    splits = [0.0] + sorted(inner) + [float("inf")]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r["b"] for r in df.select("x", bucket("x", splits).alias("b")).collect()]
    want = [float(np.searchsorted(splits, v, side="right") - 1) for v in values]
    assert got == want


def test_one_hot_blocks_sum_to_zero_or_one(spark):
    df = listings_table(spark, SF_SMALL)
    enc = fit_encoders(df, MLP_CATEGORICALS, NUMERIC_FEATURES).transform(df)
    sums = [F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, x: a + x).alias(c) for c in vec_cols(MLP_CATEGORICALS)]
    bad = enc.select(*sums).where(" or ".join(f"`{c}` not in (0.0, 1.0)" for c in vec_cols(MLP_CATEGORICALS)))
    assert bad.count() == 0


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=60), min_size=120, max_size=600),
       st.sampled_from([1, 3]), st.sampled_from([(33, 67), (1, 50, 99), (100,)]))
def test_bracketed_exact_percentiles_equal_brute_force(spark, values, parts, percents):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(parts)
    got = exact_percentiles(df, "x", percents, accuracy=20).first()
    s = sorted(values)
    for p in percents:
        assert got[f"p{p}"] == next(v for rn, v in enumerate(s, 1) if rn * 100 >= p * len(s))
