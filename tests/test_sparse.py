"""Feature vectors without a vocabulary on the driver."""

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from settings import SF_SMALL
from gearbox.operators.features import assembled_entries, fit_encoders
from gearbox.operators.sparse import CategoryIndex, slot_ranges, sparse_vectors, with_indexes
from gearbox.schema import GBT_CATEGORICALS, KEY, NUMERIC_FEATURES
from gearbox.sources.fixtures import listings_table



@pytest.mark.parametrize("head_values, max_bytes", [(100_000, 1 << 26), (3, 1 << 26), (100, 200), (5, 0)])
def test_equal_to_the_assembled_vectors(spark, head_values, max_bytes):
    df = listings_table(spark, SF_SMALL)
    want = {r[KEY]: r["features"].toArray().tolist() for r in fit_encoders(df, GBT_CATEGORICALS, NUMERIC_FEATURES).transform(df).collect()}
    index = CategoryIndex(df, GBT_CATEGORICALS)
    got = sparse_vectors(df, index, NUMERIC_FEATURES, keep=[KEY], head_values=head_values, max_bytes=max_bytes)
    assert {r[KEY]: r["features"].toArray().tolist() for r in got.collect()} == want
    assert got.count() == df.count()


def test_unseen_and_null_categories(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", 2.0), (None, 3.0)], "c string, x double")
    test = spark.createDataFrame([(1, "a", 1.0), (2, "b", 0.0), (3, "z", 2.0), (4, None, 2.0)], "k int, c string, x double")
    index = CategoryIndex(train, ["c"])
    got = sparse_vectors(test, index, ["x"], keep=["k"], handle_invalid="keep")
    assert {r["k"]: r["features"].toArray().tolist() for r in got.collect()} == {
        1: [1, 1, 0], 2: [0, 0, 1], 3: [2, 0, 0], 4: [2, 0, 0]}
    assert slot_ranges(index, ["x"], "keep") == {"x": (0, 1), "c": (1, 2)}
    assert slot_ranges(index, ["x"]) == {"x": (0, 1), "c": (1, 1)}
    with pytest.raises(PySparkException, match="unseen category or null in c"):
        sparse_vectors(test, index, ["x"])
    with pytest.raises(PySparkException, match="x is null or NaN"):
        sparse_vectors(test.withColumn("x", F.lit(float("nan"))), index, ["x"], handle_invalid="keep")


def test_empty_and_single_category(spark):
    df = spark.createDataFrame([("only", 1.0), ("only", 2.0)], "c string, x double")
    assert [r[0].toArray().tolist() for r in sparse_vectors(df, CategoryIndex(df, ["c"]), ["x"]).orderBy("features").collect()] in ([[1], [2]], [[2], [1]])
    empty = df.limit(0)
    assert sparse_vectors(empty, CategoryIndex(empty, ["c"]), ["x"]).count() == 0


def test_a_model_is_fitted_on_the_vectors(spark):
    df = listings_table(spark, SF_SMALL)
    encoders = fit_encoders(df, GBT_CATEGORICALS, NUMERIC_FEATURES)
    vectors = sparse_vectors(df, CategoryIndex(df, GBT_CATEGORICALS), NUMERIC_FEATURES, keep=["price"])
    fit = LinearRegression(labelCol="price", regParam=0.1, solver="normal").fit
    ours, theirs = fit(vectors), fit(encoders.transform(df).select("features", "price"))
    assert ours.coefficients.toArray() == pytest.approx(theirs.coefficients.toArray(), rel=1e-4, abs=1e-2)


def test_over_a_million_categories_with_a_hot_one(spark):
    n, distinct = 1_800_000, 1_200_000
    value = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.lpad((F.col("id") * 7 % distinct).cast("string"), 7, "0")))
    df = spark.range(n).select("id", value.alias("c"))
    index = CategoryIndex(df, ["c"])
    assert index.sizes["c"] > 700_000
    rows = with_indexes(df, index, head_values=1000)
    found = rows.agg(F.count("c_idx"), F.countDistinct("c_idx"), F.max("c_idx"), F.sum((F.col("c_idx") == 0).cast("int"))).first()
    assert tuple(found) == (n, index.sizes["c"], index.sizes["c"] - 1, n // 3)
    order = df.groupBy("c").count().join(rows.select("c", "c_idx").distinct(), "c")
    worse = order.agg(F.min(F.when(F.col("count") > 1, F.col("c_idx"))), F.max("c_idx")).first()
    assert worse[0] == 0 and order.where(F.col("c") == "hot").first()["c_idx"] == 0


def test_a_million_slots(spark):
    distinct = 1_050_000
    df = spark.range(distinct).select("id", F.lpad(F.col("id").cast("string"), 8, "0").alias("c"), F.lit(2.0).alias("x"))
    index = CategoryIndex(df, ["c"])
    got = sparse_vectors(df, index, ["x"], keep=["id"])
    assert got.schema["features"].metadata == {}
    slots = assembled_entries(got, "id").where(F.col("slot") > 0)
    bad = slots.where(F.col("slot") != F.col("id") + 1).count()  # equal counts: by value
    assert bad == 0 and slots.count() == distinct - 1
    assert got.first()["features"].size == distinct


def test_no_indexer_on_the_path(spark, monkeypatch):
    monkeypatch.setattr(StringIndexer, "fit", lambda *a, **k: pytest.fail("fitted"))
    import __spark_entry__ as entry
    assert entry.queries()["sparse_assemble"](spark, SF_SMALL).count() > 0


def test_rows_of_the_head_are_spread(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = with_indexes(df, CategoryIndex(df, ["c"]), head_values=10)
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(sizes) < 1.5 * 40_000 / 8
