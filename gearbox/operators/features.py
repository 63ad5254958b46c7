"""Feature operators.

Two forms of each encoding:

* MLlib stages (``encoder_stages``) for training: ONE multi-column
  ``StringIndexer`` and ONE multi-column ``OneHotEncoder`` instead of a
  stage per column, so fitting costs one aggregation job, not one per column.
* SQL-form tables (``category_index``, ``one_hot_entries``,
  ``assembled_entries``) that expose the same numbers as plain rows, so
  they can be checked exactly against another engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearbox.operators.ordering import partitions_for_rows, with_global_index
from gearbox.session import shared_dir
from gearbox.operators.stats import category_frequencies


# --------------------------------------------------------------------------- E1
def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E1 in table form: ``(feature, value, count, index)``.

    Same order as ``StringIndexer(stringOrderType="frequencyDesc")``: most
    frequent value first, ties by value ascending, 0-based; nulls get no index.
    The frequency table gets one distributed global index over
    ``(feature, count desc, value)`` (no task holds a whole vocabulary);
    each feature's first index, one row per input column, is subtracted.
    """
    # the frequency table is small (sum of vocabularies): materialise it and
    # size the range partitioning from its real row count, not from the
    # plan estimate of the scan it came from
    shared_dir(df.sparkSession)
    freq = category_frequencies(df, columns).where(F.col("value").isNotNull()).checkpoint(eager=True)
    parts = partitions_for_rows(df.sparkSession, freq.count())
    indexed, _ = with_global_index(freq, [F.col("feature"), F.desc("count"), F.asc("value")], "_g",
                                   num_partitions=parts)
    starts = indexed.groupBy("feature").agg(F.min("_g").alias("_start"))  # len(columns) rows
    return (indexed.join(F.broadcast(starts), "feature")
            .select("feature", "value", "count", (F.col("_g") - F.col("_start")).cast("int").alias("index")))


def feature_width(df: DataFrame, categoricals: Sequence[str], n_numeric: int) -> DataFrame:
    """E4 without fitting: ``n_numeric + sum(cardinality - 1)`` (dropLast one-hots)."""
    freq = category_frequencies(df, categoricals).where(F.col("value").isNotNull())
    return freq.agg((F.lit(n_numeric) + F.count(F.lit(1)) - F.countDistinct("feature")).cast("int").alias("width"))


def vector_width(transformed: DataFrame, features_col: str = "features") -> int:
    """E4 from the assembler's ``ml_attr`` metadata: schema only, no job."""
    return int(transformed.schema[features_col].metadata["ml_attr"]["num_attrs"])


# --------------------------------------------------------------------------- E2/E3 (MLlib)
def index_cols(categoricals: Sequence[str]) -> list[str]:
    return [f"{c}_idx" for c in categoricals]


def vec_cols(categoricals: Sequence[str]) -> list[str]:
    return [f"{c}_vec" for c in categoricals]


def encoder_stages(categoricals: Sequence[str], numerics: Sequence[str], handle_invalid: str = "error",
                   scale_numeric: bool = False, features_col: str = "features") -> list:
    """E1+E2+E3 as MLlib stages.

    ``handle_invalid="keep"`` gives unseen categories their own slot instead
    of failing when a category occurs only in test data or one fold.
    ``scale_numeric`` standardises the numeric block (mean 0, sd 1) before
    assembly; the one-hot block is left as 0/1.
    """
    stages: list = [
        StringIndexer(inputCols=list(categoricals), outputCols=index_cols(categoricals),
                      stringOrderType="frequencyDesc", handleInvalid=handle_invalid),
        # an unseen value already has a valid index (the indexer's extra label),
        # so the encoder itself never sees an invalid index
        OneHotEncoder(inputCols=index_cols(categoricals), outputCols=vec_cols(categoricals), dropLast=True,
                      handleInvalid="error"),
    ]
    if scale_numeric:
        stages += [VectorAssembler(inputCols=list(numerics), outputCol="_numeric_raw"),
                   StandardScaler(inputCol="_numeric_raw", outputCol="_numeric", withMean=True, withStd=True)]
        inputs = ["_numeric"] + vec_cols(categoricals)
    else:
        inputs = list(numerics) + vec_cols(categoricals)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features_col))
    return stages


def fit_encoders(df: DataFrame, categoricals: Sequence[str], numerics: Sequence[str], **kw) -> PipelineModel:
    return Pipeline(stages=encoder_stages(categoricals, numerics, **kw)).fit(df)


def _entries(vec: str) -> Column:
    """The stored entries of a vector column as ``array<struct<slot, value>>``: a sparse
    vector's own indices (cost: its non-zeros), every position of a dense one."""
    v = F.unwrap_udt(F.col(vec))
    slots = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    return F.when(F.size(v["values"]) > 0, F.arrays_zip(slots.alias("slot"), v["values"].alias("value"))).otherwise(
        F.array().cast("array<struct<slot:int,value:double>>"))


def one_hot_entries(encoded: DataFrame, key: str, categoricals: Sequence[str]) -> DataFrame:
    """E2 as rows: ``(key, feature, slot)`` for every one-hot position set to 1, read
    from the encoder's own vectors."""
    blocks = F.array(*[F.struct(F.lit(c).alias("feature"), _entries(v).alias("entries"))
                       for c, v in zip(categoricals, vec_cols(categoricals))])
    return (encoded.select(F.col(key), F.inline(blocks)).select(key, "feature", F.inline("entries"))
            .where(F.col("value") != 0).select(key, "feature", F.col("slot").cast("int").alias("slot")))


def assembled_entries(encoded: DataFrame, key: str, features_col: str = "features") -> DataFrame:
    """E3 as rows: ``(key, slot, value)`` for every non-zero value of the assembled vector."""
    return (encoded.select(F.col(key), F.inline(_entries(features_col))).where(F.col("value") != 0)
            .select(key, F.col("slot").cast("int").alias("slot"), "value"))


# --------------------------------------------------------------------------- E5
def bucket(col: str, splits: Sequence[float], handle_invalid: str = "error") -> Column:
    """E5: bucket ``i`` for ``splits[i] <= x < splits[i+1]``, the last bucket
    also holding its upper bound (``Bucketizer`` semantics, as one CASE
    expression inside codegen).  Values outside the splits always raise;
    NaN raises (``error``), is NULL for later filtering (``skip``), or goes to
    an extra bucket ``len(splits) - 1`` (``keep``).  Equal adjacent splits
    (ties in skewed data) just leave an empty bucket.
    """
    x = F.col(col)
    k = len(splits) - 1
    expr = None
    for i in range(k):
        lo, hi = float(splits[i]), float(splits[i + 1])
        cond = (x >= lo) & ((x < hi) if i < k - 1 else (x <= hi))
        expr = F.when(cond, F.lit(float(i))) if expr is None else expr.when(cond, F.lit(float(i)))
    nan_branch = {"error": F.raise_error(F.lit(f"NaN in {col}: bucketing needs a number")),
                  "skip": F.lit(None).cast("double"),
                  "keep": F.lit(float(k))}[handle_invalid]
    return (F.when(x.isNull(), F.lit(None).cast("double"))
             .when(F.isnan(x), nan_branch)
             .otherwise(expr.otherwise(F.raise_error(
                 F.concat(F.lit(f"{col} value outside the bucket splits: "), x.cast("string")))))
             .cast("double"))


def price_bands(df: DataFrame, low: float, high: float, col: str = "price", label_col: str = "label") -> DataFrame:
    """E5 as used by the classifier: splits ``[0, low, high, +inf]`` ->
    0 = low, 1 = medium (``low <= price < high``), 2 = high (``price >= high``)."""
    return df.withColumn(label_col, bucket(col, [0.0, low, high, float("inf")]))
