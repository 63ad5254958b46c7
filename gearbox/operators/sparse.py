"""Feature vectors for vocabularies of any size: no model holds a vocabulary on the driver.

The same numbers as ``features.encoder_stages`` (index by frequency, one-hot without the last category, numerics
first), made by joins:

* the index table (``category_index``) is written once; only each column's number of categories, one row a column,
  reaches the driver, as slots follow from it;
* rows meet a column's index in two joins: its most frequent values are broadcast (their number is a parameter, their
  size is measured), all others are joined by a shuffle.  A value outside the head holds at most one ``head_values``-th of
  the rows, so no key of the shuffle is hot, and rows of the head are spread over it by their own hash;
* vectors are built as structs by SQL expressions and written once; they are read back as vectors.  They have no
  per-slot attributes: ``slot_ranges`` tells the column of a slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.operators.features import category_index
from gearbox.operators.joins import DEFAULT_MAX_BYTES, measured_bytes
from gearbox.session import scratch_path

HEAD_VALUES = 100_000
SPREAD = 4096


class CategoryIndex:
    """The written index of some columns: ``table`` (``feature, value, count, index``) and ``sizes``."""

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        spark = df.sparkSession
        self.columns = list(columns)
        path = scratch_path(spark, "category_index")
        category_index(df, self.columns).write.partitionBy("feature").parquet(path)
        self.table = spark.read.schema("value string, count long, index int, feature string").parquet(path)
        found = {r["feature"]: r["n"] for r in self.table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.sizes = {c: found.get(c, 0) for c in self.columns}  # one row a column

    def of(self, column: str) -> DataFrame:
        return self.table.where(F.col("feature") == column).select(F.col("value"), F.col("index"))


def slot_ranges(index: CategoryIndex, numerics: Sequence[str], handle_invalid: str = "error") -> dict[str, tuple[int, int]]:
    """``(first slot, number of slots)`` of every column, in the order of the slots."""
    ranges, at = {}, 0
    for c in numerics:
        ranges[c] = (at, 1)
        at += 1
    for c in index.columns:
        size = index.sizes[c] if handle_invalid == "keep" else max(index.sizes[c] - 1, 0)
        ranges[c] = (at, size)
        at += size
    return ranges


def with_indexes(df: DataFrame, index: CategoryIndex, head_values: int = HEAD_VALUES,
                 max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``df`` with ``<column>_idx`` for every indexed column; null where the value has no index."""
    for i, c in enumerate(index.columns):
        names = index.of(c)
        n = min(head_values, index.sizes[c])
        head = names.where(F.col("index") < n)
        while n > 1 and measured_bytes(head) > max_bytes:  # long values: fewer of them
            n //= 4
            head = names.where(F.col("index") < n)
        text, found = F.col(f"`{c}`").cast("string"), f"_head{i}"
        out = [F.col(f"`{x}`") for x in df.columns]
        if measured_bytes(head) <= max_bytes:
            head = head.select(F.col("value").alias("_value"), F.col("index").alias(found))
            df = df.join(F.broadcast(head), text == F.col("_value"), "left").drop("_value")
        else:
            n, df = 0, df.withColumn(found, F.lit(None).cast("int"))
        if n == index.sizes[c]:
            df = df.select(*out, F.col(found).alias(f"{c}_idx"))
            continue
        tail = names.where(F.col("index") >= n).select(F.concat(F.lit("="), "value").alias("_value"), F.col("index").alias("_tail"))
        # a key of its own for rows that need no index, as nulls would all go to one task
        spread = F.concat(F.lit("#"), F.pmod(F.xxhash64(*out), F.lit(SPREAD)).cast("string"))
        keyed = df.withColumn("_rest", F.when(F.col(found).isNull() & text.isNotNull(), F.concat(F.lit("="), text)).otherwise(spread))
        df = (keyed.join(tail, F.col("_rest") == F.col("_value"), "left")
              .select(*out, F.coalesce(found, "_tail").alias(f"{c}_idx")))
    return df


def _vector(index: CategoryIndex, numerics: Sequence[str], handle_invalid: str) -> Column:
    ranges = slot_ranges(index, numerics, handle_invalid)
    width = sum(n for _, n in ranges.values())
    entry = "struct<slot:int,value:double>"
    cells = []
    for c in numerics:
        x = F.col(f"`{c}`").cast("double")
        known = F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit(f"{c} is null or NaN: drop such rows first"))).otherwise(x)
        cells.append(F.when(known != 0, F.struct(F.lit(ranges[c][0]).alias("slot"), known.cast("double").alias("value")).cast(entry)))
    for c in index.columns:
        first, size = ranges[c]
        at = F.col(f"`{c}_idx`")
        if handle_invalid == "error":
            at = F.when(at.isNull(), F.raise_error(F.concat(
                F.lit(f"unseen category or null in {c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")))).cast("int")).otherwise(at)
        cells.append(F.when(at < size, F.struct((at + first).alias("slot"), F.lit(1.0).alias("value")).cast(entry)))
    cells = F.filter(F.array(*cells) if cells else F.array().cast(f"array<{entry}>"), lambda e: e.isNotNull())
    return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"),
                    F.transform(cells, lambda e: e["slot"]).alias("indices"),
                    F.transform(cells, lambda e: e["value"]).alias("values"))


def sparse_vectors(df: DataFrame, index: CategoryIndex, numerics: Sequence[str], keep: Sequence[str] = (),
                   handle_invalid: str = "error", features_col: str = "features", head_values: int = HEAD_VALUES,
                   max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``keep`` and a sparse vector for every row of ``df``, for any MLlib estimator.

    ``handle_invalid="keep"`` gives unseen and null categories no entry; ``"error"`` raises.  A null or
    NaN numeric raises.  A column with one category has no slots; an empty table gives no rows.
    """
    spark = df.sparkSession
    used = [*dict.fromkeys([*keep, *numerics, *index.columns])]
    rows = with_indexes(df.select(*[F.col(f"`{c}`") for c in used]), index, head_values, max_bytes)
    built = rows.select(*[F.col(f"`{c}`") for c in keep], _vector(index, numerics, handle_invalid).alias(features_col))
    path = scratch_path(spark, "sparse_vectors")
    built.write.parquet(path)
    fields = [df.schema[c] for c in keep] + [T.StructField(features_col, VectorUDT())]
    return spark.read.schema(T.StructType(fields)).parquet(path)
