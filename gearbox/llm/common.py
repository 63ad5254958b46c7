"""Small helpers shared by the operators: input columns, materialised
intermediate tables and connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.session import release_scratch, scratch_path, ship_package

# The white space of the word definition [^\x20\x09-\x0D]+.
SPACES = "\\x20\\x09-\\x0D"
SLICE_BYTES = 1 << 20  # of a batch that a task turns into strings at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The columns an operator works on, a null text as the empty text; other
    columns of the input, whatever their names, stay out of the operator."""
    return df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias(text_col),
                     *[F.col(c) for c in more])


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder (``spark.checkpoint.dir``)
    and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                 schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` with this package's code at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def in_slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in order, about ``size`` bytes at a time (a row at least): what a
    task makes of a batch besides (strings, columns to give back) stays as small."""
    for b in batches:
        step = max(1, b.num_rows * size // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words (0 for null)."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    gaps = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" ")))
    single = (spaced != "") & ~(spaced.contains("  ") | spaced.startswith(" ") | spaced.endswith(" "))
    return (F.when(single, gaps + 1)
            .otherwise(F.size(F.filter(F.split(spaced, " "), lambda w: w != "")))).cast("long")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges (a, b)``
    (longs): ``component`` is the smallest node reachable.

    Alternating large-star and small-star rounds: each node's larger
    neighbours are pointed at the smallest of its neighbourhood, then each
    node and its smaller neighbours at the smallest of those, until nothing
    changes.  A star is an aggregation (a node's minimum, combined before
    the shuffle) and a join back on the node; rounds grow with the
    logarithm of the longest path.  Every round is written to a table, so a lost
    executor repeats one round at most, and the table before it is deleted.
    Nothing but a count and a checksum reaches the driver.
    """
    spark = edges.sparkSession
    schema = "a bigint, b bigint"

    def written(e: DataFrame) -> tuple[str, DataFrame, tuple]:
        path = scratch_path(spark, "components")
        e.where(F.col("a") != F.col("b")).distinct().write.parquet(path)
        table = spark.read.schema(schema).parquet(path)
        return path, table, tuple(table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    def star(pairs: DataFrame, least: DataFrame) -> DataFrame:
        """``pairs`` with the least neighbour of ``a``; merge joins: both sides grow with the table."""
        return pairs.join(least.hint("merge"), "a")

    path, current, before = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while before[0]:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = star(both, low).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = star(large, down).select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        old = path
        path, current, after = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        release_scratch(old)
        if after == before:
            break
        before = after
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file; the default of the operators' path parameter."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
