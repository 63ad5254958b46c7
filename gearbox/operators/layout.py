"""Row layout: contiguous n-way split, repartition/rebalance, random and keyed
train/test splits, k-fold assignment, union of parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gearbox.functions.columns import hash_bucket
from gearbox.operators.ordering import with_global_index
from gearbox.operators.stats import values_at_ranks


def contiguous_split(df: DataFrame, order: list[Column | str], n: int, part_col: str = "part",
                     num_partitions: int | None = None) -> DataFrame:
    """Cut the rows, in ``order``, into ``n`` contiguous parts numbered 1..n.

    Sizes follow ``numpy.array_split``: with ``q, r = divmod(N, n)`` the first
    ``r`` parts get ``q + 1`` rows and the rest ``q``.  ``order`` must be a
    unique key for the cut to be reproducible.  No global window: the row
    index comes from ``with_global_index``.
    """
    indexed, counts = with_global_index(df, order, "_row", num_partitions)
    total = counts.agg(F.sum("_gx_n")).first()[0] or 0
    q, r = divmod(total, n)
    big = r * (q + 1)
    part0 = F.expr(f"CASE WHEN _row < {big} THEN _row DIV {q + 1} "
                   f"ELSE {r} + (_row - {big}) DIV {max(q, 1)} END")
    return indexed.withColumn(part_col, (part0 + 1).cast("int")).drop("_row")


def contiguous_split_by_key(df: DataFrame, key: str, n: int, part_col: str = "part") -> DataFrame:
    """W1 for a unique key: the same parts as ``contiguous_split``, from the n - 1
    keys at which parts begin.  Only the key column is read to find them; the
    rows themselves are neither shuffled nor copied.  A null key is in part 1."""
    starts = [b for b in values_at_ranks(df, key, parts=n)]
    part = F.lit(1)
    for b in starts:
        if b is not None:
            part = part + F.when(F.col(key) >= F.lit(b), F.lit(1)).otherwise(F.lit(0))
    return df.withColumn(part_col, part.cast("int"))


def contiguous_split_by_file(df: DataFrame, n: int, part_col: str = "part", order_col: str | None = None) -> DataFrame:
    """W1 for rows in the order of the files they are read from (by path, then position):
    the same sizes as ``contiguous_split``, and no row is moved, sorted or copied.

    ``df`` reads files and may only have been projected.  Parquet rows are numbered by
    ``_metadata.row_index``, with one count a file; others by their place in the scan, with one
    count a block.  The counts (a row per file or block, of 128 MB by default) become start offsets, only the
    n - 1 rows at which parts begin reach the driver, and each row compares its own position with these.
    Blocks must be cut alike when the rows are read again (``steady_file_blocks``).
    ``order_col`` keeps the position as a sortable column.
    """
    where, at = [F.col("_metadata.file_path").alias("_file")], F.monotonically_increasing_id()
    if "row_index" in df.select("_metadata").schema["_metadata"].dataType.fieldNames():
        at = F.col("_metadata.row_index")
    else:
        where.append(F.col("_metadata.file_block_start").alias("_block"))
    keys = ["_file", "_block"][:len(where)]
    counted = df.select(*where, at.alias("_at")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_at").alias("first"), F.max("_at").alias("last"))
    offsets = counted.select("*", F.coalesce(F.sum("rows").over(
        Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("rows").over(Window.partitionBy()).alias("total"))
    begins = F.transform(F.sequence(F.lit(1), F.lit(max(n - 1, 1))),
                         lambda i: i * F.expr(f"total DIV {n}") + F.least(i, F.col("total") % n))
    inside = F.filter(begins, lambda b: (b >= F.col("before")) & (b < F.col("before") + F.col("rows")))
    cuts = offsets.select("*", F.explode(inside).alias("begin")).collect() if n > 1 else []
    if any(c["last"] - c["first"] + 1 != c["rows"] for c in cuts):
        raise ValueError("rows were filtered before the split: write them first, or use contiguous_split")
    place = F.struct(*keys, "_at")
    part = F.lit(1)
    for c in cuts:
        begin = F.struct(*[F.lit(c[k]).cast("string" if k == "_file" else "long").alias(k) for k in keys],
                         F.lit(c["first"] + c["begin"] - c["before"]).cast("long").alias("_at"))
        part = part + (place >= begin).cast("int")
    placed = df.select("*", *where, at.alias("_at")).withColumn(part_col, part)
    if order_col:
        placed = placed.withColumn(order_col, place)
    return placed.drop(*keys, "_at")


@contextmanager
def steady_file_blocks(spark: SparkSession) -> Iterator[None]:
    """While open, the size of a scan's file blocks does not follow the number of cores that
    happen to be registered, so that two scans cut the same files alike."""
    name = "spark.sql.files.minPartitionNum"
    kept = spark.conf.get(name, None)
    if kept is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(name)


def repartition_rows(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """L1: round-robin repartition (default: the cluster's default parallelism)."""
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(int(n))


def rebalance(df: DataFrame, num_partitions: int, key: Column | str | None = None, seed: int = 42) -> DataFrame:
    """L2: spread rows evenly over ``num_partitions``.

    With ``key`` the target partition is a hash of the key (reproducible,
    independent of input order); without it a seeded random salt is used like
    the original, which is not reproducible across differently partitioned
    inputs.  No salt column survives in the output.
    """
    if key is not None:
        k = F.col(key) if isinstance(key, str) else key
        salt = F.xxhash64(k)
    else:
        salt = F.rand(seed)
    return df.repartition(num_partitions, salt.alias("_salt"))


def rebalance_by_size(df: DataFrame, *keys: Column | str) -> DataFrame:
    """L2 with the number of partitions left to Spark: rows of equal ``keys`` (none: any rows) come
    together, small partitions are merged and those beyond ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    are split by the sizes that the shuffle measured, so that one key may hold any share of the rows.  Needs AQE."""
    return df.hint("rebalance", *[F.col(k) if isinstance(k, str) else k for k in keys])


def partition_sizes(df: DataFrame) -> DataFrame:
    """L4: rows per physical partition (``partition``, ``rows``)."""
    return (df.groupBy(F.spark_partition_id().alias("partition"))
              .agg(F.count(F.lit(1)).alias("rows")))


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42,
                 names: Sequence[str] = ("train", "test")) -> DataFrame:
    """A random split as a ``split`` column, one scan: a seeded ``rand`` against
    the running weights.

    Depends on partitioning (same seed, different layout -> different rows);
    use ``keyed_split`` when the split must be reproducible.
    """
    total, upto = float(sum(weights)), 0.0
    label = None
    drawn = df.withColumn("_draw", F.rand(seed))
    for w, name in list(zip(weights, names))[:-1]:
        upto += w / total
        cond = F.col("_draw") < upto
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    last = F.lit(names[len(weights) - 1])
    return drawn.withColumn("split", last if label is None else label.otherwise(last)).drop("_draw")


def keyed_split(df: DataFrame, key: str, train_percent: int = 80, split_col: str = "split") -> DataFrame:
    """L5x: ``train`` if md5-bucket(key) mod 100 < ``train_percent`` else ``test``."""
    b = hash_bucket(key, 100)
    return df.withColumn(split_col, F.when(b < train_percent, F.lit("train")).otherwise(F.lit("test")))


def kfold(df: DataFrame, key: str, k: int = 3, fold_col: str = "fold", salt: str = "f") -> DataFrame:
    """Fold in ``[0, k)`` from a salted md5 bucket of the key (usable as
    ``CrossValidator.foldCol``)."""
    return df.withColumn(fold_col, hash_bucket(key, k, salt).cast("int"))


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenate parts by column name; columns a part lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
