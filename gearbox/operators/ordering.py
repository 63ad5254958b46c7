"""Global row index without a single-partition window.

``row_number() over (order by k)`` with no ``partitionBy`` moves every row
into one task.  ``with_global_index`` gives the same 0-based index with the
work spread over all partitions:

1. range-partition on the order key and sort inside each partition, so
   partition ``i`` holds a contiguous, sorted slice of the order;
2. tag rows with ``monotonically_increasing_id`` (partition id in the upper
   bits, position inside the partition in the lower 33 bits);
3. materialise that once with a reliable ``checkpoint()`` into the shared
   checkpoint folder, so the partition contents cannot change between the
   two reads below (range bounds come from sampling);
4. count rows per partition (one row per partition), turn the counts into
   start offsets, and broadcast that table: its size is bounded by the
   number of partitions, not by the data;
5. index = offset of the row's partition + position inside the partition.

Hot values: a range partitioner sends equal keys to one partition, so a
value holding a third of the rows would make one task sort a third of the
data.  Unless ``tiebreak=False``, the input row's own
``monotonically_increasing_id`` (taken before the shuffle) is appended to the
sort key; ties then spread over as many partitions as their share needs.
The order among ties is arbitrary but fixed by the checkpoint.

Partition count: ``num_partitions``, or the optimizer's size estimate of the
input divided by ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (at
least ``spark.sql.shuffle.partitions``), so the sort inside each partition
stays near the advisory size at any input size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearbox.session import shared_dir

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def _bytes(text: str) -> int:
    t = text.strip().lower()
    digits = "".join(ch for ch in t if ch.isdigit())
    unit = t[len(digits):].strip() or "b"
    return int(digits) * _UNITS.get(unit, 1)


def size_partitions(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` divided by the advisory
    partition size (0 when no estimate is available)."""
    spark = df.sparkSession
    advisory = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # no estimate available
        return 0
    return math.ceil(size / max(advisory, 1))


def target_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle of ``df``: size estimate / advisory size,
    never below ``spark.sql.shuffle.partitions``."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size_partitions(df))


def partitions_for_rows(spark, rows: int, row_bytes: int = 64) -> int:
    """Partitions for ``rows`` rows of about ``row_bytes`` bytes at the advisory size
    (for inputs whose row count is known but whose plan estimate is not)."""
    advisory = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    return max(1, math.ceil(rows * row_bytes / max(advisory, 1)))


def with_global_index(df: DataFrame, order: list[Column | str], index_col: str = "row_index",
                      num_partitions: int | None = None, tiebreak: bool = True) -> tuple[DataFrame, DataFrame]:
    """Return ``(indexed, partition_counts)``.

    ``indexed`` is ``df`` plus a 0-based ``index_col`` following ``order``.
    ``partition_counts`` has one row per non-empty partition with its row
    count and start offset; its total is the row count, so callers that also
    need ``n`` do not scan the data again.
    """
    spark = df.sparkSession
    shared_dir(spark)  # make sure a reliable checkpoint folder is set
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = num_partitions or target_partitions(df)
    if tiebreak:
        df = df.withColumn("_gx_tie", F.monotonically_increasing_id())
        cols = cols + [F.col("_gx_tie")]
    tagged = (df.repartitionByRange(n, *cols)
                .sortWithinPartitions(*cols)
                .withColumn("_gx_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    if tiebreak:
        tagged = tagged.drop("_gx_tie")
    pid = F.shiftright(F.col("_gx_mid"), _POS_BITS)
    counts = tagged.groupBy(pid.alias("_gx_pid")).agg(F.count(F.lit(1)).alias("_gx_n"))
    before = Window.orderBy("_gx_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_gx_pid", "_gx_n",
                            F.coalesce(F.sum("_gx_n").over(before), F.lit(0)).alias("_gx_off"))
    indexed = (tagged.join(F.broadcast(offsets.select("_gx_pid", "_gx_off")), pid == F.col("_gx_pid"))
               .withColumn(index_col, F.col("_gx_off") + F.col("_gx_mid").bitwiseAND(F.lit(_POS_MASK)))
               .drop("_gx_mid", "_gx_pid", "_gx_off"))
    return indexed, offsets
