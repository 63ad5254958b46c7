"""Aggregations: row counts, percentiles (approximate and exact integer-rank),
category frequencies.

Each is one aggregation (partial aggregation on the map side, one small
shuffle); nothing but scalar results reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.session import shared_dir


def row_counts(df: DataFrame, conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """A1: ``n_rows`` plus one ``count_if`` per named condition, in ONE pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name, cond in (conditions or {}).items():
        aggs.append(F.count_if(cond).alias(name))
    return df.agg(*aggs)


def approx_percentiles(df: DataFrame, col: str, probs: Sequence[float] = (0.33, 0.67),
                       accuracy: int = 10000, names: Sequence[str] | None = None) -> DataFrame:
    """A2: one ``percentile_approx`` call for all probabilities (one sketch per
    partition, merged; rank error at most ``n / accuracy``)."""
    arr = F.percentile_approx(F.col(col), list(probs), accuracy)
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    return df.select(arr.alias("_q")).select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def values_at_ranks(df: DataFrame, col: str, percents: Sequence[int] = (), parts: int | None = None,
                    accuracy: int = 10000) -> list:
    """The values of ``col`` (nulls excluded) at 1-based ranks ``ceil(p * n / 100)``
    for each integer percent, or at the first rank of parts 2..``parts`` of
    ``numpy.array_split``; exact, without sorting the rows.

    One aggregation gives ``n`` and ``percentile_approx`` values around every
    rank; their rank error (at most ``n / accuracy``) brackets the answer.  A
    second one counts the rows below each bracket and the rows of every
    distinct value inside: a value that holds a third of the rows is one row
    there after partial aggregation.  A running sum over the distinct values of
    a bracket, in key ranges whose counts are summed first, gives the value at the
    rank.  Only counts and the answers reach the driver.
    """
    values = df.select(F.col(col).alias("v")).where(F.col("v").isNotNull())
    n = values.count()
    if n == 0:
        return [None] * (len(percents) if parts is None else parts - 1)
    if parts is None:
        ranks = [max(1, (p * n + 99) // 100) for p in percents]
    else:
        q, r = divmod(n, parts)
        ranks = [min(i * q + min(i, r) + 1, n + 1) for i in range(1, parts)]
    eps = 3 / accuracy
    wanted = [k for k in ranks if k <= n]
    probs = [x for k in wanted for x in (max(0.0, k / n - eps), min(1.0, k / n + eps))]
    ends = values.agg(F.percentile_approx("v", probs, accuracy).alias("q")).first()["q"] if wanted else []
    brackets = [(ends[2 * i], ends[2 * i + 1]) for i in range(len(wanted))]
    # the lowest and highest value are their own brackets: no rank lies outside
    found = {}
    if brackets:
        inside = F.array(*[F.when((F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi)), F.lit(i))
                           for i, (lo, hi) in enumerate(brackets)])
        below = values.agg(*[F.count_if(F.col("v") < F.lit(lo)).alias(f"b{i}") for i, (lo, _) in enumerate(brackets)]).first()
        counts = (values.select("v", F.explode(F.array_compact(inside)).alias("i"))
                  .groupBy("i", "v").agg(F.count(F.lit(1)).alias("c")))
        shared_dir(df.sparkSession)
        counts = counts.checkpoint(eager=True)
        for i, k in enumerate(wanted):
            if k not in found:
                found[k] = _value_at(counts.where(F.col("i") == i).select("v", "c"), k - below[f"b{i}"])
    return [found.get(k) for k in ranks]


MAX_WINDOW_ROWS = 100_000


def _value_at(counts: DataFrame, rank: int):
    """The value at a 1-based rank among ``(v, c)`` distinct values with counts.
    While there are many, the bracket is narrowed by quantiles of the distinct
    values, so that the running sum is over few rows."""
    while True:
        n = counts.count()
        if n <= MAX_WINDOW_ROWS:
            running = Window.orderBy("v")  # at most MAX_WINDOW_ROWS rows
            hit = (counts.withColumn("upto", F.sum("c").over(running)).where(F.col("upto") >= rank)
                   .orderBy("v").limit(1).first())
            return None if hit is None else hit["v"]
        cuts = sorted(set(counts.agg(F.percentile_approx("v", [j / 64 for j in range(1, 64)], 1000).alias("q")).first()["q"]))
        sums = counts.agg(*[F.coalesce(F.sum(F.when(F.col("v") <= F.lit(c), F.col("c"))), F.lit(0)).alias(f"s{j}")
                            for j, c in enumerate(cuts)]).first()
        above = next((j for j in range(len(cuts)) if sums[f"s{j}"] >= rank), None)
        if above is None:
            rank -= sums[f"s{len(cuts) - 1}"]
            counts = counts.where(F.col("v") > F.lit(cuts[-1]))
        else:
            counts = counts.where(F.col("v") <= F.lit(cuts[above]))
            if above:
                rank -= sums[f"s{above - 1}"]
                counts = counts.where(F.col("v") > F.lit(cuts[above - 1]))


def exact_percentiles(df: DataFrame, col: str, percents: Sequence[int] = (33, 67),
                      names: Sequence[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """A2x: one row; for each integer percent ``p`` the smallest value whose
    1-based rank ``rn`` satisfies ``rn * 100 >= p * n`` (nulls excluded, no
    rows: nulls).  See ``values_at_ranks``; one path for tables of all sizes."""
    names = list(names or [f"p{p}" for p in percents])
    found = values_at_ranks(df, col, percents=percents, accuracy=accuracy)
    kind = df.schema[col].dataType
    return df.sparkSession.createDataFrame([tuple(found)], T.StructType([T.StructField(nm, kind) for nm in names]))


def category_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, count)`` for several categorical columns in one pass.

    The columns are unpivoted with a generator and counted with a single
    ``groupBy``; partial aggregation collapses a hot value before the
    shuffle, so a value holding a third of the rows costs no skew.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs))
              .groupBy("feature", "value")
              .agg(F.count(F.lit(1)).alias("count")))
