"""Percentiles of a table that grows by parts, from one stored sketch for each part.

A part is scanned once, when it arrives; percentiles of all parts, or of any choice
of them, come from merging their sketches (KLL, a few kilobytes each), without
reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 4000  # sketch size: a normalised rank error of about 0.1 %


def part_sketches(df: DataFrame, col: str, part: str | Column, k: int = K) -> DataFrame:
    """``part, n, sketch``: one row for each part; nulls and NaN are not counted, parts without values
    have an empty sketch."""
    value = F.col(col).cast("double")
    value = F.when(~F.isnan(value), value)
    name = F.col(part) if isinstance(part, str) else part
    return df.groupBy(name.alias("part")).agg(F.count(value).alias("n"), F.kll_sketch_agg_double(value, k).alias("sketch"))


def merged_percentiles(sketches: DataFrame, probs: Sequence[float] = (0.33, 0.67), names: Sequence[str] | None = None,
                       by: Sequence[str] = ()) -> DataFrame:
    """``n`` and one column for each probability over the parts of ``sketches``, for each value of ``by``; null
    where there are no values."""
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    merged = sketches.where("n > 0").groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    filled = F.col("n") > 0
    return merged.select(*by, F.coalesce("n", F.lit(0)).alias("n"),
                         *[F.when(filled, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(n) for p, n in zip(probs, names)])
