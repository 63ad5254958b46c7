"""Column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and, where they are predicates on scan columns, push down to Parquet.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)


def resolve_column(df: DataFrame, name: str) -> str:
    """Return the column of ``df`` whose name equals ``name`` ignoring case.

    Raises ``KeyError`` when there is none.  Only the schema is inspected; no
    job runs.
    """
    wanted = name.lower()
    for c in df.columns:
        if c.lower() == wanted:
            return c
    raise KeyError(f"No '{name}' column found in the dataset (columns: {df.columns})")


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or (for text columns) blank after trimming spaces.

    On a non-text column the blank test can never be true, so it is left out
    rather than casting every value to text.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNull() | (F.trim(c) == F.lit(""))
    return c.isNull()


def not_null_all(df: DataFrame, subset: Iterable[str] | None = None) -> Column:
    """Conjunction equivalent to ``df.dropna(how='any', subset=subset)``.

    ``dropna`` compiles to ``AtLeastNNonNulls``, which Parquet cannot push
    down; an explicit ``IS NOT NULL`` conjunction does push down.  ``dropna``
    also treats NaN as missing on floating columns, so those get ``NOT isnan``.
    """
    names = list(subset) if subset is not None else list(df.columns)
    cond = F.lit(True)
    for n in names:
        term = F.col(n).isNotNull()
        if isinstance(df.schema[n].dataType, _FLOATING):
            term = term & ~F.isnan(F.col(n))
        cond = cond & term
    return cond


def to_double(name: str) -> Column:
    """Text to double; bad text becomes NULL under ANSI instead of failing."""
    return F.col(name).try_cast("double")


def _hash32(key: Column, salt: str) -> Column:
    keyed = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    # first 8 hex digits of md5 -> unsigned 32-bit integer, portable to any SQL engine
    return F.conv(F.substring(F.md5(keyed), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column | str, buckets: int, salt: str = "") -> Column:
    """Deterministic bucket in ``[0, buckets)`` from the row's key.

    Unlike ``rand()``/``randomSplit`` the result depends only on the key,
    never on partitioning or task order, so reruns and other engines agree.
    """
    k = F.col(key) if isinstance(key, str) else key
    return _hash32(k, salt) % F.lit(buckets)


def hash_unit(key: Column | str, salt: str = "") -> Column:
    """Deterministic pseudo-uniform double in ``[0, 1)`` from the row's key."""
    k = F.col(key) if isinstance(key, str) else key
    return _hash32(k, salt) / F.lit(4294967296.0)
