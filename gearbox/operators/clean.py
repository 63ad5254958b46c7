"""Cleaning: cast the target, find/drop missing values, quarantine.

Every filter here is a plain predicate (``IS NOT NULL`` conjunctions,
``trim(x) = ''``), so Catalyst pushes the null tests into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.functions.columns import is_missing, not_null_all, resolve_column, to_double


REASONS = ("null", "blank", "unparseable")


def cast_target(df: DataFrame, target: str = "price") -> DataFrame:
    """Text -> double for ``target`` when the column exists (else unchanged).

    ``try_cast``: blank or junk text becomes NULL instead of failing under ANSI.
    """
    if target not in df.columns:
        return df
    return df.withColumn(target, to_double(target))


def missing_rows(df: DataFrame, target: str = "price") -> DataFrame:
    """rows whose target (matched case-insensitively) is null or blank."""
    col = resolve_column(df, target)
    return df.where(is_missing(df, col))


def present_rows(df: DataFrame, target: str = "price") -> DataFrame:
    """Complement of ``missing_rows``: together they cover every row once."""
    col = resolve_column(df, target)
    return df.where(~is_missing(df, col))


def drop_any_null(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """F2 (``subset=None``) / F3: drop rows with a null (or NaN) in the columns."""
    return df.where(not_null_all(df, subset))


def drop_target_null(df: DataFrame, target: str = "price") -> DataFrame:
    """``na.drop(subset=[target])``; a missing column raises like the original."""
    if target not in df.columns:
        raise KeyError(f"column '{target}' not found")
    return drop_any_null(df, [target])


def quarantine_split(df: DataFrame, target: str = "price") -> tuple[DataFrame, DataFrame]:
    """F4 core: ``(clean, quarantined)`` as two filters over the same input."""
    return present_rows(df, target), missing_rows(df, target)


def select_ci(df: DataFrame, *names: str) -> DataFrame:
    """P6 helper: select columns by case-insensitive names, keeping stored names."""
    return df.select(*[F.col(resolve_column(df, n)) for n in names])


def with_reason(df: DataFrame, target: str = "price", reason_col: str = "reason") -> DataFrame:
    """Adds why a row's target cannot be used: ``null``, ``blank``, ``unparseable`` or
    NULL for a usable row; exactly one of clean and quarantine holds every row."""
    col = resolve_column(df, target)
    c = F.col(col)
    reason = F.when(c.isNull(), F.lit("null"))
    if isinstance(df.schema[col].dataType, T.StringType):
        value = c.try_cast("double")
        reason = (reason.when(F.trim(c) == F.lit(""), F.lit("blank"))
                  .when(value.isNull() | F.isnan(value), F.lit("unparseable")))
    elif isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType)):
        reason = reason.when(F.isnan(c), F.lit("unparseable"))
    return df.withColumn(reason_col, reason)


def clean_and_quarantine(df: DataFrame, target: str = "price") -> tuple[DataFrame, DataFrame]:
    """F4 + F5 together: ``(clean rows with a double target, quarantined rows as
    they came with a reason)``; the second is the exact complement of the first."""
    marked = with_reason(df, target, "reason")
    col = resolve_column(df, target)
    clean = marked.where(F.col("reason").isNull()).drop("reason").withColumn(col, to_double(col))
    return clean, marked.where(F.col("reason").isNotNull())
