"""Column types of text tables (CSV) by a lattice, in one aggregation.

A value fits some of the types ``TYPES``; a column's types are those that all its
values fit, so parts are scanned apart and their results joined by an intersection
(``bit_and``) that never reads a row again.  The narrowest type is the first of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The types in order of preference, each with its bit.
TYPES = ("boolean", "int", "bigint", "double", "date", "timestamp")
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DATE = r"^\s*\d{4}-\d{2}-\d{2}\s*$"
_TIME = r"^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?\s*$"
ALL = (1 << len(TYPES)) - 1


def fits(value: Column) -> Column:
    """Bits of the types that a text fits; all for null."""
    def bit(name: str, shape: Column) -> Column:
        return F.when(shape & value.try_cast(name).isNotNull(), F.lit(1 << TYPES.index(name))).otherwise(F.lit(0))

    number = value.rlike(_NUMBER)
    parts = [bit("boolean", F.lower(F.trim(value)).isin("true", "false")), bit("int", number), bit("bigint", number),
             bit("double", number), bit("date", value.rlike(_DATE)), bit("timestamp", value.rlike(_TIME))]
    found = parts[0]
    for p in parts[1:]:
        found = found.bitwiseOR(p)
    return F.when(value.isNull(), F.lit(ALL)).otherwise(found)


def column_types(text: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``<by>, column, types, n``: bits of the types that all ``n`` non-null values of a column fit, in one
    pass over a table of texts; one row for each column (and part)."""
    by = by or []
    columns = [c for c in text.columns if c not in by]
    found = text.groupBy(*by).agg(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.bit_and(fits(F.col(c))), F.lit(ALL)).alias("types"),
                                             F.count(F.col(c)).alias("n")).alias(f"_{i}") for i, c in enumerate(columns)])
    return found.select(*by, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def merged_types(parts: DataFrame) -> DataFrame:
    """``column, type, n`` over the parts of ``column_types``: the narrowest type all values fit, ``string`` if
    there is none or no value."""
    merged = parts.groupBy("column").agg(F.bit_and("types").alias("types"), F.sum("n").alias("n"))
    narrowest = F.lit("string")
    for i in reversed(range(len(TYPES))):
        narrowest = F.when(F.col("types").bitwiseAND(F.lit(1 << i)) != 0, F.lit(TYPES[i])).otherwise(narrowest)
    return merged.select("column", F.when(F.col("n") > 0, narrowest).otherwise(F.lit("string")).alias("type"), "n")


def typed(text: DataFrame, types: DataFrame) -> DataFrame:
    """The table of texts with the inferred types (one row for each column reaches the driver)."""
    found = {r["column"]: r["type"] for r in types.collect()}
    return text.select(*[F.trim(F.col(f.name)).cast(found[f.name]).alias(f.name) if found.get(f.name, "string") != "string"
                         else F.col(f.name) for f in text.schema.fields if isinstance(f.dataType, T.StringType)])
