"""Sinks: Parquet/CSV directories and partitioned layouts; every task writes its own files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gearbox.sources.fs import delete_path, replace_path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> str:
    """K1 (and K4 with ``partition_by``): Parquet directory."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              partition_by: Sequence[str] | None = None, compression: str = "none") -> str:
    """K6 (K4 with ``partition_by``): CSV directory with a header line.

    Blank and space-only text is written quoted and untrimmed, NULL as an
    empty field, so ``read_csv`` gives back exactly what was written; where
    text holds line breaks, read it with ``multi_line=True``.
    Files under ``compression`` are read as they are, each by one task: a writing task's rows.
    """
    w = (df.write.mode(mode).option("header", header).option("compression", compression)
         .option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def write_if_nonempty(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """K5: write only when there is at least one row; returns the number of rows.

    ``df`` is worked out once: the rows are counted while they are written beside
    ``path``, and the folder is renamed if there are any, else deleted."""
    spark, rows = df.sparkSession, Observation()
    beside = f"{path.rstrip('/')}.writing"
    {"parquet": write_parquet, "csv": write_csv}[fmt](df.observe(rows, F.count(F.lit(1)).alias("n")), beside)
    n = rows.get["n"]
    if n:
        replace_path(spark, beside, path)
    else:
        delete_path(spark, beside)
    return n
