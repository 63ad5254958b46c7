"""Data-preparation jobs composed from sources, operators and sinks.

Each job takes the caller's session and paths, writes its outputs, and
returns DataFrames that read the *written* output (not the lazy input plan),
so using the result later neither recomputes the job nor depends on the input
still being there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.functions.columns import resolve_column, to_double
from gearbox.operators.clean import REASONS, cast_target, drop_target_null, missing_rows, with_reason
from gearbox.operators.layout import repartition_rows
from gearbox.sinks.writers import write_csv, write_if_nonempty, write_parquet
from gearbox.sources.fs import ensure_folder, replace_path
from gearbox.sources.readers import read_csv, read_existing_parquet, read_first_available, read_parquet, sql_view_scan


@dataclass
class QuarantineResult:
    count: int
    rows: DataFrame  # the written quarantine table, or an empty one of its schema
    csv: str | None  # the written CSV folder


def quarantine_job(spark: SparkSession, input_parquet: str, input_csv: str, out_parquet: str, out_csv: str,
                   target: str = "price") -> QuarantineResult:
    """rows with a missing target go to ``out_parquet`` and, as a CSV folder, to ``out_csv``.

    Source: the Parquet copy if present, else the CSV (S6).  Nothing is
    written when no row is missing (K5).  The input is read once: rows are counted
    while they are written, and the CSV is made from the written Parquet.
    """
    df = read_first_available(spark, input_parquet, input_csv)
    missing = missing_rows(df, target)
    n = write_if_nonempty(missing, out_parquet)
    if not n:
        return QuarantineResult(0, missing.limit(0), None)
    written = spark.read.parquet(out_parquet)
    return QuarantineResult(n, written, write_csv(written, out_csv))


@dataclass
class CleanResult:
    clean: DataFrame          # the written rows with a double target
    quarantine: DataFrame     # the written other rows as they came, with their reason
    counts: dict[str, int]    # rows of ``clean`` and of every reason, counted while they were written


def clean_quarantine_job(spark: SparkSession, in_csv: str, out_clean: str, out_quarantine: str,
                         target: str = "price") -> CleanResult:
    """F4 + F5 in one pass: one CSV part to clean Parquet and, every other row with its
    reason, to quarantine Parquet.

    One scan feeds one write partitioned by the reason, whose folders are then renamed, so both outputs have
    the same stored columns: ``<target>`` as double (null in quarantine) and ``<target>_text`` as it
    came (null in clean); quarantine has a folder a reason.
    """
    marked = with_reason(read_csv(spark, in_csv), target, "reason")
    col = resolve_column(marked, target)
    text = f"{col}_text"
    names = [c for c in marked.columns if c != "reason"]
    usable = F.col("reason").isNull()
    rows = marked.select(*[F.when(usable, to_double(c)).alias(c) if c == col else F.col(c) for c in names],
                         F.when(~usable, F.col(col)).alias(text), F.coalesce("reason", F.lit("clean")).alias("reason"))
    seen = Observation()
    counted = rows.observe(seen, *[F.count_if(F.col("reason") == r).alias(r) for r in ("clean",) + REASONS])
    beside = f"{out_quarantine.rstrip('/')}.writing"
    write_parquet(counted, beside, partition_by=["reason"])
    counts = dict(seen.get)
    replace_path(spark, ensure_folder(spark, f"{beside}/reason=clean"), out_clean)
    replace_path(spark, beside, out_quarantine)
    stored = T.StructType([f for f in rows.schema.fields if f.name != "reason"])
    clean = spark.read.schema(stored).parquet(out_clean).drop(text)
    quarantine = spark.read.schema(rows.schema).parquet(out_quarantine)
    return CleanResult(clean, quarantine.select(*[F.col(text).alias(c) if c == col else F.col(c) for c in names], "reason"), counts)


def merge_parts_job(spark: SparkSession, part_paths: list[str], out_path: str) -> DataFrame:
    """The processed parts that exist -> one combined Parquet table."""
    write_parquet(read_existing_parquet(spark, part_paths), out_path)
    return spark.read.parquet(out_path)


def clean_part_job(spark: SparkSession, in_csv: str, out_parquet: str, target: str = "price") -> DataFrame:
    """one CSV part, all text -> target to double (bad text NULL) -> drop
    rows without a target -> Parquet."""
    df = read_csv(spark, in_csv)
    write_parquet(drop_target_null(cast_target(df, target), target), out_parquet)
    return spark.read.parquet(out_parquet)


def csv_to_parquet_job(spark: SparkSession, csv_path: str, parquet_path: str,
                       schema: T.StructType | None = None, infer_schema: bool = True) -> DataFrame:
    """K8: CSV (explicit schema, inferred, or all text) -> Parquet directory.
    Returns the written table."""
    df = read_csv(spark, csv_path, schema=schema, infer_schema=infer_schema and schema is None)
    write_parquet(df, parquet_path)
    return spark.read.parquet(parquet_path)


def load_and_repartition(spark: SparkSession, input_path: str, output_path: str,
                         num_partitions: int | None = None, view: str = "combined") -> DataFrame:
    """S8 + L1 + K1: Parquet -> SQL view -> round-robin repartition -> Parquet."""
    df = sql_view_scan(read_parquet(spark, input_path), view)
    write_parquet(repartition_rows(df, num_partitions), output_path)
    return spark.read.parquet(output_path)
