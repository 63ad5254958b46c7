"""Scans: Parquet (file, directory, several paths, one part), CSV (typed or
all-text), first-available source, SQL view.

Readers take explicit schemas wherever the data has one, so a CSV scan never
needs the extra inference pass and types do not drift with the writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.sources.fs import path_exists, require_path

NO_TOKEN = "\u0001"  # a nullValue no real field contains


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows ``(position, column_name, data_type, nullable)``
    (from the plan's schema: no job runs; bounded by the column count)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def schema_profile(df: DataFrame) -> DataFrame:
    """P8 + A1: the schema rows plus ``non_null`` values per column, counted
    for all columns in ONE aggregation and unpivoted (one row per column)."""
    counts = df.agg(*[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    long = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("non_null"))
        for i, c in enumerate(df.columns)])))
    return schema_table(df).join(long, "column_name")


FOOTER_RANGES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's that answers counts and ranges of Parquet files from their footers."""
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A1 from Parquet footers: ``(column_name, non_null, min_value, max_value)`` of the flat columns,
    ranges (as doubles) for numbers.  No column chunk is read: the aggregates are pushed down into the
    scan, one footer a file.  Where a footer lacks what is asked (a row group of nulls alone has no range, some writers
    leave statistics out), these counts or these ranges are worked out from the columns instead.
    """
    footers = footer_session(spark)
    table = read_parquet(spark, path, columns)
    flat = [f for f in table.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    numbers = [f.name for f in flat if isinstance(f.dataType, FOOTER_RANGES)]
    asked = {"count": ([f.name for f in flat], [F.count]), "range": (numbers, [F.min, F.max])}
    found: dict[str, dict[str, tuple]] = {}
    for kind, (names, functions) in asked.items():
        aggs = [fn(F.col(f"`{c}`")) for c in names for fn in functions]
        if not aggs:
            found[kind] = {}
            continue
        try:
            row = read_parquet(footers, path, columns).agg(*aggs).first()
        except Py4JJavaError as e:
            if "spark.sql.parquet.aggregatePushdown" not in str(e):
                raise
            row = table.agg(*aggs).first()
        k = len(functions)
        found[kind] = {c: tuple(row[i * k:(i + 1) * k]) for i, c in enumerate(names)}

    def number(v) -> float | None:
        return None if v is None else float(v)

    rows = [(c, *n, *[number(v) for v in found["range"].get(c, (None, None))]) for c, n in found["count"].items()]
    return spark.createDataFrame(rows, "column_name string, non_null long, min_value double, max_value double")


def require_schema(df: DataFrame, expected: T.StructType, check_nullable: bool = False) -> DataFrame:
    """Assert the columns, order and types of ``df`` on read; ``ValueError`` lists the differences."""
    def norm(fs):
        return [(f.name, f.dataType.simpleString()) + ((f.nullable,) if check_nullable else ()) for f in fs]
    got, want = norm(df.schema.fields), norm(expected.fields)
    if got != want:
        diff = [f"{g} != {w}" for g, w in zip(got, want) if g != w]
        if len(got) != len(want):
            diff.append(f"{len(got)} columns, expected {len(want)}")
        raise ValueError("schema mismatch: " + "; ".join(diff))
    return df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet file or directory (or one part by its URI).

    ``columns`` projects at the scan, so only those columns are read.
    """
    df = spark.read.parquet(require_path(spark, path, "Parquet input"))
    return df.select(*columns) if columns else df


def read_part(spark: SparkSession, table_path: str, part: int, part_col: str = "part") -> DataFrame:
    """S2 on a ``partitionBy(part_col)`` layout: the filter prunes to one folder."""
    from pyspark.sql import functions as F
    return read_parquet(spark, table_path).where(F.col(part_col) == F.lit(part))


def read_existing_parquet(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union of the Parquet paths that exist; error if none does."""
    existing = [p for p in paths if path_exists(spark, p)]
    if not existing:
        raise FileNotFoundError(f"None of the Parquet inputs exist: {list(paths)}")
    return spark.read.parquet(*existing)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             infer_schema: bool = False, null_value: str | None = None,
             null_tokens: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header line.

    * ``schema`` given: typed read, no inference pass (the scalable mode).
    * ``infer_schema=True``: Spark samples the data for types (extra pass).
    * neither: every column is text (the per-part clean job's mode).

    Empty fields read as NULL; quoted empty strings stay empty strings, and
    leading/trailing spaces are kept, so blank values survive a round trip.
    ``multi_line`` reads fields with line breaks (such files are not split: one
    task reads a whole file; ``quoted_csv.read_quoted_csv`` splits them).  ``null_value`` adds a token (for example ``"NA"``) that reads as NULL.
    ``null_tokens`` (several tokens, like pandas' ``NA``/``None``/``n/a``
    defaults): fields equal to any token become NULL in every column; with
    a ``schema`` the columns are read as text first and then converted with
    ``try_cast``, so a token never fails a numeric column.
    """
    if null_tokens:
        text = read_csv(spark, path, schema=_as_text(schema) if schema is not None else None, multi_line=multi_line)
        tokens = list(null_tokens)
        cleaned = text.select(*[F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c)).alias(c)
                                for c in text.columns])
        if schema is None:
            return cleaned
        return cleaned.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    paths = [path] if isinstance(path, str) else list(path)
    for p in paths:
        require_path(spark, p, "CSV input")
    # An empty unquoted field reads as NULL; a quoted empty field stays "".
    # (With the default nullValue "" Spark would turn both into NULL.)
    reader = (spark.read.option("header", True)
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False)
              .option("emptyValue", "")
              .option("multiLine", multi_line)
              .option("nullValue", null_value if null_value is not None else NO_TOKEN))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(paths)


def read_first_available(spark: SparkSession, parquet_path: str, csv_path: str,
                         csv_schema: T.StructType | None = None) -> DataFrame:
    """The Parquet copy if it exists, else the CSV, else ``FileNotFoundError``."""
    if path_exists(spark, parquet_path):
        return spark.read.parquet(parquet_path)
    if path_exists(spark, csv_path):
        return read_csv(spark, csv_path, schema=csv_schema, infer_schema=csv_schema is None)
    raise FileNotFoundError(f"Neither {parquet_path} nor {csv_path} exists")


def sql_view_scan(df: DataFrame, view: str = "combined") -> DataFrame:
    """Register ``df`` as a temp view and scan it with SQL."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT * FROM {view}")

