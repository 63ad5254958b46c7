"""CSV records with line breaks, read by several tasks."""

import csv
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gearbox.operators.layout import steady_file_blocks
from gearbox.sinks.writers import write_csv
from gearbox.sources.quoted_csv import read_quoted_csv
from gearbox.sources.readers import read_csv

SCHEMA = "i long, t string, x double, u string"


def rows_of(df):
    return sorted(((r["i"], r["t"], r["x"], r["u"]) for r in df.collect()), key=repr)


def texts(seed, n, parts=("a", "bc d", ",", '"', "\n", "\n\n", " ", "é", "\\n", "x" * 50)):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.fixture
def small_blocks(spark):
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    with steady_file_blocks(spark):
        yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write_rfc(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["i", "t", "x", "u"])
        w.writerows(rows)


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_by_several_tasks(spark, tmp_dir, small_blocks, size, end):
    t, u = texts(1, 300), texts(2, 300)
    rows = [(i, t[i], i / 4, u[i]) for i in range(300)]
    rows[50] = (50, "long\n" * 400, 0.5, "across many blocks")
    path = os.path.join(tmp_dir, f"one{size}{len(end)}.csv")
    write_rfc(path, rows, end)
    small_blocks(size)
    got = read_quoted_csv(spark, path, spark.createDataFrame([], SCHEMA).schema, escape='"')
    if size < 1 << 20:
        assert spark.read.text(path).rdd.getNumPartitions() > 5
    want = [(i, a or None, x, b or None) for i, a, x, b in rows]  # this writer leaves empty text unquoted
    assert rows_of(got) == sorted(want, key=repr)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_what_write_csv_wrote(spark, tmp_dir, small_blocks, broadcast_bytes):
    t = texts(3, 400)
    df = spark.createDataFrame([(i, x if i % 9 else None, float(i), x[::-1]) for i, x in enumerate(t)], SCHEMA).repartition(3)
    path = write_csv(df, os.path.join(tmp_dir, "spark"))
    small_blocks(700)
    got = read_quoted_csv(spark, path, df.schema, block_table_bytes=broadcast_bytes)
    assert rows_of(got) == rows_of(df) == rows_of(read_csv(spark, path, schema=df.schema, multi_line=True))


def test_odd_files(spark, tmp_dir, small_blocks):
    schema = spark.createDataFrame([], SCHEMA).schema
    folder = os.path.join(tmp_dir, "odd")
    os.makedirs(folder)
    for name, content in {"a": "i,t,x,u\n", "b": "", "c": '"i\n2","t\n\nq",x,u\n1,"p\nq",,""\n\n \n2,r,3,s',
                          "d": 'i,t,x,u\n5,"never closed\n6,a,1,b\n'}.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(content)
    small_blocks(4)
    got = rows_of(read_quoted_csv(spark, folder, schema))
    assert [r for r in got if r[0] in (1, 2)] == [(1, "p\nq", None, ""), (2, "r", 3.0, "s")]
    assert [r[0] for r in got if r[0] not in (1, 2)] == [5]
    assert rows_of(read_quoted_csv(spark, os.path.join(folder, "a.csv"), schema)) == []
    with pytest.raises(FileNotFoundError):
        read_quoted_csv(spark, os.path.join(folder, "none"), schema)


def test_no_row_is_moved_without_crossing_records(spark, tmp_dir, small_blocks):
    path = write_csv(spark.range(2000).select(F.col("id").alias("i"), F.lit("a b").alias("t")), os.path.join(tmp_dir, "plain"))
    small_blocks(3000)
    got = read_quoted_csv(spark, path, spark.createDataFrame([], "i long, t string").schema)
    assert "Exchange hash" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.agg(F.sum("i")).first()[0] == 1999 * 1000


def test_other_blocks_raise(spark, tmp_dir, small_blocks):
    path = write_csv(spark.range(500).select(F.col("id").alias("i"), F.lit("a\nb").alias("t")), os.path.join(tmp_dir, "cut"))
    small_blocks(900)
    got = read_quoted_csv(spark, path, spark.createDataFrame([], "i long, t string").schema)
    small_blocks(350)
    with pytest.raises(PySparkException, match="steady_file_blocks"):
        got.select(F.max("i"), F.max("t")).collect()
