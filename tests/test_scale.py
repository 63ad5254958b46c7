"""Partitions follow the size of the table: a small advisory size stands for a large table."""

import os
import time

import pytest

import __spark_entry__ as E
from settings import SF_SMALL
from gearbox.operators import boosting
from gearbox.plans import queries_io
from gearbox.plans.training import gbt_run
from gearbox.sources import fixtures

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
NUMBER, MERGE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"


@pytest.fixture
def small_partitions(spark):
    before = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, "64k")
    yield
    spark.conf.set(ADVISORY, before)


def test_rebalance_has_more_partitions_for_more_rows(spark, small_partitions):
    df = E.queries()["rebalance_content"](spark, SF_SMALL)
    assert df.rdd.getNumPartitions() > 4 and df.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_a_stream_of_more_rows_has_more_files_in_the_same_three_batches(spark, small_partitions, monkeypatch):
    seen = []
    write, clean = queries_io.write_csv, queries_io.clean_parts_stream
    monkeypatch.setattr(queries_io, "write_csv", lambda df, path: seen.append(df.rdd.getNumPartitions()) or write(df, path))
    monkeypatch.setattr(queries_io, "clean_parts_stream", lambda *a, **k: seen.append(clean(*a, **k)) or seen[-1])
    rows = E.queries()["stream_clean_parts"](spark, SF_SMALL)
    parts, stream = seen
    assert parts > 3 and parts % 3 == 0
    assert len({p["batchId"] for p in stream.recentProgress if p["numInputRows"]}) == 3
    assert rows.count() == fixtures.listings_raw(spark, SF_SMALL).selectExpr("count(try_cast(price as double))").first()[0]


def test_listings_are_joined_in_partitions_of_their_size(spark, small_partitions, monkeypatch):
    before, seen = {n: spark.conf.get(n) for n in (NUMBER, MERGE)}, []
    build = fixtures.listings
    monkeypatch.setattr(fixtures, "listings", lambda s, d: seen.append((int(s.conf.get(NUMBER)), s.conf.get(MERGE))) or build(s, d))
    monkeypatch.setattr(fixtures, "_MATERIALISED", {})
    n = fixtures.listings_table(spark, SF_SMALL).count()
    assert seen == [(-(-n * fixtures.SORTED_ROW_BYTES // (64 << 10)), "false")]
    assert {n: spark.conf.get(n) for n in (NUMBER, MERGE)} == before


def test_boosted_trees_keep_blocks_on_disk_and_no_encoded_rows(spark, small_partitions, monkeypatch):
    def kept():
        return {int(i): r.getStorageLevel().useMemory() for i, r in dict(spark.sparkContext._jsc.getPersistentRDDs()).items()}

    before, seen, grow = kept(), [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda *a: (grow(*a), seen.append([m for i, m in kept().items() if i not in before]))[0])
    spark.conf.set(ADVISORY, "4k")
    run = gbt_run(fixtures.listings_table(spark, SF_SMALL), {"maxIter": 2, "maxDepth": 2})
    assert seen == [[False], [False]]  # the blocks alone
    train = run.data.where("split = 'train'").count()
    assert run.fitted.train_partitions == -(-train * 64 // (4 << 10)) > spark.sparkContext.defaultParallelism
    assert run.scored.where("prediction is null").count() == 0
    assert not [i for i in kept() if i not in before]


def test_listings_leave_no_shuffle_files_beside_the_csv(spark, monkeypatch):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        sizes = {}
        for path in (os.path.join(d, f) for top in folders for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")):
            if os.path.exists(path):  # older ones may go meanwhile
                sizes[path] = os.path.getsize(path)
        return sizes

    monkeypatch.setattr(fixtures, "_MATERIALISED", {})
    clean_up = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before, seen, build = spark.conf.get(clean_up), shuffled(), [], fixtures.listings
    monkeypatch.setattr(fixtures, "listings", lambda s, d: seen.append(s.conf.get(clean_up)) or build(s, d))
    spark.conf.set(clean_up, "false")
    try:
        n, until = fixtures.listings_table(spark, SF_SMALL).count(), time.time() + 20

        def left():
            return sum(size for f, size in shuffled().items() if f not in before)

        while left() > 10 * n and time.time() < until:  # Spark deletes them on the side
            time.sleep(0.2)
        assert left() <= 10 * n  # a collection of garbage deletes them too, so also:
        assert seen == ["true"] and spark.conf.get(clean_up) == "false"
    finally:
        spark.conf.set(clean_up, setting)
    files = []
    write = queries_io.write_csv
    monkeypatch.setattr(queries_io, "write_csv", lambda df, path, **k: files.append(write(df, path, **k)) or path)
    assert E.queries()["csv_typed_roundtrip"](spark, SF_SMALL).count() == n
    sizes = [os.path.getsize(os.path.join(files[0].removeprefix("file:"), f)) for f in os.listdir(files[0].removeprefix("file:")) if f.startswith("part-")]
    assert sum(sizes) < 100 * n  # 150 bytes a row as plain text
