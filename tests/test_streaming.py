"""The streaming clean job equals the batch clean job and is incremental."""

import os

from pyspark.sql import functions as F

from settings import SF_SMALL
from gearbox.operators.clean import cast_target, drop_target_null
from gearbox.schema import LISTINGS_RAW
from gearbox.sinks.writers import write_csv
from gearbox.sources.fixtures import listings_raw
from gearbox.streaming.parts import clean_parts_stream, read_stream_output


def test_stream_matches_batch_and_picks_up_new_parts(spark, tmp_dir):
    raw = listings_raw(spark, SF_SMALL)
    incoming = os.path.join(tmp_dir, "incoming")
    clean, quarantine, ckpt = (os.path.join(tmp_dir, x) for x in ("clean", "quarantine", "ckpt"))
    write_csv(raw.where(F.col("slot") < 10), os.path.join(incoming, "a"))
    args = (spark, os.path.join(incoming, "*"), clean, quarantine, LISTINGS_RAW)
    clean_parts_stream(*args, ckpt).awaitTermination()
    first = read_stream_output(spark, clean).count()
    write_csv(raw.where(F.col("slot") >= 10), os.path.join(incoming, "b"))
    q = clean_parts_stream(*args, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.lastProgress is not None
    got = read_stream_output(spark, clean)
    batches = spark.read.parquet(clean).select("batch_id").distinct().count()
    assert batches >= 2
    expect = drop_target_null(cast_target(raw))
    assert got.count() == expect.count() > first > 0
    assert got.exceptAll(expect).count() == 0
    assert read_stream_output(spark, quarantine).count() + got.count() == raw.count()  # no row is lost
