"""Command-line jobs: one subcommand per data-preparation or modelling job.

    python -m gearbox <job> [options]          (or through spark-submit)

Every job uses the session it finds (``getOrCreate``: under spark-submit the
cluster's), writes its outputs to the given paths and prints one JSON line
with counts, thresholds or metrics.  Jobs:

  split           CSV -> n contiguous parts in file order (part_node<i>.csv folders)
  merge           CSV parts -> one CSV folder (+ a Parquet folder)
  csv-to-parquet  CSV -> Parquet folder
  clean-part      one CSV part: target to double, drop rows without it -> Parquet
  merge-parts     processed Parquet parts that exist -> combined Parquet + split counts
  repartition     Parquet -> SQL view -> round-robin repartition -> Parquet
  find-null       rows with a missing target -> Parquet + CSV folders
  inspect         schema profile + missing-target count of a table
  stream-clean    CSV parts arriving in a folder -> clean + quarantine Parquet, incrementally
  gbt / mlp       train, score and report a model on a listing table
  gbt-cv / mlp-cv grid search with 3-fold cross-validation
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gearbox.operators.clean import missing_rows
from gearbox.operators.layout import contiguous_split_by_file, random_split, steady_file_blocks, union_parts
from gearbox.operators.models import (
    GBT_REFERENCE,
    GBT_REFERENCE_GRID,
    MLP_CV_HIDDEN,
    MLP_LARGE,
    MLP_MEDIUM,
    MLP_REFERENCE_GRID,
    MLP_SMALL,
)
from gearbox.plans.jobs import (
    clean_part_job,
    csv_to_parquet_job,
    load_and_repartition,
    merge_parts_job,
    quarantine_job,
)
from gearbox.plans.training import cv_report, gbt_cv_run, gbt_run, mlp_cv_run, mlp_run, run_report
from gearbox.schema import TARGET
from gearbox.sinks.writers import write_csv, write_parquet
from gearbox.sources.fs import replace_path
from gearbox.sources.readers import read_csv, read_parquet, schema_profile

GBT_PRESETS = {"reference": GBT_REFERENCE}
GBT_GRIDS = {"reference": GBT_REFERENCE_GRID}
MLP_PRESETS = {"large": MLP_LARGE, "medium": MLP_MEDIUM, "small": MLP_SMALL}
MLP_GRIDS = {"reference": MLP_REFERENCE_GRID}


def _emit(obj: dict) -> dict:
    print(json.dumps(obj, default=str), flush=True)
    return obj


def split_csv(spark: SparkSession, a) -> dict:
    """Contiguous split in file order, one ``partitionBy`` write in which every task writes the
    rows of its own blocks, then each ``part=<i>`` folder renamed to ``part_node<i>.csv``.  In every
    written file the rows keep their order."""
    out = a.output.rstrip("/")
    rows = Observation()
    with steady_file_blocks(spark):
        parts = contiguous_split_by_file(read_csv(spark, a.input, infer_schema=a.infer_schema), a.parts, order_col="_place")
        parts = parts.sortWithinPartitions("part", "_place").drop("_place").observe(
            rows, *[F.count_if(F.col("part") == p).alias(str(p)) for p in range(1, a.parts + 1)])
        write_csv(parts, f"{out}/_split", partition_by=["part"])
    counts = {int(p): c for p, c in rows.get.items()}
    sizes = {}
    for p in range(1, a.parts + 1):
        dst = f"{out}/part_node{p}.csv"
        if counts[p]:
            replace_path(spark, f"{out}/_split/part={p}", dst)
        sizes[dst] = counts[p]
    return _emit({"job": "split", "parts": sizes})


def merge_csv_parts(spark: SparkSession, a) -> dict:
    merged = union_parts([read_csv(spark, p, infer_schema=a.infer_schema) for p in a.inputs])
    write_csv(merged, a.output_csv)
    out = {"job": "merge", "rows": spark.read.option("header", True).csv(a.output_csv).count()}
    if a.output_parquet:
        out["parquet"] = write_parquet(read_csv(spark, a.output_csv, infer_schema=a.infer_schema), a.output_parquet)
    return _emit(out)


def load_listing(spark: SparkSession, path: str, part: int | None = None) -> DataFrame:
    df = read_parquet(spark, path)
    return df.where(F.col("part") == part).drop("part") if part is not None else df


def model_gbt(spark, a) -> dict:
    run = gbt_run(load_listing(spark, a.input, a.part), GBT_PRESETS[a.preset])
    report = run_report(spark, run, "GBT price regression")
    if a.report:
        write_parquet(report, a.report)
    if a.predictions:
        write_parquet(run.scored.where(F.col("split") == "test")
                      .select("listing_id", "year", "mileage", "label", "prediction"), a.predictions)
    return _emit({"job": "gbt", "train_seconds": run.fitted.train_seconds,
                  "metrics": [r.asDict() for r in run.metrics.collect()]})


def model_mlp(spark, a) -> dict:
    run = mlp_run(load_listing(spark, a.input, a.part), MLP_PRESETS[a.preset], thresholds_on=a.thresholds_on,
                  scale_numeric=not a.unscaled)
    if a.report:
        write_parquet(run_report(spark, run, "MLP price-band classification"), a.report)
    return _emit({"job": "mlp", "train_seconds": run.fitted.train_seconds, "thresholds": run.thresholds,
                  "metrics": [r.asDict() for r in run.metrics.collect()]})


def _cv_out(spark, a, report, job: str) -> dict:
    if a.output:
        write_parquet(report.table, a.output)
    if a.report:
        write_parquet(cv_report(spark, report, f"{job} on {a.input}"), a.report)
    if a.predictions:
        write_parquet(report.run.scored.where(F.col("split") == "test").select("listing_id", "label", "prediction"), a.predictions)
    return _emit({"job": job, "seconds": report.cv.seconds, "configs": [r.asDict() for r in report.table.collect()],
                  "metrics": [r.asDict() for r in report.run.metrics.collect()]})


def model_gbt_cv(spark, a) -> dict:
    report = gbt_cv_run(load_listing(spark, a.input, a.part), GBT_GRIDS[a.grid], parallelism=a.parallelism)
    return _cv_out(spark, a, report, "gbt-cv")


def model_mlp_cv(spark, a) -> dict:
    preset = {"hidden": MLP_CV_HIDDEN, "maxIter": 100, "blockSize": 128}
    report = mlp_cv_run(load_listing(spark, a.input, a.part), MLP_GRIDS[a.grid], preset, parallelism=a.parallelism)
    return _cv_out(spark, a, report, "mlp-cv")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gearbox", description=__doc__.split("\n\n")[0])
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets its own")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("split")
    s.add_argument("input"), s.add_argument("output"), s.add_argument("--parts", type=int, default=3)
    s.add_argument("--infer-schema", action="store_true")

    s = sub.add_parser("merge")
    s.add_argument("inputs", nargs="+"), s.add_argument("--output-csv", required=True)
    s.add_argument("--output-parquet")
    s.add_argument("--infer-schema", action="store_true")

    s = sub.add_parser("csv-to-parquet")
    s.add_argument("input"), s.add_argument("output")
    s.add_argument("--no-infer", action="store_true")

    s = sub.add_parser("clean-part")
    s.add_argument("input"), s.add_argument("output"), s.add_argument("--target", default=TARGET)

    s = sub.add_parser("merge-parts")
    s.add_argument("inputs", nargs="+"), s.add_argument("--output", required=True)

    s = sub.add_parser("repartition")
    s.add_argument("input"), s.add_argument("output"), s.add_argument("--partitions", type=int)

    s = sub.add_parser("find-null")
    s.add_argument("--input-parquet", required=True), s.add_argument("--input-csv", required=True)
    s.add_argument("--out-parquet", required=True), s.add_argument("--out-csv", required=True)
    s.add_argument("--target", default=TARGET)

    s = sub.add_parser("inspect")
    s.add_argument("input"), s.add_argument("--target", default=TARGET)

    s = sub.add_parser("stream-clean")
    s.add_argument("input_dir"), s.add_argument("--clean-dir", required=True)
    s.add_argument("--quarantine-dir", required=True), s.add_argument("--checkpoint", required=True)
    s.add_argument("--schema", required=True, help='DDL, e.g. "listing_id string, price string"')
    s.add_argument("--target", default=TARGET)
    s.add_argument("--processing-time", help="run as a service with this trigger interval, e.g. '1 minute'")
    s.add_argument("--max-files-per-trigger", type=int)

    for name, presets in (("gbt", GBT_PRESETS), ("mlp", MLP_PRESETS)):
        s = sub.add_parser(name)
        s.add_argument("input"), s.add_argument("--part", type=int)
        s.add_argument("--preset", choices=sorted(presets), default="reference" if name == "gbt" else "large")
        s.add_argument("--report"), s.add_argument("--predictions")
        if name == "mlp":
            s.add_argument("--thresholds-on", choices=["train", "all"], default="train")
            s.add_argument("--unscaled", action="store_true")
    for name, grids in (("gbt-cv", GBT_GRIDS), ("mlp-cv", MLP_GRIDS)):
        s = sub.add_parser(name)
        s.add_argument("input"), s.add_argument("--part", type=int), s.add_argument("--output")
        s.add_argument("--report"), s.add_argument("--predictions")
        s.add_argument("--grid", choices=sorted(grids), default="reference")
        s.add_argument("--parallelism", type=int, default=2)
    return p


def run(spark: SparkSession, a) -> dict:
    job = a.job
    if job == "split":
        return split_csv(spark, a)
    if job == "merge":
        return merge_csv_parts(spark, a)
    if job == "csv-to-parquet":
        df = csv_to_parquet_job(spark, a.input, a.output, infer_schema=not a.no_infer)
        return _emit({"job": job, "rows": df.count(), "columns": df.columns})
    if job == "clean-part":
        return _emit({"job": job, "rows": clean_part_job(spark, a.input, a.output, a.target).count()})
    if job == "merge-parts":
        merged = merge_parts_job(spark, a.inputs, a.output)
        split = random_split(merged.select(F.lit(1).alias("one")))
        counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
        return _emit({"job": job, "rows": merged.count(), "split_counts": counts})
    if job == "repartition":
        df = load_and_repartition(spark, a.input, a.output, a.partitions)
        return _emit({"job": job, "rows": df.count()})
    if job == "find-null":
        res = quarantine_job(spark, a.input_parquet, a.input_csv, a.out_parquet, a.out_csv, a.target)
        return _emit({"job": job, "missing": res.count})
    if job == "inspect":
        df = read_parquet(spark, a.input)
        prof = [r.asDict() for r in schema_profile(df).orderBy("position").collect()]
        return _emit({"job": job, "schema": prof, "missing_target": missing_rows(df, a.target).count()})
    if job == "stream-clean":
        from pyspark.sql.types import StructType
        from gearbox.streaming.parts import clean_parts_stream
        schema = StructType.fromDDL(a.schema) if hasattr(StructType, "fromDDL") else spark.createDataFrame(
            [], a.schema).schema
        q = clean_parts_stream(spark, a.input_dir, a.clean_dir, a.quarantine_dir, schema, a.checkpoint,
                               a.target, processing_time=a.processing_time,
                               max_files_per_trigger=a.max_files_per_trigger)
        q.awaitTermination()
        progress = q.lastProgress or {}
        return _emit({"job": job, "batch": progress.get("batchId"), "rows_last_batch": progress.get("numInputRows")})
    return {"gbt": model_gbt, "mlp": model_mlp, "gbt-cv": model_gbt_cv, "mlp-cv": model_mlp_cv}[job](spark, a)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    # batch jobs: no web UI server
    builder = (SparkSession.builder.appName(f"gearbox-{a.job}").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if a.master:
        builder = builder.master(a.master)
    spark = builder.getOrCreate()
    run(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())

