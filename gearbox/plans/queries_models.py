"""Registered model queries, at the original settings (``GBT_REFERENCE``,
``MLP_LARGE``, the presets and the grids of ``gearbox.operators.models``).

A trained model has no SQL form, so the oracles check what is exact about a
run: the test rows and their labels, the configurations, and that the model
beats the group mean that SQL computes too.  A fitted run is kept per session,
input folder and state of its files, so queries that only read a fitted model do
not fit it again.

The GBT grid search at its original grid (24 fits, up to 30 trees of depth 15)
takes longer than a check run allows; it is a command-line job (``gbt-cv``) and is
tested at small settings, not registered here with a smaller grid.
"""

from __future__ import annotations

from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearbox.operators.metrics import classification_metrics, group_mean_model, predict_group_mean, regression_metrics
from gearbox.operators.models import (
    GBT_REFERENCE,
    MLP_CV_HIDDEN,
    MLP_LARGE,
    MLP_MEDIUM,
    MLP_REFERENCE_GRID,
    MLP_SMALL,
    importances,
)
from gearbox.plans.registry import NOT_NULL_LISTINGS, register, sql
from gearbox.plans.training import cv_report, gbt_run, mlp_cv_run, mlp_run, mlp_runs, run_report
from gearbox.schema import GBT_CATEGORICALS, KEY, MLP_CATEGORICALS, NUMERIC_FEATURES
from gearbox.sources.fixtures import listings_table, source_state

CV_PARALLELISM = 6  # fits at a time: 3 folds x 2 block sizes, each along the iterations

_RUNS: dict[tuple, object] = {}


def _cached(spark, sf_dir, kind, build):
    key = (spark.sparkContext.applicationId, sf_dir, source_state(spark, sf_dir), kind)
    if key not in _RUNS:
        _RUNS[key] = build()
    return _RUNS[key]


def _gbt(spark, sf_dir):
    return _cached(spark, sf_dir, "gbt", lambda: gbt_run(listings_table(spark, sf_dir), GBT_REFERENCE))


def _mlp(spark, sf_dir):
    return _cached(spark, sf_dir, "mlp", lambda: mlp_run(listings_table(spark, sf_dir), MLP_LARGE))


def _mlp_cv(spark, sf_dir):
    preset = {"hidden": MLP_CV_HIDDEN, "maxIter": 100, "blockSize": 128}
    return _cached(spark, sf_dir, "mlp_cv", lambda: mlp_cv_run(listings_table(spark, sf_dir), MLP_REFERENCE_GRID, preset,
                                                               parallelism=CV_PARALLELISM, path="maxIter"))


def _beats_group_mean(run, key: str = "engine_hp") -> bool:
    """Whether the run's test error is below that of the train mean price per ``key``
    (for bands: its test accuracy above that of the banded mean)."""
    if run.thresholds is None:
        train = run.data.where(F.col("split") == "train").withColumnRenamed("label", "price")
        model, overall = group_mean_model(train, key)
        base = regression_metrics(predict_group_mean(run.data, model, overall, key).where(F.col("split") == "test")).first()
        mine = regression_metrics(run.scored.where(F.col("split") == "test")).first()
        return mine["rmse"] < base["rmse"]
    # the bands' own baseline: the most frequent band of the training rows per key
    train = run.data.where(F.col("split") == "train").groupBy(key, "label").agg(F.count(F.lit(1)).alias("c"))
    mode = train.groupBy(key).agg(F.max_by("label", F.struct("c", "label")).alias("prediction"))
    base = classification_metrics(run.data.where(F.col("split") == "test").join(mode, key, "left")).first()
    mine = classification_metrics(run.scored.where(F.col("split") == "test")).first()
    return mine["accuracy"] > base["accuracy"]


TEST_ROWS = f"from keyed where split = 'test' and {NOT_NULL_LISTINGS}"
TRAIN_BANDS = f"""
with tt as (
  select min(price) filter (where rn * 100 >= 33 * n) as lo, min(price) filter (where rn * 100 >= 67 * n) as hi
  from (select price, row_number() over (order by price) as rn, count(*) over () as n
        from keyed where split = 'train' and {NOT_NULL_LISTINGS}))"""


def _with_flag(rows: DataFrame, beats: bool) -> DataFrame:
    return rows.withColumn("beats_group_mean", F.lit(bool(beats)))


@register("gbt_regression", ("M1", "E6", "E7", "P4"), sql(
    f"select listing_id, price as label, true as predicted, true as beats_group_mean {TEST_ROWS}", "listings", "keyed"))
def q_gbt_regression(spark, sf_dir):
    run = _gbt(spark, sf_dir)
    rows = run.scored.where(F.col("split") == "test").select(KEY, "label", F.col("prediction").isNotNull().alias("predicted"))
    return _with_flag(rows, _beats_group_mean(run))


@register("mlp_classifier", ("M2", "E5", "D6"), sql(TRAIN_BANDS + f"""
select listing_id, cast(case when price >= hi then 2 when price >= lo then 1 else 0 end as double) as label,
  true as predicted, true as beats_group_mean
from keyed, tt where split = 'test' and {NOT_NULL_LISTINGS}""", "listings", "keyed"))
def q_mlp_classifier(spark, sf_dir):
    run = _mlp(spark, sf_dir)
    rows = run.scored.where(F.col("split") == "test").select(KEY, "label", F.col("prediction").isin(0.0, 1.0, 2.0).alias("predicted"))
    return _with_flag(rows, _beats_group_mean(run))


@register("feature_importance", ("M7", "T3"), " union all ".join(
    f"select '{c}' as feature, {str(c == 'engine_hp').lower()} as top, true as sums_to_one, true as in_range"
    for c in NUMERIC_FEATURES + GBT_CATEGORICALS))
def q_feature_importance(spark, sf_dir):
    """One row per source column; the planted main driver of the price comes first."""
    run = _gbt(spark, sf_dir)
    table = importances(spark, run.fitted, run.data)
    total = table.agg(F.sum("importance")).first()[0]
    return table.select("feature", (F.col("rank") == 1).alias("top"), F.lit(abs(total - 1) < 1e-4).alias("sums_to_one"),
                        F.col("importance").between(0, 1).alias("in_range"))


@register("batch_scoring", ("M9", "P1"), sql(
    f"select listing_id, split, year, mileage, price as label, true as scored from keyed where {NOT_NULL_LISTINGS}", "listings", "keyed"))
def q_batch_scoring(spark, sf_dir):
    """A fitted model applied to all prepared rows, training rows included."""
    run = _gbt(spark, sf_dir)
    return run.scored.select(KEY, "split", "year", "mileage", "label", (F.col("prediction") > 0).alias("scored"))


def _configs(report, grid: dict[str, list]) -> DataFrame:
    """The configurations with what must hold for each: three finite fold metrics, ranks
    that follow them, and the best one at the optimum."""
    metric = F.col(f"avg_{report.cv.metric}")
    optimum = (max if report.cv.larger_better else min)(report.cv.averages)
    return report.table.select(
        "config", *grid, "folds", (metric.isNotNull() & ~F.isnan(metric)).alias("measured"),
        ((F.col("rank") == 1) == F.col("best")).alias("ranked"),
        (~F.col("best") | (F.abs(metric - F.lit(round(optimum, 6))) < 1e-9)).alias("best_is_optimum"))


def _grid_sql(grid: dict[str, list]) -> str:
    names = list(grid)
    froms = ", ".join(f"(select unnest({[float(v) for v in grid[n]]})::double as {n}, unnest({list(range(len(grid[n])))}) as p{i})"
                      for i, n in enumerate(names))
    order = ", ".join(f"p{i}" for i in range(len(names)))
    return f"""select cast(row_number() over (order by {order}) as integer) as config, {', '.join(names)}, 3 as folds,
  true as measured, true as ranked, true as best_is_optimum from {froms}"""


@register("mlp_cv", ("M5", "M6", "A7", "L6", "T2", "T4"), _grid_sql(MLP_REFERENCE_GRID))
def q_mlp_cv(spark, sf_dir):
    return _configs(_mlp_cv(spark, sf_dir), MLP_REFERENCE_GRID)


@register("cv_best_on_test", ("M5", "M8", "A5"), sql(f"""
select 'mlp' as model, count(*) as n, true as beats_group_mean
from keyed where split = 'test' and {NOT_NULL_LISTINGS}""", "listings", "keyed"))
def q_cv_best_on_test(spark, sf_dir):
    """The best model of the cross-validation on the held-out test rows."""
    report = _mlp_cv(spark, sf_dir)
    test = {r["split"]: r for r in report.run.metrics.collect()}["test"]
    return spark.createDataFrame([("mlp", test["n"], bool(_beats_group_mean(report.run)))],
                                 "model string, n long, beats_group_mean boolean")


@register("model_comparison", ("T5", "T4", "M3", "A5"), " union all ".join(
    f"select '{n}' as model, '{p['hidden']}' as hidden, {p['maxIter']} as max_iter, true as measured, true as best_is_highest"
    for n, p in (("mlp_small", MLP_SMALL), ("mlp_medium", MLP_MEDIUM))))
def q_model_comparison(spark, sf_dir):
    """The small and medium presets side by side on one encoded training set;
    ``best`` = highest test accuracy."""
    presets = {"mlp_small": MLP_SMALL, "mlp_medium": MLP_MEDIUM}
    runs = _cached(spark, sf_dir, "mlp_presets", lambda: mlp_runs(listings_table(spark, sf_dir), presets))
    accuracy = {n: classification_metrics(r.scored.where(F.col("split") == "test")).first()["accuracy"] for n, r in runs.items()}
    best = max(accuracy, key=accuracy.get)
    rows = []
    for name, run in runs.items():
        model = run.fitted.model.stages[-1]
        rows.append((name, str(list(model.getOrDefault("layers"))[1:-1]), int(model.getOrDefault("maxIter")),
                     0.0 <= accuracy[name] <= 1.0, accuracy[best] >= accuracy[name]))
    return spark.createDataFrame(rows, "model string, hidden string, max_iter int, measured boolean, best_is_highest boolean")


def _report_sql(title: str, categoricals: list[str], config: dict) -> str:
    names = NUMERIC_FEATURES + categoricals
    fixed = [("run", "title", title)] + [("dataset", "input_columns", str(len(names)))] + \
        [("config", k, v) for k, v in config.items()] + [("features", str(i + 1), c) for i, c in enumerate(names)]
    counted = "select 'dataset' as section, 'rows' as item, cast(count(*) as varchar) as value from k union all " \
              "select 'dataset', 'rows_' || split, cast(count(*) as varchar) from k group by split"
    return f"with k as (select * from keyed where {NOT_NULL_LISTINGS}) " + counted + "".join(
        f" union all select '{s}', '{i}', '{v}'" for s, i, v in fixed)


def _exact(report: DataFrame, config: list[str]) -> DataFrame:
    """The rows of a report that do not depend on the fitted weights."""
    return report.where(((F.col("section") == "run") & (F.col("item") == "title")) | (F.col("section") == "features")
                        | ((F.col("section") == "dataset") & (F.col("item").startswith("rows") | (F.col("item") == "input_columns")))
                        | ((F.col("section") == "config") & F.col("item").isin(config)))


GBT_CONFIG = {"maxIter": str(GBT_REFERENCE["maxIter"]), "maxDepth": str(GBT_REFERENCE["maxDepth"]),
              "subsamplingRate": str(GBT_REFERENCE["subsamplingRate"])}
MLP_CONFIG = {"maxIter": str(MLP_LARGE["maxIter"]), "blockSize": str(MLP_LARGE["blockSize"]), "solver": "l-bfgs"}


@register("run_report", ("K7", "L4"), sql(_report_sql("GBT price regression", GBT_CATEGORICALS, GBT_CONFIG), "listings", "keyed"))
def q_run_report(spark, sf_dir):
    return _exact(run_report(spark, _gbt(spark, sf_dir), "GBT price regression"), list(GBT_CONFIG))


@register("mlp_run_report", ("K7", "M2"), sql(_report_sql("MLP price bands", MLP_CATEGORICALS, MLP_CONFIG), "listings", "keyed"))
def q_mlp_run_report(spark, sf_dir):
    return _exact(run_report(spark, _mlp(spark, sf_dir), "MLP price bands"), list(MLP_CONFIG))


@register("cv_report", ("K7", "M5", "M6", "T2"), " union all ".join(
    f"select 'grid' as section, '{k}' as item, '{v}' as value"
    for k, v in [(n, ", ".join(str(x) for x in sorted(vs))) for n, vs in MLP_REFERENCE_GRID.items()]
    + [("configurations", str(prod(len(v) for v in MLP_REFERENCE_GRID.values()))), ("folds", "3")]))
def q_cv_report(spark, sf_dir):
    return cv_report(spark, _mlp_cv(spark, sf_dir), "MLP cross-validation").where(F.col("section") == "grid")
