"""Evaluation metrics as aggregations, plus a deterministic baseline predictor.

* ``regression_metrics``: rmse, mae, r2 for any number of groups (for example
  train and test) in ONE pass, instead of one scoring job per metric.
* ``classification_metrics``: accuracy and label-weighted precision, recall
  and F1 from the confusion counts (``k*k`` rows per group).  A class that is
  never predicted has precision 0, as in MLlib.
* ``group_mean_model`` / ``predict_group_mean``: mean target per key, the
  trivial model that trained models have to beat.
* ``cv_group_mean``: k-fold cross-validation of a small grid of shrunk
  group means, computed from per-(fold, key) sums: every fold's model is
  "all sums minus this fold's sums", so no data is copied per fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearbox.operators.joins import sized_broadcast
from gearbox.session import shared_dir


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    err = F.col(label) - F.col(prediction)
    g = df.groupBy(*by) if by else df.groupBy()
    stats = g.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(err * err).alias("_sse"),
                  F.sum(F.abs(err)).alias("_sae"),
                  F.var_pop(F.col(label)).alias("_var"))
    return stats.select(
        *by, "n",
        F.round(F.sqrt(F.col("_sse") / F.col("n")), 4).alias("rmse"),
        F.round(F.col("_sae") / F.col("n"), 4).alias("mae"),
        # a constant label leaves nothing to explain: MLlib divides by zero there (-infinity, NaN for no error)
        F.when(F.col("_var") > 0, F.round(F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n")), 6))
        .when(F.col("_sse") > 0, F.lit(float("-inf"))).when(F.col("_sse") == 0, F.lit(float("nan"))).alias("r2"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           by: Sequence[str] = ()) -> DataFrame:
    keys = list(by)
    conf = (df.groupBy(*keys, F.col(label).alias("_l"), F.col(prediction).alias("_p"))
              .agg(F.count(F.lit(1)).alias("_c")))
    actual = conf.groupBy(*keys, "_l").agg(
        F.sum("_c").alias("_actual"),
        F.sum(F.when(F.col("_l") == F.col("_p"), F.col("_c")).otherwise(0)).alias("_tp"))
    predicted = conf.groupBy(*keys, F.col("_p").alias("_l")).agg(F.sum("_c").alias("_pred"))
    per = actual.join(predicted, keys + ["_l"], "left").fillna(0, ["_pred"])
    precision = F.when(F.col("_pred") > 0, F.col("_tp") / F.col("_pred")).otherwise(F.lit(0.0))
    recall = F.col("_tp") / F.col("_actual")
    per = per.select(*keys, "_actual", "_tp", precision.alias("_prec"), recall.alias("_rec"))
    f1 = F.when(F.col("_prec") + F.col("_rec") > 0,
                2 * F.col("_prec") * F.col("_rec") / (F.col("_prec") + F.col("_rec"))).otherwise(F.lit(0.0))
    n = F.sum("_actual")
    g = per.groupBy(*keys) if keys else per.groupBy()
    return g.agg(
        n.alias("n"),
        F.round(F.sum("_tp") / n, 6).alias("accuracy"),
        F.round(F.sum(F.col("_actual") * F.col("_prec")) / n, 6).alias("weighted_precision"),
        F.round(F.sum(F.col("_actual") * F.col("_rec")) / n, 6).alias("weighted_recall"),
        F.round(F.sum(F.col("_actual") * f1) / n, 6).alias("weighted_f1"))


# --------------------------------------------------------------------------- baseline
def group_mean_model(train: DataFrame, key: str, target: str = "price") -> tuple[DataFrame, Column]:
    """Mean target per key (one row per distinct key) and the overall mean as a
    scalar-subquery Column (evaluated once) for keys never seen in training."""
    shared_dir(train.sparkSession)
    # one row per key; materialised once so the model and the overall mean
    # do not each re-read the training rows
    stats = (train.groupBy(key).agg(F.sum(target).alias("_s"), F.count(target).alias("_c"))
             .checkpoint(eager=True))
    # broadcast to the scored rows only when the counted table is small enough
    model = sized_broadcast(stats.select(key, (F.col("_s") / F.col("_c")).alias("_key_mean")))
    # overall mean from the per-key sums (one row per key), not another pass over the rows
    overall = stats.select(F.sum("_s") / F.sum("_c")).scalar()
    return model, overall


def predict_group_mean(df: DataFrame, model: DataFrame, overall: Column, key: str,
                       out: str = "prediction") -> DataFrame:
    return (df.join(model, key, "left")
              .withColumn(out, F.coalesce(F.col("_key_mean"), overall))
              .drop("_key_mean"))


def cv_group_mean(train: DataFrame, keys: Sequence[str], alphas: Sequence[float], fold_col: str = "fold",
                  target: str = "price") -> DataFrame:
    """Per (config, fold) validation RMSE of the shrunk group mean
    ``(sum_k + alpha * m) / (n_k + alpha)``, ``m`` = mean of the training
    folds, for every key column in ``keys`` and shrinkage in ``alphas``.

    Output: ``key_col, alpha, fold, n, rmse``.
    """
    long = train.where(F.col(target).isNotNull()).select(fold_col, target, F.inline(F.array(*[
        F.struct(F.lit(k).alias("key_col"), F.col(k).cast("string").alias("key_value")) for k in keys])))
    shared_dir(train.sparkSession)
    # the only aggregation over the rows: folds x vocabulary rows (a null key is a value like
    # any other).  A prediction is constant within (fold, key), so count, sum and the centred
    # sum of squares give every configuration's error without going back to the rows.
    per_fold_key = (long.groupBy(fold_col, "key_col", "key_value")
                    .agg(F.sum(target).alias("_s"), F.count(F.lit(1)).alias("_c"), F.var_pop(target).alias("_v"))
                    .checkpoint(eager=True))
    # statistics of the training folds for each (held-out fold, key): all folds
    # minus this one; the window groups hold one row per fold (at most k rows)
    same_key = Window.partitionBy("key_col", "key_value")
    # mean of all folds minus this one: totals of the checkpointed table, a row per key column and fold
    totals = per_fold_key.groupBy("key_col", fold_col).agg(F.sum("_s").alias("s"), F.sum("_c").alias("c")).collect()
    m = F.lit(None).cast("double")
    for r in totals:
        others = [t for t in totals if t["key_col"] == r["key_col"] and t[fold_col] != r[fold_col]]
        n = sum(t["c"] for t in others)
        m = F.when((F.col("key_col") == r["key_col"]) & F.col(fold_col).eqNullSafe(F.lit(r[fold_col])),
                   F.lit(float(sum(t["s"] for t in others)) / n if n else None).cast("double")).otherwise(m)
    comp = per_fold_key.select(
        fold_col, "key_col", "_s", "_c", "_v",
        (F.sum("_s").over(same_key) - F.col("_s")).alias("_ks"),
        (F.sum("_c").over(same_key) - F.col("_c")).alias("_kc"), m.alias("_m"))
    mean = F.col("_s") / F.col("_c")
    sq = []
    for a in alphas:
        pred = F.when(F.col("_kc") + F.lit(a) > 0, F.try_divide(
            F.col("_ks") + F.lit(a) * F.col("_m"), F.col("_kc") + F.lit(a))).otherwise(F.col("_m"))
        sq.append(F.sum(F.col("_c") * (F.col("_v") + (mean - pred) * (mean - pred))).alias(f"_sse{len(sq)}"))
    agg = comp.groupBy("key_col", fold_col).agg(F.sum("_c").alias("n"), *sq)
    stacked = F.inline(F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.col(f"_sse{i}").alias("_sse"))
                                 for i, a in enumerate(alphas)]))
    return agg.select("key_col", fold_col, "n", stacked).select(
        "key_col", "alpha", fold_col, "n", F.round(F.sqrt(F.col("_sse") / F.col("n")), 4).alias("rmse"))


def fold_average(per_fold: DataFrame, config: Sequence[str], metric: str = "rmse") -> DataFrame:
    """Mean of the per-fold metric for each configuration."""
    return per_fold.groupBy(*config).agg(F.round(F.avg(metric), 4).alias(f"avg_{metric}"),
                                         F.count(F.lit(1)).alias("folds"))
