"""Splits, walk-forward folds, fold membership and regression metrics
(M4, W15, J8, A9, A10, M5-M8, K9, K10)."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any, Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.expr import epoch_us, sign
from ..session import Scratch
from ..sinks.audit import append_run, run_record
from .intervals import day_of, join_points

DAY_US = 86_400_000_000
SHARPE_EPS = 1e-12  # fixed value: volatility below this gives a Sharpe ratio of 0
METRICS = ["rmse", "mae", "mse", "r2", "directional_accuracy", "avg_strategy_return",
           "strategy_volatility", "strategy_sharpe"]


def _ts(v) -> Column:
    return F.lit(str(v)).cast("timestamp_ntz")


# --------------------------------------------------------------------------
# M4 named split
# --------------------------------------------------------------------------
def split_rows(df: DataFrame, split_name: str, split_cfg: Mapping[str, Any],
               timestamp_column: str = "timestamp") -> DataFrame:
    """Rows tagged role = 'train' / 'validation' by inclusive bounds (midnight
    bounds, Q16); a row in both ranges appears in both roles."""
    ts = F.col(timestamp_column)
    train = df.where(ts.between(_ts(split_cfg["train_start"]), _ts(split_cfg["train_end"])))
    val = df.where(ts.between(_ts(split_cfg["validation_start"]), _ts(split_cfg["validation_end"])))
    return (train.withColumn("role", F.lit("train"))
                 .unionByName(val.withColumn("role", F.lit("validation")))
                 .withColumn("split", F.lit(split_name)))


def require_both_roles(tagged: DataFrame, split_name: str) -> None:
    """ValueError when a split leaves training or validation without rows."""
    there = {r["role"] for r in tagged.select("role").distinct().collect()}
    if len(there) < 2:
        raise ValueError(f"split {split_name!r} has rows for {sorted(there) or 'no role'} only; check its dates")


# --------------------------------------------------------------------------
# W15 walk-forward folds
# --------------------------------------------------------------------------
def generate_folds(df: DataFrame, window_cfg: Mapping[str, Any],
                   timestamp_column: str = "timestamp") -> DataFrame:
    """(window, fold, train_start, train_end, validation_start, validation_end)
    in calendar days (Q10): start = max(min_train_date, first timestamp);
    folds step by ``step_days`` while validation_end <= last timestamp."""
    name = window_cfg.get("name", "rolling_window")
    train_days = int(window_cfg["training_days"])
    val_days = int(window_cfg["validation_days"])
    step = int(window_cfg.get("step_days", val_days))
    if step < 1:
        raise ValueError("step_days must be at least 1")
    b = df.agg(F.min(timestamp_column).alias("_first"), F.max(timestamp_column).alias("_last"))
    start = F.col("_first")
    if window_cfg.get("min_train_date") is not None:
        start = F.greatest(_ts(window_cfg["min_train_date"]), F.col("_first"))
    b = b.withColumn("_start", start)
    # last fold i satisfies start + (i*step + train + val - 1) days <= last
    span = epoch_us("_last") - epoch_us("_start") - F.lit((train_days + val_days - 1) * DAY_US)
    b = b.withColumn("_n", F.when(span >= 0, F.floor(span / F.lit(step * DAY_US)) + 1).otherwise(F.lit(0)))
    folds = b.where(F.col("_n") > 0).withColumn("fold", F.explode(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int"))))
    day = lambda n: F.make_dt_interval(F.lit(n) if isinstance(n, int) else n)
    ts0 = F.col("_start") + day(F.col("fold") * step)
    return folds.select(
        F.lit(name).alias("window"), "fold",
        ts0.alias("train_start"),
        (ts0 + day(train_days - 1)).alias("train_end"),
        (ts0 + day(train_days)).alias("validation_start"),
        (ts0 + day(train_days + val_days - 1)).alias("validation_end"))


def fold_rows(df: DataFrame, folds: DataFrame, timestamp_column: str = "timestamp") -> DataFrame:
    """Every row with each (window, fold, role) whose range contains it.

    Folds are cut into dyadic segments of days (``intervals``: a few rows per fold, however
    long), joined to the rows on (level, segment), and the exact inclusive bounds are applied
    as a residual. No nested-loop join."""
    def ranges(lo: str, hi: str, role: str) -> DataFrame:
        return folds.select("window", "fold", F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), F.lit(role).alias("role"))
    fd = ranges("train_start", "train_end", "train").unionByName(
        ranges("validation_start", "validation_end", "validation"))
    ts = F.col(timestamp_column)
    return (join_points(df, day_of(timestamp_column), fd, day_of("_lo"), day_of("_hi"))
            .where((ts >= F.col("_lo")) & (ts <= F.col("_hi"))).drop("_lo", "_hi"))


# --------------------------------------------------------------------------
# A9 / A10 metrics
# --------------------------------------------------------------------------
def regression_metrics(df: DataFrame, y_true: str, y_pred: str, group_by: Sequence[str] = ()) -> DataFrame:
    """One aggregate: mse, rmse, mae, r2 (SST = 0 -> 1.0 if SSE = 0 else 0.0),
    directional accuracy, and the sign strategy's mean, volatility (ddof 1,
    0 for one row) and Sharpe (0 when volatility <= 1e-12)."""
    y, p = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    e = p - y
    sy, sp = sign(y), sign(p)
    hit = F.when(F.isnan(sy) | F.isnan(sp), F.lit(0.0)).otherwise((sy == sp).cast("double"))
    strat = sp * y
    agg = df.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"),
        F.avg(hit).alias("directional_accuracy"),
        F.avg(strat).alias("avg_strategy_return"),
        F.stddev_samp(strat).alias("_vol"))
    vol = F.when(F.col("n") > 1, F.coalesce(F.col("_vol"), F.lit(0.0))).otherwise(F.lit(0.0))
    return agg.select(
        *group_by, "n", F.sqrt("mse").alias("rmse"), "mae", "mse",
        F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
         .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"),
        "directional_accuracy", "avg_strategy_return",
        vol.alias("strategy_volatility"),
        F.when(vol > SHARPE_EPS, F.col("avg_strategy_return") / vol).otherwise(F.lit(0.0)).alias("strategy_sharpe"))


def trained_folds(df: DataFrame, folds: DataFrame, timestamp_column: str = "timestamp") -> DataFrame:
    """(window, fold) of the folds that have training rows: found by instants, as a row lies in many folds."""
    instants = df.select(timestamp_column).distinct()
    return fold_rows(instants, folds, timestamp_column).where(F.col("role") == "train").select("window", "fold").distinct()


def cv_metrics_from_folds(tagged: DataFrame, y_true: str, y_pred: str, trained: DataFrame | None = None) -> DataFrame:
    """A10: metrics per (window, fold) on validation rows of folds whose
    train and validation sides are both non-empty, then the mean per window,
    keyed ``cv_{window}_{metric}``. Windows without a valid fold vanish. ``trained``
    (``trained_folds``) spares the pass over the training rows."""
    each = regression_metrics(tagged, y_true, y_pred, ["window", "fold", "role"])
    if trained is None:
        trained = each.where(F.col("role") == "train").select("window", "fold")
    return _mean_per_window(each.where(F.col("role") == "validation").join(trained, ["window", "fold"], "left_semi"))


def _mean_per_window(per_fold: DataFrame) -> DataFrame:
    means = per_fold.groupBy("window").agg(*[F.avg(m).alias(m) for m in METRICS])
    long = means.unpivot(["window"], METRICS, "metric", "value")
    return long.select(F.concat(F.lit("cv_"), F.col("window"), F.lit("_"), F.col("metric")).alias("key"), "value")


def mean_fold_metrics(val: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Metrics per (window, fold) of validation rows, averaged per window."""
    return _mean_per_window(regression_metrics(val, y_true, y_pred, ["window", "fold"]))


# --------------------------------------------------------------------------
# M5-M8 models (MLlib; one distributed fit per fold)
# --------------------------------------------------------------------------
def gbt_regressor(features: Sequence[str], target: str, seed: int = 42):
    """M5: sklearn GradientBoostingRegressor defaults (100 trees, learning rate
    0.1, depth 3) expressed as an MLlib pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    asm = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="_features", labelCol=target, predictionCol="prediction",
                       maxIter=100, stepSize=0.1, maxDepth=3, seed=seed)
    return Pipeline(stages=[asm, gbt])


def save_model(model, path: str) -> str:
    """Persist a fitted pipeline with the MLlib writer (one directory per
    split/fold instead of a pickled file)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def feature_importances(model, features: Sequence[str]) -> dict[str, float]:
    """M7."""
    imp = model.stages[-1].featureImportances
    return {f: float(imp[i]) for i, f in enumerate(features)}


def walk_forward_cv(df: DataFrame, folds: DataFrame, features: Sequence[str], target: str,
                    fit: Callable | None = None, timestamp_column: str = "timestamp", parallel: int = 4) -> DataFrame:
    """M8: one model per fold, metrics on its validation rows, mean per window as ``cv_*`` keys.
    The rows are written once and each fold filters them by its dates. ``parallel`` folds are
    fitted at a time: their Spark jobs share the cluster, so the many small steps of one fit
    don't leave it idle."""
    fit = fit or (lambda train: gbt_regressor(features, target).fit(train))
    spark = df.sparkSession
    scratch = Scratch(spark, "walk-forward")
    base = scratch.save(df.select(timestamp_column, *features, target), "rows")
    ts = F.col(timestamp_column)

    @inheritable_thread_target(spark)
    def scored_fold(k: int, f: Row) -> DataFrame | None:
        train = base.where(ts.between(F.lit(f["train_start"]), F.lit(f["train_end"])))
        val = base.where(ts.between(F.lit(f["validation_start"]), F.lit(f["validation_end"])))
        if train.isEmpty() or val.isEmpty():
            return None
        part = (fit(train).transform(val).select(target, "prediction")
                .withColumns({"window": F.lit(f["window"]), "fold": F.lit(f["fold"])}))
        return scratch.save(part, f"fold{k}")

    every = list(enumerate(folds.orderBy("window", "fold").collect()))
    with ThreadPoolExecutor(parallel) as pool:
        parts = [p for p in pool.map(lambda x: scored_fold(*x), every) if p is not None]
    if not parts:
        return spark.createDataFrame([], "key string, value double")
    out = scratch.save(mean_fold_metrics(reduce(DataFrame.unionByName, parts), target, "prediction"), "metrics")
    scratch.drop("rows", *[f"fold{k}" for k, _ in every])
    return out


def linear_folds(df: DataFrame, folds: DataFrame, features: Sequence[str], target: str,
                 timestamp_column: str = "timestamp") -> DataFrame:
    """(window, fold, coefficients): least squares of ``target`` on a constant and ``features`` over
    each fold's training rows, all folds at once. The normal equations are sums: they are taken
    per instant first, so that overlapping folds add up instants, not rows. Rows with a missing
    value take no part; the smallest solution is taken where features depend on each other."""
    x = [F.lit(1.0), *(F.col(c).cast("double") for c in features)]
    y = F.col(target).cast("double")
    known = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in (*x[1:], y)])
    pairs = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    sums = [F.sum(x[i] * x[j]).alias(f"_xx{i}_{j}") for i, j in pairs] + [F.sum(x[i] * y).alias(f"_xy{i}") for i in range(len(x))]
    names = [f"_xx{i}_{j}" for i, j in pairs] + [f"_xy{i}" for i in range(len(x))]
    per_instant = df.where(known).groupBy(timestamp_column).agg(*sums)
    per_fold = (fold_rows(per_instant, folds, timestamp_column).where(F.col("role") == "train")
                .groupBy("window", "fold").agg(*(F.sum(c).alias(c) for c in names)))
    width = len(x)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            left = np.empty((len(b), width, width))
            for i, j in pairs:
                left[:, i, j] = left[:, j, i] = b[f"_xx{i}_{j}"]
            right = b[[f"_xy{i}" for i in range(width)]].to_numpy()
            out = b[["window", "fold"]].copy()
            out["coefficients"] = [np.linalg.lstsq(m, v, rcond=None)[0] for m, v in zip(left, right)]
            yield out

    return per_fold.mapInPandas(solve, "window string, fold int, coefficients array<double>")


def walk_forward_linear(df: DataFrame, folds: DataFrame, features: Sequence[str], target: str,
                        timestamp_column: str = "timestamp") -> DataFrame:
    """M8 with a linear model: like ``walk_forward_cv``, but every fold is fitted, scored and
    averaged in one job, without a driver loop."""
    rows = df.select(timestamp_column, *features, target)
    held = fold_rows(rows, folds, timestamp_column).where(F.col("role") == "validation")
    terms = [F.col("coefficients")[0], *(F.col("coefficients")[i] * F.col(c).cast("double") for i, c in enumerate(features, 1))]
    # a row per fold: a broadcast whose size follows the calendar, not the rows
    scored = (held.join(F.broadcast(linear_folds(df, folds, features, target, timestamp_column)), ["window", "fold"])
              .withColumn("prediction", reduce(lambda a, b: a + b, terms)))
    return mean_fold_metrics(scored, target, "prediction")


def train_split(df: DataFrame, split_name: str, split_cfg: Mapping[str, Any], features: Sequence[str], target: str,
                run_name: str, runs_path: str, model_path: str | None = None, fit: Callable | None = None,
                timestamp_column: str = "timestamp") -> DataFrame:
    """The training job: split -> both roles there -> fit -> predict -> metrics -> model ->
    one row appended to the runs table. Returns that row."""
    fit = fit or (lambda train: gbt_regressor(features, target).fit(train))
    scratch = Scratch(df.sparkSession, "train-split")
    slim = df.select(timestamp_column, *features, target)
    tagged = scratch.save(split_rows(slim, split_name, split_cfg, timestamp_column), "tagged")
    require_both_roles(tagged, split_name)
    model = fit(tagged.where(F.col("role") == "train"))
    predicted = model.transform(tagged.where(F.col("role") == "validation"))
    metrics = regression_metrics(predicted, target, "prediction").first().asDict()
    if model_path:
        save_model(model, model_path)
    record = run_record(df.sparkSession, run_name, {"split": split_name, "features": ",".join(features), "target": target,
                                                    "model_path": model_path or "", **split_cfg}, metrics)
    append_run(record, runs_path)
    scratch.drop()
    return record
