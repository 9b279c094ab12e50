"""Folds, metrics, MLlib fit, rewards, config resolution and helpers."""
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.functions import expr as fe
from barspark.operators import features as feat
from barspark.operators import rewards as rw
from barspark.operators import validation as va
from barspark.plans.config import DEFAULT_CONFIG
from barspark.sinks import points as pt
from barspark.sources import fixtures as fx


def _folds_loop(first, last, cfg):
    """pandas-style walk-forward bounds, written for this test."""
    start = max(pd.Timestamp(cfg["min_train_date"]), first)
    out, i = [], 0
    while True:
        ts = start + pd.Timedelta(days=i * cfg["step_days"])
        te = ts + pd.Timedelta(days=cfg["training_days"] - 1)
        vs = te + pd.Timedelta(days=1)
        ve = vs + pd.Timedelta(days=cfg["validation_days"] - 1)
        if ve > last:
            break
        out.append((ts, te, vs, ve))
        i += 1
    return out


def test_fold_generator_matches_loop(spark, sf):
    b = fx.bars(spark, sf)
    first, last = b.agg(F.min("timestamp"), F.max("timestamp")).first()
    for w in DEFAULT_CONFIG["cross_validation"]["rolling_windows"]:
        w = dict(w, min_train_date="1994-01-01")
        got = [(r.train_start, r.train_end, r.validation_start, r.validation_end)
               for r in va.generate_folds(b, w).orderBy("fold").collect()]
        exp = [tuple(x.to_pydatetime() for x in f) for f in _folds_loop(pd.Timestamp(first), pd.Timestamp(last), w)]
        assert got == exp and len(got) > 0
    with pytest.raises(ValueError):
        va.generate_folds(b, {"training_days": 5, "validation_days": 2, "step_days": 0})


def test_fold_rows_roles(spark, sf):
    b = fx.bars(spark, sf)
    w = dict(DEFAULT_CONFIG["cross_validation"]["rolling_windows"][0], min_train_date="1994-01-01")
    folds = va.generate_folds(b, w)
    t = va.fold_rows(b, folds)
    f0 = folds.where("fold = 0").first()
    n_train = b.where(F.col("timestamp").between(f0.train_start, f0.train_end)).count()
    assert t.where("fold = 0 AND role = 'train'").count() == n_train


def test_regression_metrics_vs_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    m = va.regression_metrics(df, "y", "p").first()
    mse = np.mean((p - y) ** 2)
    r2 = 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)
    s = np.sign(p) * y
    assert math.isclose(m.mse, mse, rel_tol=1e-9) and math.isclose(m.r2, r2, rel_tol=1e-9)
    assert math.isclose(m.strategy_sharpe, s.mean() / s.std(ddof=1), rel_tol=1e-9)
    assert math.isclose(m.directional_accuracy, np.mean(np.sign(p) == np.sign(y)))
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert va.regression_metrics(const, "y", "p").first().r2 == 1.0


def test_gbt_walk_forward(spark, sf):
    sup, names, target = feat.prepare_supervised(fx.bars(spark, sf), DEFAULT_CONFIG, "basic_price")
    w = {"name": "short", "training_days": 900, "validation_days": 200, "step_days": 700,
         "min_train_date": "1994-01-01"}
    folds = va.generate_folds(sup, w)
    fit = lambda train: va.gbt_regressor(names, target).setStages(
        [va.gbt_regressor(names, target).getStages()[0],
         va.gbt_regressor(names, target).getStages()[1].setMaxIter(5)]).fit(train)
    out = {r.key: r.value for r in va.walk_forward_cv(sup, folds, names, target, fit=fit).collect()}
    assert "cv_short_rmse" in out and out["cv_short_rmse"] >= 0
    model = fit(sup)
    imp = va.feature_importances(model, names)
    assert set(imp) == set(names) and abs(sum(imp.values()) - 1.0) < 1e-6
    import tempfile
    from barspark.sinks import audit as au
    path = va.save_model(model, tempfile.mkdtemp(prefix="barspark-model-") + "/m")
    again = va.load_model(path)
    a = model.transform(sup).select("prediction").limit(5).collect()
    b = again.transform(sup).select("prediction").limit(5).collect()
    assert a == b
    runs = tempfile.mkdtemp(prefix="barspark-runs-") + "/runs"
    split = {"train_start": "1995-01-01", "train_end": "1998-12-31", "validation_start": "1999-01-01", "validation_end": "1999-06-30"}
    for name in ("one", "two"):
        va.train_split(sup, "early", split, names, target, name, runs, model_path=f"{runs}-{name}", fit=fit)
    got = {r.run_name: r for r in spark.read.parquet(runs).collect()}
    assert set(got) == {"one", "two"} and got["one"].params["split"] == "early" and got["two"].metrics["rmse"] > 0
    assert va.load_model(f"{runs}-one").transform(sup).columns[-1] == "prediction"
    with pytest.raises(ValueError, match="train"):
        va.train_split(sup, "none", dict(split, validation_start="2030-01-01", validation_end="2030-02-01"), names, target, "x", runs, fit=fit)
    rec = au.run_record(spark, "basic_price__short", {"feature_set": "basic_price"}, out).first()
    assert rec.params["feature_set"] == "basic_price" and "cv_short_rmse" in rec.metrics


def test_rewards_and_grid(spark):
    grid = rw.parameter_grid(spark, DEFAULT_CONFIG["rl"]["hyperparameters"]).orderBy("param_id").collect()
    assert [r.param_id for r in grid] == list(range(8))
    assert grid[0].asDict() == {"param_id": 0, "learning_rate": 0.0005, "gamma": 0.9, "entropy_coef": 0.0}
    assert len({(r.learning_rate, r.gamma, r.entropy_coef) for r in grid}) == 8
    assert rw.parameter_grid(spark, {}).count() == 1
    assert rw.linspace_weights(3) == list(np.linspace(1.0, 0.2, 3))
    df = spark.createDataFrame([(1.0, 0.01, 0.0), (-1.0, 0.02, 1.0), (0.0, -0.01, -1.0)],
                               "a double, r double, prev double")
    ra = rw.reward(DEFAULT_CONFIG["rl"]["reward_definitions"][0], "a", "r", "prev")
    di = rw.reward(DEFAULT_CONFIG["rl"]["reward_definitions"][1], "a", "r", "prev")
    got = df.select(ra.alias("ra"), di.alias("di")).collect()
    exp_ra = [1 * 0.01 - 0.0005 * 1 - 0.001, -0.02 - 0.0005 * 2 - 0.001, 0 - 0.0005 * 1 - 0]
    assert all(math.isclose(g.ra, e, abs_tol=1e-15) for g, e in zip(got, exp_ra))
    assert [g.di for g in got] == [1.0, -1.0, -1.0]
    with pytest.raises(ValueError):
        rw.reward({"kind": "nope"}, "a", "r", "prev")


def test_short_symbols_fail_an_episode(spark):
    counts = spark.createDataFrame([("A", 30), ("B", 5)], "symbol string, n_rows long")
    assert rw.episode_starts(counts.where("n_rows > 9"), 2, 10, 1).count() == 2
    with pytest.raises(Exception, match="symbol B"):
        rw.episode_starts(counts, 2, 10, 1).collect()


def test_feature_set_resolution():
    fs = DEFAULT_CONFIG["feature_sets"]
    sets = feat.FeatureConfig.parse(fs)
    names = [feat.column_name(d) for d in sets.specs("macro_augmented")]
    assert names[:9] == [feat.column_name(d) for d in fs["basic_price"]["features"]]
    assert names[-1] == "zscore_volume_20"
    with pytest.raises(KeyError):
        sets.specs("missing")
    with pytest.raises(ValueError, match="a > b > a"):
        feat.FeatureConfig.parse({"a": {"inherits": "b"}, "b": {"inherits": ["a"]}}).specs("a")
    diamond = feat.FeatureConfig.parse({"top": {"features": [{"rename": "t"}]}, "l": {"inherits": "top"}, "r": {"inherits": "top"},
                                        "x": {"inherits": ["l", "r"], "features": [{"rename": "x"}]}})
    assert [feat.column_name(d) for d in diamond.specs("x")] == ["t", "t", "x"]
    for wrong in ({"a": 3}, {"a": {"features": {"x": 1}}}, {"a": {"features": ["x"]}}, {"a": {"inherits": 4}}):
        with pytest.raises(TypeError):
            feat.FeatureConfig.parse(wrong)
    assert feat.column_name({"kind": "lag", "source": "close"}) == "close_lag"
    with pytest.raises(ValueError):
        feat.column_name({"kind": "lag"})


def test_ema_skips_nulls(spark):
    rows = [("A", dt.datetime(2024, 1, i + 1), v) for i, v in enumerate([1.0, None, 3.0, 4.0, float("nan"), 5.0])]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")
    spec = [{"kind": "ema", "source": "close", "span": 3, "rename": "e"}]
    for target_rows in (1_000_000, 2):
        out, _, _ = feat.engineer_features(df, spec, ["symbol"], target_rows=target_rows)
        got = [r.e for r in out.orderBy("timestamp").collect()]
        want = [1.0, None, 3.5 / 1.5, 5.75 / 1.75, None, (5 + 2 + 0.75 + 0.125) / 1.875]
        assert all((a is None) == (b is None) and (a is None or math.isclose(a, b)) for a, b in zip(got, want)), got


def test_time_text(spark):
    cases = {"2024-01-01T09:15:00+05": "04:15", "2024-01-01 09:15:00 UTC": "09:15", "2024-01-01 09:15:00": "03:45",
             "2024-01-01T09:15:00Z": "09:15", "2024-01-01T09:15:00+05:30": "03:45", "2024-01-01 09:15:00+0530": "03:45",
             "2024-01-01 09:15:00 Asia/Kolkata": "03:45", "2024-01-01 09:15:00.5-5": "14:15", "2024-01-01": "18:30",
             "2024-01-01 09:15:00 Mars/Base": None, "oops": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.select("t", F.date_format(fe.local_to_utc("t", T.StringType()), "HH:mm").alias("u")).collect()
    assert {r.t: r.u for r in got} == cases


def test_points_file(spark, tmpdir_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a", 1.5)], "ts timestamp_ntz, tag string, v double")
    pt.write_lines(pt.to_points(df, "m", "ts", ["tag"]), f"{tmpdir_path}/lines")
    assert [r.value for r in spark.read.text(f"{tmpdir_path}/lines").collect()] == ["m,tag=a v=1.5 1704067200000000000"]


def test_checkpoint_folder_is_required_off_local():
    from types import SimpleNamespace

    from barspark.session import ensure_checkpoint_dir
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(contains=lambda k: False))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))


def test_helpers(spark):
    assert fe.frequency_us("1m") == 60_000_000 and fe.frequency_us("500ms") == 500_000
    assert fe.frequency_us("1.5H") == 5_400_000_000
    with pytest.raises(ValueError):
        fe.frequency_us("3w")
    row = spark.range(1).select(
        fe.ieee_div(F.lit(1.0), F.lit(0.0)).alias("a"), fe.ieee_div(F.lit(-1.0), F.lit(0.0)).alias("b"),
        fe.ieee_div(F.lit(0.0), F.lit(0.0)).alias("c"),
        fe.local_to_utc(F.lit("2024-01-01 09:15:00"), T.StringType()).cast("timestamp_ntz").alias("d"),
        fe.local_to_utc(F.lit("2024-01-01T09:16:00+05:30"), T.StringType()).cast("timestamp_ntz").alias("e"),
        fe.local_to_utc(F.lit("garbage"), T.StringType()).alias("f")).first()
    assert row.a == float("inf") and row.b == float("-inf") and math.isnan(row.c)
    assert row.d == dt.datetime(2024, 1, 1, 3, 45) and row.e == dt.datetime(2024, 1, 1, 3, 46)
    assert row.f is None


def test_points_null_time_fails(spark):
    df = spark.createDataFrame([(None, "a", 1.0)], "ts timestamp_ntz, tag string, v double")
    with pytest.raises(Exception):
        pt.to_points(df, "m", "ts", ["tag"]).collect()
    ok = spark.createDataFrame([(dt.datetime(2024, 1, 1), None, float("nan"), True)],
                               "ts timestamp_ntz, tag string, v double, b boolean")
    r = pt.to_points(ok, "m", "ts", ["tag"]).first()
    assert r.tags == {} and r.fields == {"b": "true"} and r.line == "m b=true 1704067200000000000"


def test_entry_contract(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    rows = out.collect()
    assert len(rows) >= 1 and "sharpe_ratio" in out.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_linear_folds_against_numpy(spark, sf):
    import numpy as np
    sup, names, target = feat.prepare_supervised(fx.bars(spark, sf), DEFAULT_CONFIG, "basic_price")
    folds = va.generate_folds(sup, {"name": "w", "training_days": 200, "validation_days": 40, "step_days": 60})
    pdf, by_fold = sup.toPandas(), {r.fold: r for r in folds.collect()}
    got = {r.fold: r.coefficients for r in va.linear_folds(sup, folds, names[:3], target).collect()}
    assert len(got) > 3
    errors = []
    for k, f in sorted(by_fold.items()):
        part = pdf[(pdf.timestamp >= f.train_start) & (pdf.timestamp <= f.train_end)].dropna(subset=[*names[:3], target])
        x = np.column_stack([np.ones(len(part)), part[names[:3]].to_numpy(float)])
        if not len(part):
            assert k not in got
            continue
        want = np.linalg.lstsq(x, part[target].to_numpy(float), rcond=None)[0]
        assert np.allclose(got[k], want, rtol=1e-4, atol=1e-6)
        val = pdf[(pdf.timestamp >= f.validation_start) & (pdf.timestamp <= f.validation_end)]
        if len(val):
            p = np.column_stack([np.ones(len(val)), val[names[:3]].to_numpy(float)]) @ want
            errors.append(np.sqrt(np.mean((p - val[target]) ** 2)))
    out = {r.key: r.value for r in va.walk_forward_linear(sup, folds, names[:3], target).collect()}
    assert out["cv_w_rmse"] == pytest.approx(np.mean(errors), rel=1e-6)


def test_folds_are_fitted_side_by_side(spark, sf):
    """Several folds are in their fit at once, never more than asked for."""
    import threading
    import time
    sup, names, target = feat.prepare_supervised(fx.bars(spark, sf), DEFAULT_CONFIG, "basic_price")
    folds = va.generate_folds(sup, {"name": "w", "training_days": 200, "validation_days": 40, "step_days": 60}).limit(8)
    running, most, lock = [], [], threading.Lock()

    class Mean:
        def transform(self, val):
            return val.withColumn("prediction", F.lit(0.0))

    def fit(train):
        with lock:
            running.append(1)
            most.append(len(running))
        time.sleep(0.4)
        with lock:
            running.pop()
        return Mean()
    out = {r.key: r.value for r in va.walk_forward_cv(sup, folds, names, target, fit=fit, parallel=4).collect()}
    assert 1 < max(most) <= 4 and out["cv_w_rmse"] > 0
