"""The bucketed (hot-key) plan must give exactly the plain per-key result."""
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barspark.operators import features as feat
from barspark.operators import quality as dq
from barspark.operators import sequence as sq
from barspark.plans.config import DEFAULT_CONFIG
from barspark.sources import fixtures as fx

DEFS = feat.FeatureConfig.parse(DEFAULT_CONFIG["feature_sets"]).specs("macro_augmented") + [
    {"kind": "lag", "source": "close", "periods": -3, "rename": "lead_close_3"}]
TARGET = {"name": "future_return_1d", "kind": "future_return", "source": "close", "horizon": 1}


def _collect(df, names):
    pdf = df.toPandas().sort_values(["symbol", "timestamp"]).reset_index(drop=True)
    return pdf[["symbol", "timestamp", *names]]


@pytest.fixture(scope="module")
def bars_with_nulls(spark, sf):
    b = fx.bars(spark, sf)
    # a few NULL closes so forward fill and null-skipping weights are exercised
    return b.withColumn("close", F.when(F.dayofmonth("timestamp") == 7, F.lit(None)).otherwise(F.col("close")))


def test_bucketed_equals_plain(spark, bars_with_nulls):
    names = [feat.column_name(d) for d in DEFS] + ["future_return_1d"]
    plain, _, _ = feat.engineer_features(bars_with_nulls, DEFS, ["symbol"], "timestamp", target=TARGET)
    bucketed, _, _ = feat.engineer_features(bars_with_nulls, DEFS, ["symbol"], "timestamp", target=TARGET,
                                            target_rows=7)
    a, b = _collect(plain, names), _collect(bucketed, names)
    assert len(a) == len(b) == bars_with_nulls.count()
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9, atol=1e-9)


def test_index_is_dense_in_both_modes(spark, bars_with_nulls):
    for target_rows in (5, 10_000):
        seq = sq.index_sequence(bars_with_nulls, ["symbol"], "timestamp", target_rows=target_rows)
        agg = seq.frame.groupBy("symbol").agg(F.min(sq.RN).alias("lo"), F.max(sq.RN).alias("hi"),
                                              F.count(F.lit(1)).alias("n"),
                                              F.countDistinct(sq.RN).alias("d")).collect()
        for r in agg:
            assert r.lo == 0 and r.hi == r.n - 1 and r.d == r.n


def test_ema_matches_recursion(spark, sf):
    b = fx.bars(spark, sf)
    out, _, _ = feat.engineer_features(b, [{"kind": "ema", "source": "close", "span": 12, "rename": "e"}],
                                       ["symbol"], "timestamp", target_rows=50)
    pdf = out.select("symbol", "timestamp", "close", "e").toPandas().sort_values(["symbol", "timestamp"])
    alpha = 2 / 13
    worst = 0.0
    for _, g in pdf.groupby("symbol"):
        num = den = 0.0
        for x, e in zip(g.close, g.e):
            num = x + (1 - alpha) * num
            den = 1 + (1 - alpha) * den
            worst = max(worst, abs(num / den - e) / abs(num / den))
    assert worst < 1e-12


def test_gaps_bucketed_equals_plain(spark, sf):
    ev = fx.events(spark, sf)
    a = dq.detect_time_gaps(ev, "ts", "5m").toPandas().sort_values("start_timestamp").reset_index(drop=True)
    b = dq.detect_time_gaps(ev, "ts", "5m", target_rows=13).toPandas().sort_values("start_timestamp") \
          .reset_index(drop=True)
    assert len(a) > 0
    pd.testing.assert_frame_equal(a, b)
    c = dq.detect_time_gaps(ev, "ts", "5m", partition_by=["user_id"], target_rows=3).count()
    d = dq.detect_time_gaps(ev, "ts", "5m", partition_by=["user_id"]).count()
    assert c == d


def test_skewed_key_is_split(spark):
    # one key with most rows: its rows land in many buckets, results unchanged
    rows = [(0 if i % 10 else i % 7 + 1, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, i long").withColumn(
        "ts", F.timestamp_seconds(F.col("i") * 60).cast("timestamp_ntz")).withColumn("x", F.col("i").cast("double"))
    seq = sq.index_sequence(df, ["k"], "ts", target_rows=100)
    assert not seq.single
    hot_buckets = seq.buckets.where("k = 0").count()
    assert hot_buckets >= 20
    out, _, _ = feat.engineer_features(df, [{"kind": "rolling_mean", "source": "x", "window": 30, "rename": "m"}],
                                       ["k"], "ts", target_rows=100)
    pdf = out.toPandas().sort_values(["k", "ts"])
    for _, g in pdf.groupby("k"):
        exp = g.x.rolling(30, min_periods=30).mean()
        ok = (exp.isna() & g.m.isna()) | ((exp - g.m).abs() < 1e-9)
        assert ok.all()


@pytest.fixture(scope="module")
def burst(spark):
    """A key whose rows lie mostly in one second and at one instant, a small key, null keys and
    null times."""
    rows = []
    for i in range(9000):
        if i < 5000:
            rows.append(("hot", 1_000_000 + i * 150, i, float(i % 97)))         # 0.75 s
        elif i < 7500:
            rows.append(("hot", 5_000_000, i, None if i % 5 == 0 else float(i % 89)))   # one instant
        else:
            rows.append(("hot", 10_000_000 + i * 60_000_000, i, float(i)))
    rows += [("cold", k * 1_000_000, k, float(k)) for k in range(60)]
    rows += [(None, k * 1000, k, float(k % 31)) for k in range(2500)] + [(None, None, k, 1.0) for k in range(3)]
    df = spark.createDataFrame(rows, "k string, us long, i long, x double")
    return df.withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz")).drop("us").repartition(6, "i")


def test_burst_and_single_instant_are_split(spark, burst):
    for target in (100, 400):
        seq = sq.index_sequence(burst, ["k"], "ts", ["i"], target_rows=target)
        sizes = seq.frame.groupBy("k", sq.BKT).count()
        assert sizes.agg(F.max("count")).first()[0] <= 2 * target
        assert sizes.where("k = 'cold'").count() == 1
        instant = seq.frame.where("ts = timestamp_ntz'1970-01-01 00:00:05'")
        assert instant.select(sq.BKT).distinct().count() >= 2500 // (2 * target)
        got = {(r.k, r.i, r.ts): r[sq.RN] for r in seq.frame.collect()}
        plain = sq.index_sequence(burst, ["k"], "ts", ["i"])
        assert plain.single and got == {(r.k, r.i, r.ts): r[sq.RN] for r in plain.frame.collect()}
        totals = {r.k: r.n for r in seq.buckets.groupBy("k").agg(F.sum("_n").alias("n")).collect()}
        assert totals == {"hot": 9000, "cold": 60, None: 2503}


def test_features_on_a_burst_equal_the_plain_windows(spark, burst):
    defs = [{"kind": "rolling_mean", "source": "x", "window": 20, "rename": "m"}, {"kind": "ema", "source": "x", "span": 5, "rename": "e"},
            {"kind": "lag", "source": "x", "periods": 7, "rename": "l"}, {"kind": "lag", "source": "x", "periods": -5, "rename": "f"},
            {"kind": "pct_change", "source": "x", "periods": 3, "rename": "p"}]
    plain, cut = (feat.engineer_features(burst, defs, ["k"], "ts", tie_break=["i"], **kw)[0].toPandas()
                  .sort_values(["k", "ts", "i"]).reset_index(drop=True) for kw in ({}, {"target_rows": 300}))
    assert len(plain) == len(cut) == 11563
    pd.testing.assert_frame_equal(plain[["k", "i", *"melfp"]], cut[["k", "i", *"melfp"]], check_exact=False, rtol=1e-9, atol=1e-9)


def test_rows_are_shuffled_once_for_the_index(spark, burst):
    seq = sq.index_sequence(burst, ["k"], "ts", ["i"], target_rows=300)
    plan = seq.frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ENSURE_REQUIREMENTS") == 1 and "SortMergeJoin" not in plan
