"""Portfolio panel vs a plain sequential loop written for this test."""
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barspark.operators import portfolio as pf
from barspark.sources import fixtures as fx


def loop_backtest(sig, px, master, cfg, bps=0.0, min_fee=0.0, per_order=0.0, slip=0.0):
    """Rebalance at each signal time in a Python loop: the semantics the panel
    re-expresses (carried prices seen at signal times, universe gating,
    weight 0 closes a position, costs and slippage paid from cash)."""
    start, end = pd.Timestamp(cfg.start_date), pd.Timestamp(cfg.end_date)
    sig = sig[(sig.timestamp >= start) & (sig.timestamp <= end)]
    px = px[(px.timestamp >= start) & (px.timestamp <= end) & px.close.notna()]
    out = []
    for strat, s in sig.groupby("strategy"):
        holdings, last = {}, {}
        cash = prev = float(cfg.initial_capital)
        for ts in sorted(s.timestamp.unique()):
            alive = master[(master.start_date <= ts) & (master.end_date.isna() | (master.end_date >= ts))]
            universe = set(alive.symbol)
            pm = dict(zip(px[px.timestamp == ts].symbol, px[px.timestamp == ts].close))
            last.update(pm)
            cur = s[s.timestamp == ts]
            tw = {a: b for a, b in zip(cur.symbol, cur.target_weight) if a in universe}
            pre = cash + sum(last[k] * q for k, q in holdings.items())
            for sym in sorted(universe | set(holdings)):
                price = pm.get(sym) or last.get(sym)
                if price is None:
                    continue
                have = holdings.get(sym, 0.0)
                target = tw.get(sym, 0.0) * pre / price if price else 0.0
                trade = target - have
                if abs(trade) < 1e-6:
                    continue
                ex = price * (1 + np.sign(trade) * slip / 1e4) if slip else price
                notional = ex * trade
                cost = 0.0 if notional == 0 else max(abs(notional) * bps / 1e4 + per_order, min_fee)
                cash -= notional + cost
                if abs(have + trade) < 1e-6:
                    holdings.pop(sym, None)
                else:
                    holdings[sym] = have + trade
            value = cash + sum(last[k] * q for k, q in holdings.items())
            out.append((strat, ts, value, value / prev - 1 if prev else 0.0))
            prev = value
    return pd.DataFrame(out, columns=["strategy", "timestamp", "portfolio_value", "period_return"])


@pytest.fixture(scope="module")
def inputs(spark, sf):
    sig = fx.signals(spark, sf)
    px = fx.bars(spark, sf).select("timestamp", "symbol", "close")
    master = fx.symbol_master(spark, sf)
    return sig, px, master


CFG = pf.BacktestConfig(start_date="1995-01-01", end_date="2001-12-31", initial_capital=1_000_000.0)


def _compare(spark, inputs, costs, slip):
    sig, px, master = inputs
    res = pf.run_backtest(sig, px, master, CFG, costs, slip)
    got = res.equity.toPandas().sort_values(["strategy", "timestamp"]).reset_index(drop=True)
    exp = loop_backtest(sig.toPandas(), px.toPandas(), master.toPandas(), CFG,
                        costs.bps if costs else 0.0, costs.minimum_fee if costs else 0.0,
                        costs.per_order_fee if costs else 0.0, slip.bps if slip else 0.0)
    exp = exp.sort_values(["strategy", "timestamp"]).reset_index(drop=True)
    assert len(got) == len(exp)
    rel = (got.portfolio_value - exp.portfolio_value).abs() / exp.portfolio_value.abs().clip(lower=1.0)
    assert rel.max() < 1e-6, rel.max()
    return res


def test_frictionless_matches_loop(spark, inputs):
    res = _compare(spark, inputs, None, None)
    assert res.passes == 0


def test_costed_matches_loop(spark, inputs):
    res = _compare(spark, inputs, pf.CostModel(bps=10.0, minimum_fee=20.0, per_order_fee=1.0),
                   pf.SlippageModel(bps=5.0))
    assert 1 <= res.passes <= 30


def test_summary_and_drawdown(spark, inputs):
    sig, px, master = inputs
    res = pf.run_backtest(sig, px, master, CFG)
    s = res.summary(CFG).toPandas()
    eq = res.equity.toPandas().sort_values(["strategy", "k"])
    for _, row in s.iterrows():
        e = eq[eq.strategy == row.strategy]
        v = e.portfolio_value.to_numpy()
        r = e.period_return.to_numpy()[1:]
        assert math.isclose(row.total_return, v[-1] / v[0] - 1, rel_tol=1e-9)
        std = np.std(r, ddof=1) if len(r) > 1 else 0.0
        assert math.isclose(row.annualised_volatility, std * math.sqrt(252) if std else 0.0, rel_tol=1e-9)
        peak, mdd = -np.inf, 0.0
        for x in v:
            peak = max(peak, x)
            mdd = min(mdd, x / peak - 1 if peak > 0 else 0.0)
        assert math.isclose(row.max_drawdown, abs(mdd), rel_tol=1e-9, abs_tol=1e-12)


def test_duplicate_signal_raises(spark, inputs):
    sig, px, master = inputs
    dup = sig.unionByName(sig.limit(1))
    with pytest.raises(Exception):
        pf.run_backtest(dup, px, master, CFG).equity.collect()


def test_cost_and_slippage_models(spark):
    df = spark.createDataFrame([(0.0,), (1000.0,), (-50000.0,)], "n double")
    cm = pf.CostModel(bps=10.0, minimum_fee=20.0, per_order_fee=1.0)
    got = [r.c for r in df.select(cm.estimate(df.n).alias("c")).collect()]
    assert got == [0.0, 20.0, 51.0]
    sm = pf.SlippageModel(bps=5.0)
    row = spark.range(1).selectExpr("100.0 AS p").select(
        sm.apply(__import__("pyspark.sql.functions", fromlist=["lit"]).lit(100.0),
                 __import__("pyspark.sql.functions", fromlist=["lit"]).lit(-3.0)).alias("x")).first()
    assert math.isclose(row.x, 99.95)


def test_repeated_price_key_counts_once(spark):
    ts = [dt.datetime(2024, 1, k) for k in (1, 2, 3)]
    sig = spark.createDataFrame([("s", t, "A", 1.0) for t in ts], "strategy string, timestamp timestamp_ntz, symbol string, target_weight double")
    px = [(t, "A", p) for t, p in zip(ts, (10.0, 11.0, 12.0))]
    master = spark.createDataFrame([("A", dt.datetime(2020, 1, 1), None)], "symbol string, start_date timestamp_ntz, end_date timestamp_ntz")
    cfg = pf.BacktestConfig("2024-01-01", "2024-12-31", 1000.0)
    schema = "timestamp timestamp_ntz, symbol string, close double"
    one = pf.run_backtest(sig, spark.createDataFrame(px, schema), master, cfg, pf.CostModel(bps=100.0))
    two = pf.run_backtest(sig, spark.createDataFrame(px + [px[1]], schema), master, cfg, pf.CostModel(bps=100.0))
    a, b = (sorted(r.portfolio_value for r in x.equity.collect()) for x in (one, two))
    assert a == b and two.trades.count() == 3


def test_no_signal_in_range_raises(spark, inputs):
    sig, px, master = inputs
    with pytest.raises(ValueError, match="no signal"):
        pf.run_backtest(sig, px, master, pf.BacktestConfig("2030-01-01", "2030-12-31", 1000.0))


def test_reports_are_written(spark, inputs, tmpdir_path):
    sig, px, master = inputs
    res = pf.run_backtest(sig, px, master, CFG)
    pf.write_reports(res.summary(CFG), res.equity, f"{tmpdir_path}/reports", "r1")
    n = sig.select("strategy").distinct().count()
    assert spark.read.json(f"{tmpdir_path}/reports/metrics").count() == n
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/reports/equity").count() == res.equity.count()


def test_scan_in_blocks_equals_plain_windows(spark):
    from pyspark.sql import Window
    from barspark.operators.scan import Scan, segmented_scan
    df = spark.range(3000).selectExpr("id % 3 AS s", "id DIV 3 * (1 + id % 3) AS k", "1 + (hash(id) % 100) / 1e5 AS g",
                                      "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(hash(id) % 1000 AS double) END AS v",
                                      "CASE WHEN id < 600 OR id % 11 < 9 THEN NULL ELSE id END AS p")
    scans = [Scan("product", "g", "a"), Scan("product_before", "g", "b"), Scan("max", "v", "m"), Scan("sum", "v", "t"),
             Scan("last", "p", "l"), Scan("lag", "v", "z")]
    w = Window.partitionBy("s").orderBy("k")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("*", F.product("g").over(upto).alias("a"),
                      F.coalesce(F.product("g").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1.0)).alias("b"),
                      F.max("v").over(upto).alias("m"), F.sum("v").over(upto).alias("t"),
                      F.last("p", ignorenulls=True).over(upto).alias("l"), F.lag("v", 1).over(w).alias("z"))
    expected = plain.toPandas().sort_values(["s", "k"]).reset_index(drop=True)
    for block, last in ((70, None), (10_000, None), (10_000, 2997)):
        got = segmented_scan(df, ["s"], "k", scans, block, last).toPandas().sort_values(["s", "k"]).reset_index(drop=True)
        pd.testing.assert_frame_equal(got[expected.columns], expected, check_exact=False, rtol=1e-9)


def test_backtest_in_blocks_equals_one_block(spark, inputs):
    sig, px, master = inputs
    costs, slip = pf.CostModel(bps=10.0, minimum_fee=20.0, per_order_fee=1.0), pf.SlippageModel(bps=5.0)
    frames = []
    for block in (3, 50_000):
        cfg = pf.BacktestConfig("1995-01-01", "2001-12-31", 1_000_000.0, block=block)
        res = pf.run_backtest(sig, px, master, cfg, costs, slip)
        frames.append((res.equity.toPandas().sort_values(["strategy", "k"]).reset_index(drop=True),
                       res.summary(cfg).toPandas().sort_values("strategy").reset_index(drop=True), res.passes))
    for a, b in zip(frames[0][:2], frames[1][:2]):
        pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9, atol=1e-12)
    assert frames[0][2] == frames[1][2] and len(frames[0][0]) > 20


def test_long_strategy_is_many_tasks(spark):
    """1 M rebalance times of one strategy: drawdown and running product in blocks."""
    equity = spark.range(1_000_000).selectExpr("'s' AS strategy", "id AS k", "100.0D + (id % 1000) - id / 10000 AS portfolio_value")
    dd = pf.drawdown(equity, block=20_000)
    per_task = dd.groupBy(F.spark_partition_id()).count()
    assert dd.agg(F.min("drawdown"), F.max("peak")).first() == (
        pytest.approx(min((100 + i % 1000 - i / 10000) / (1099 - 0.0999) - 1 for i in range(999, 1_000_000))), pytest.approx(1099 - 0.0999))
    assert per_task.count() > 1


def test_strategies_with_the_same_times_share_prices(spark, inputs):
    sig, px, master = inputs
    cfg = pf.BacktestConfig("1995-01-01", "2001-12-31", 1_000_000.0, block=4)
    first = sig.where(sig.strategy == sig.agg(F.min("strategy")).first()[0])
    twins = first.unionByName(first.withColumn("strategy", F.col("strategy") + 100)).unionByName(
        first.where("dayofmonth(timestamp) % 2 = 0").withColumn("strategy", F.col("strategy") + 200))
    times = pf.rebalance_times(twins, cfg)
    by_strategy = {r[0]: r[1] for r in pf.calendars(times).collect()}
    assert len(by_strategy) == 3 and len(set(by_strategy.values())) == 2
    panel = pf.build_panel(twins, px, master, cfg).toPandas()
    one, two, _ = (panel[panel.strategy == s].drop(columns=["strategy", "_calendar"], errors="ignore")
                   .sort_values(["k", "symbol"]).reset_index(drop=True) for s in sorted(by_strategy))
    pd.testing.assert_frame_equal(one, two)


def test_price_rows_are_shuffled_once(spark, inputs):
    """Beyond the broadcasts, price rows meet one exchange, although repeated keys are joined and
    the last price is carried in it."""
    from pyspark.sql import types as T
    cal = T.StructType.fromDDL("_calendar int, k long, timestamp timestamp_ntz")
    times = spark.createDataFrame([], cal)
    rows = spark.createDataFrame([], "_calendar int, k long, symbol string")
    p = pf.last_prices(rows, inputs[1].select("timestamp", F.col("symbol").cast("string").alias("symbol"), "close"),
                       F.broadcast(times), 50, 10)
    parts = spark._jvm.PythonSQLUtils.explainString(p._jdf.queryExecution(), "formatted").split("\n\n")
    assert len([x for x in parts if ") Exchange" in x.split("\n")[0] and "_rest#" in x]) == 1
