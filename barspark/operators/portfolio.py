"""Portfolio analytics.

The reference walks signal times and symbols in a Python loop. The same
result is written here as set operations over a *panel* with one row per
(strategy, rebalance index k, symbol), for any number of strategies at once:

* ``w``   target weight at k (0 on the exit row after a position's last signal),
* ``p``   last price seen at a signal time <= k (as-of backward, Q8),
* ``w_eff`` = w when p != 0 else 0 (price 0 gives 0 shares, never priced is skipped).

With V_k the pre-trade value and F_k the friction (costs + slippage) paid at k,

    growth_k = 1 + sum_i w_eff[i,k-1] * (p[i,k] / p[i,k-1] - 1) - F_k-1 / V_k-1
    V_k      = capital * prod_{j<=k} growth_j            (``product`` window)
    q[i,k]   = w_eff[i,k] * V_k / p[i,k]; trade = q[i,k] - q[i,k-1]
    NAV_k    = V_k - F_k

Without costs this is one pass and exact. With costs F depends on V, so the
small per-(strategy, k) friction table is iterated to a fixed point, strategy
by strategy (``_friction``); each pass is one job on the strategies that still
move. The panel carries its own previous weight and price, so a pass needs no
window over it: shares before a trade are w_prev * V_k-1 / p_prev.
Running values (product, maximum, last price, previous row) go over rebalance
times in two levels (``scan``), and times are numbered by rank (``sequence``):
a strategy with any number of times is many tasks.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.expr import ieee_div
from ..session import Scratch, checkpoint_keep_partitioning, materialize
from . import sequence as sq
from .scan import BLK, BLOCK, Scan, block_of, segmented_scan
from .universe import gate_signals

CAL = "_calendar"
MIN_TRADE_SHARES = 1e-6  # fixed value: trades below this many shares are not executed
TRADING_DAYS = 252       # fixed value: annualisation factor


@dataclass
class CostModel:
    """|notional| * bps / 1e4 + per_order_fee, at least minimum_fee; 0 for 0."""
    bps: float = 0.0
    minimum_fee: float = 0.0
    per_order_fee: float = 0.0

    def estimate(self, notional: Column) -> Column:
        var = F.abs(notional) * F.lit(self.bps / 10_000.0) + F.lit(self.per_order_fee)
        return F.when(notional == 0, F.lit(0.0)).otherwise(F.greatest(var, F.lit(self.minimum_fee)))

    @property
    def free(self) -> bool:
        return self.bps == 0 and self.minimum_fee == 0 and self.per_order_fee == 0


@dataclass
class SlippageModel:
    """Price * (1 + sign(direction) * bps / 1e4); unchanged for no trade."""
    bps: float = 0.0

    def apply(self, price: Column, direction: Column) -> Column:
        if self.bps == 0:
            return price
        return F.when(direction == 0, price).otherwise(
            price * (F.lit(1.0) + F.signum(direction) * F.lit(self.bps / 10_000.0)))


@dataclass
class BacktestConfig:
    start_date: str
    end_date: str
    initial_capital: float
    index_name: str | None = None
    strategy_col: str = "strategy"
    tolerance: float = 1e-10
    block: int = BLOCK      # rebalance times a task scans


# --------------------------------------------------------------------------
# panel (B1, B2, J4, J6)
# --------------------------------------------------------------------------
def _in_range(df: DataFrame, cfg: BacktestConfig, col: str = "timestamp") -> DataFrame:
    lo = F.lit(cfg.start_date).cast("timestamp_ntz")
    hi = F.lit(cfg.end_date).cast("timestamp_ntz")
    return df.where(F.col(col).between(lo, hi))


def rebalance_times(signals: DataFrame, cfg: BacktestConfig) -> DataFrame:
    """(strategy, timestamp, k): distinct signal times in range, k = 0, 1, ..."""
    s = cfg.strategy_col
    t = _in_range(signals, cfg).select(s, "timestamp").distinct()
    seq = sq.index_sequence(t, [s], "timestamp", target_rows=cfg.block)
    return seq.frame.select(s, "timestamp", F.col(sq.RN).alias("k"))


def _numbered(signals: DataFrame, cfg: BacktestConfig) -> tuple[DataFrame, int | None]:
    """The rebalance times, written once, and the greatest k."""
    times = materialize(rebalance_times(signals, cfg), "times")
    return times, times.agg(F.max("k")).first()[0]


def check_unique_signals(signals: DataFrame, strategy_col: str = "strategy") -> DataFrame:
    """Q11: a repeated (strategy, timestamp, symbol) signal fails the job. The
    check is folded into ``target_weight`` so column pruning cannot drop it."""
    w = Window.partitionBy(strategy_col, "timestamp", "symbol")
    dup = F.count(F.lit(1)).over(w) > 1
    return signals.withColumn("target_weight", F.when(dup, F.raise_error(
        F.lit("Duplicate signal for (strategy, timestamp, symbol)")).cast("double"))
        .otherwise(F.col("target_weight")))


def one_price(prices: DataFrame) -> DataFrame:
    """(timestamp, symbol, close): of rows that repeat a price key, the one with the greatest
    remaining columns (the stand-in for the last row), everywhere prices are used."""
    rest = [c for c in prices.columns if c not in ("timestamp", "symbol")]
    return prices.groupBy("timestamp", "symbol").agg(F.max_by("close", F.struct(*rest)).alias("close"))


def signal_prices(signals: DataFrame, prices: DataFrame) -> DataFrame:
    """Each signal with the close at exactly its (timestamp, symbol)."""
    return signals.join(one_price(prices), ["timestamp", "symbol"], "left")


def calendars(times: DataFrame, strategy_col: str = "strategy") -> DataFrame:
    """(strategy, _calendar): strategies with the same rebalance times share a calendar, named by
    the smallest of them. Sets of times are compared by their number and two sums of hashes."""
    h = [F.sum(F.xxhash64("timestamp", "k", F.lit(i)).cast("decimal(38,0)")).alias(f"_h{i}") for i in (0, 1)]
    sets = times.groupBy(strategy_col).agg(F.count(F.lit(1)).alias("_h2"), *h)
    named = sets.groupBy("_h0", "_h1", "_h2").agg(F.min(strategy_col).alias(CAL))
    return sets.join(named, ["_h0", "_h1", "_h2"]).select(strategy_col, CAL)


def last_prices(rows: DataFrame, prices: DataFrame, times: DataFrame, block: int, last_k: int | None) -> DataFrame:
    """(_calendar, k, symbol, p) for the panel rows' places: the last price at one of the calendar's
    ``times`` (_calendar, k, timestamp) up to k; null where there is none (NULL and NaN closes are
    missing, Q15).

    An as-of merge per (calendar, symbol): price rows and asked places are dealt once, by
    (calendar, symbol, block of k), where prices of one key become one and the last one is
    carried on. Prices are copied per calendar, not per strategy, and only at its times."""
    rest = [c for c in prices.columns if c not in ("timestamp", "symbol")]
    seen = (prices.join(rows.select("symbol").distinct(), "symbol", "left_semi").join(times, "timestamp")
            .select(CAL, "symbol", "k", F.struct(*rest).alias("_rest"), F.lit(False).alias("_asked")))
    asked = rows.select(CAL, "symbol", "k", F.lit(None).cast(seen.schema["_rest"].dataType).alias("_rest"), F.lit(True).alias("_asked"))
    dealt = (seen.unionByName(asked).withColumn(BLK, block_of("k", block)).repartition(CAL, "symbol", BLK)
             .groupBy(CAL, "symbol", BLK, "k").agg(F.max("_rest")["close"].alias("_close"), F.max("_asked").alias("_asked")))
    dealt = dealt.withColumn("_px", F.when(~F.isnan("_close"), F.col("_close")))
    carried = segmented_scan(dealt, [CAL, "symbol"], "k", [Scan("last", "_px", "p")], block, last_k)
    return carried.where("_asked").select(CAL, "k", "symbol", "p")


def build_panel(signals: DataFrame, prices: DataFrame, master: DataFrame, cfg: BacktestConfig,
                index_members: DataFrame | None = None,
                numbered: tuple[DataFrame, int | None] | None = None) -> DataFrame:
    """B1 + B2 + J6: (strategy, k, timestamp, symbol, w, p, w_eff, w_prev, p_prev, contrib)."""
    s = cfg.strategy_col
    sig = check_unique_signals(_in_range(signals, cfg), s)
    times, last_k = numbered or _numbered(signals, cfg)
    gated = gate_signals(sig, master, "timestamp", index_members, cfg.index_name)
    at_k = gated.join(times, [s, "timestamp"]).select(s, "k", "symbol", F.col("target_weight").alias("w"))
    exits = at_k.select(s, (F.col("k") + 1).alias("k"), "symbol", F.lit(None).cast("double").alias("w"))
    rows = (at_k.unionByName(exits).groupBy(s, "k", "symbol")
                .agg(F.max("w").alias("w"))
                .join(times, [s, "k"]))   # drops exits past the last time
    calendar = calendars(times, s)
    rows = rows.join(calendar, s)
    priced = last_prices(rows, prices, times.join(calendar, s).where(F.col(s) == F.col(CAL)).select(CAL, "k", "timestamp"),
                         cfg.block, last_k)
    carried = rows.join(priced, [CAL, "k", "symbol"])
    panel = (carried.select(s, "k", "timestamp", "symbol",
                            F.coalesce("w", F.lit(0.0)).alias("w"), "p")
                    .withColumn("w_eff", F.when(F.col("p") != 0, F.col("w")).otherwise(F.lit(0.0)))
                    .withColumn("_now", F.struct("k", "w_eff", "p")))
    panel = segmented_scan(panel, [s, "symbol"], "k", [Scan("lag", "_now", "_was")], cfg.block, last_k)
    held = F.col("_was.k") == F.col("k") - 1
    return (panel.withColumn("w_prev", F.when(held, F.col("_was.w_eff")).otherwise(F.lit(0.0)))
                 .withColumn("p_prev", F.when(held, F.col("_was.p"))).drop("_now", "_was")
                 .withColumn("contrib", F.when(F.col("w_prev") != 0,
                                               F.col("w_prev") * (ieee_div("p", "p_prev") - 1))
                                          .otherwise(F.lit(0.0))))


# --------------------------------------------------------------------------
# NAV (B3, B4, W12)
# --------------------------------------------------------------------------
def _values(gross: DataFrame, fric: DataFrame | None, cfg: BacktestConfig, last_k: int | None) -> DataFrame:
    """(strategy, k, timestamp, G, V, V_prev) with V from the growth product."""
    s = cfg.strategy_col
    if fric is None:
        g = gross.withColumn("_f", F.lit(0.0))
    else:
        g = gross.join(fric.select(s, (F.col("k") + 1).alias("k"), F.col("f").alias("_f")), [s, "k"], "left")
    growth = F.when(F.col("k") == 0, F.lit(1.0)).otherwise(F.lit(1.0) + F.col("G") - F.coalesce("_f", F.lit(0.0)))
    # V_k = V_k-1 * growth_k holds for any sign of V (targets are w * V / p, as
    # in the loop); only V = 0 leaves the relative friction F/V undefined
    g = segmented_scan(g.withColumn("_growth", growth).drop("_f"), [s], "k",
                       [Scan("product", "_growth", "V"), Scan("product_before", "_growth", "V_prev")], cfg.block, last_k)
    capital = F.lit(float(cfg.initial_capital))
    v = capital * F.col("V")
    return g.withColumn("V", F.when(v == 0, F.raise_error(
        F.lit("Portfolio value reached exactly zero: relative friction undefined"))).otherwise(v)) \
        .withColumn("V_prev", capital * F.col("V_prev")).drop("_growth")


def _trades(panel: DataFrame, values: DataFrame, cfg: BacktestConfig, costs: CostModel,
            slippage: SlippageModel) -> DataFrame:
    s = cfg.strategy_col
    t = panel.join(values.select(s, "k", "V", "V_prev"), [s, "k"])
    t = t.withColumn("shares", F.when(F.col("w_eff") != 0, F.col("w_eff") * F.col("V") / F.col("p")).otherwise(F.lit(0.0)))
    t = t.withColumn("prev_shares", F.when(F.col("w_prev") != 0, F.col("w_prev") * F.col("V_prev") / F.col("p_prev"))
                     .otherwise(F.lit(0.0)))
    t = t.withColumn("trade_shares", F.col("shares") - F.col("prev_shares"))
    traded = F.abs(F.col("trade_shares")) >= MIN_TRADE_SHARES
    exec_p = slippage.apply(F.col("p"), F.col("trade_shares"))
    t = t.withColumn("exec_price", F.when(traded, exec_p))
    t = t.withColumn("notional", F.when(traded, F.col("exec_price") * F.col("trade_shares")).otherwise(F.lit(0.0)))
    t = t.withColumn("cost", F.when(traded, costs.estimate(F.col("notional"))).otherwise(F.lit(0.0)))
    slip = F.when(traded, (F.col("exec_price") - F.col("p")) * F.col("trade_shares")).otherwise(F.lit(0.0))
    return t.withColumn("friction", slip + F.col("cost"))


def _friction(panel: DataFrame, gross: DataFrame, cfg: BacktestConfig, costs: CostModel, slippage: SlippageModel,
              last_k: int) -> tuple[DataFrame, int]:
    """(relative friction per (strategy, k), passes): the fixed point, strategy by strategy.

    Pass p makes time p - 1 exact (friction at k needs the values at k and k - 1 only), so
    ``last_k`` + 2 passes are always enough. A strategy whose friction has stopped moving is
    final and leaves the following passes. A pass is one job: the write of its frictions also
    counts the times that still move."""
    s = cfg.strategy_col
    scratch = Scratch(panel.sparkSession, "friction")
    open_panel, open_gross, fric, final, passes = panel, gross, None, None, 0
    while True:
        vals = _values(open_gross, fric, cfg, last_k)
        new = (_trades(open_panel, vals, cfg, costs, slippage).groupBy(s, "k")
               .agg((F.sum("friction") / F.any_value("V")).alias("f")))
        old = F.lit(0.0) if fric is None else F.coalesce("_f_old", F.lit(0.0))
        if fric is not None:
            new = new.join(fric.withColumnRenamed("f", "_f_old"), [s, "k"], "left")
        moving = Observation(f"pass{passes}")
        new = (new.select(s, "k", "f", (F.abs(F.col("f") - old) >= cfg.tolerance).alias("moves"))
               .observe(moving, F.count_if("moves").alias("n")))
        new = scratch.save(new, f"pass{passes}")
        still = new.where("moves").select(s).distinct()
        passes += 1
        fric = new.select(s, "k", "f")
        done = fric.join(still, s, "left_anti")
        final = done if final is None else final.unionByName(done)
        if not moving.get["n"]:
            return final, passes
        if passes >= last_k + 2:
            raise RuntimeError(f"the cost fixed point still moves after {passes} passes, more than it needs")
        fric = fric.join(still, s, "left_semi")
        open_panel, open_gross = panel.join(still, s, "left_semi"), gross.join(still, s, "left_semi")


@dataclass
class BacktestResult:
    panel: DataFrame
    trades: DataFrame
    equity: DataFrame      # strategy, k, timestamp, portfolio_value, period_return
    passes: int
    last_k: int

    def summary(self, cfg: BacktestConfig) -> DataFrame:
        return summarise(self.equity, cfg, self.last_k)


def run_backtest(signals: DataFrame, prices: DataFrame, master: DataFrame, cfg: BacktestConfig,
                 costs: CostModel | None = None, slippage: SlippageModel | None = None,
                 index_members: DataFrame | None = None, checkpoint: bool = True) -> BacktestResult:
    """Panel -> trades -> NAV for every strategy in ``signals``."""
    costs = costs or CostModel()
    slippage = slippage or SlippageModel()
    s = cfg.strategy_col
    times, last_k = numbered = _numbered(signals, cfg)
    if last_k is None:
        raise ValueError(f"no signal between {cfg.start_date} and {cfg.end_date}")
    panel = build_panel(signals, prices, master, cfg, index_members, numbered)
    if checkpoint:
        # clustered by (strategy, k), like the joins and sums of the passes, then a reliable
        # checkpoint (spark.checkpoint.dir) that keeps that partitioning, so the passes never
        # reshuffle the panel
        panel = checkpoint_keep_partitioning(panel.repartition(s, "k"))
    # every rebalance time keeps a NAV point, even when all its signals were gated out
    gross = (times.join(panel.groupBy(s, "k").agg(F.sum("contrib").alias("G")), [s, "k"], "left")
             .withColumn("G", F.coalesce("G", F.lit(0.0))))
    if checkpoint:
        gross = materialize(gross, "gross")   # one row per (strategy, time), read by every pass
    fric, passes = None, 0
    if not (costs.free and slippage.bps == 0):
        fric, passes = _friction(panel, gross, cfg, costs, slippage, int(last_k))
    vals = _values(gross, fric, cfg, last_k)
    trades = _trades(panel, vals, cfg, costs, slippage)
    paid = trades.groupBy(s, "k").agg(F.sum("friction").alias("F_k"))
    eq = (vals.join(paid, [s, "k"], "left")
          .select(s, "k", "timestamp", (F.col("V") - F.coalesce("F_k", F.lit(0.0))).alias("portfolio_value")))
    if checkpoint:
        eq = materialize(eq, "equity")
    eq = segmented_scan(eq, [s], "k", [Scan("lag", "portfolio_value", "_before")], cfg.block, last_k)
    prev = F.coalesce("_before", F.lit(float(cfg.initial_capital)))
    eq = eq.withColumn("period_return", F.when(prev == 0, F.lit(0.0)).otherwise(F.col("portfolio_value") / prev - 1))
    equity = eq.select(s, "k", "timestamp", "portfolio_value", "period_return")
    return BacktestResult(panel, trades, equity, passes, int(last_k))


# --------------------------------------------------------------------------
# W11, A11 drawdown and summary
# --------------------------------------------------------------------------
def drawdown(equity: DataFrame, strategy_col: str = "strategy", value_col: str = "portfolio_value",
             block: int = BLOCK, last_k: int | None = None) -> DataFrame:
    """Running peak and drawdown v/peak - 1 (0 while the peak is <= 0)."""
    return (segmented_scan(equity, [strategy_col], "k", [Scan("max", value_col, "peak")], block, last_k)
            .withColumn("drawdown", F.when(F.col("peak") > 0, F.col(value_col) / F.col("peak") - 1)
                        .otherwise(F.lit(0.0))))


def summarise(equity: DataFrame, cfg: BacktestConfig, last_k: int | None = None) -> DataFrame:
    """Per strategy. Returns exclude the first period (Q7); std ddof 1,
    0 when fewer than two; volatility and Sharpe annualised by sqrt(252)."""
    s = cfg.strategy_col
    dd = drawdown(equity, s, block=cfg.block, last_k=last_k)
    r = F.when(F.col("k") >= 1, F.col("period_return"))
    std = F.coalesce(F.stddev_samp(r), F.lit(0.0))
    agg = dd.groupBy(s).agg(
        F.min("timestamp").alias("start_date"), F.max("timestamp").alias("end_date"),
        F.min_by("portfolio_value", "k").alias("first_value"),
        F.max_by("portfolio_value", "k").alias("final_value"),
        std.alias("_std"), F.coalesce(F.avg(r), F.lit(0.0)).alias("_mean"),
        F.min("drawdown").alias("_mdd"))
    ann = math.sqrt(TRADING_DAYS)
    nz = (F.col("_std") != 0) & ~F.isnan("_std")
    return agg.select(
        s, "start_date", "end_date", F.lit(float(cfg.initial_capital)).alias("initial_capital"),
        "final_value",
        (F.col("final_value") / F.col("first_value") - 1).alias("total_return"),
        (F.col("final_value") / F.lit(float(cfg.initial_capital)) - 1).alias("return_on_capital"),
        F.when(nz, F.col("_std") * ann).otherwise(F.lit(0.0)).alias("annualised_volatility"),
        F.when(nz, F.col("_mean") / F.col("_std") * ann).otherwise(F.lit(0.0)).alias("sharpe_ratio"),
        F.abs(F.least(F.col("_mdd"), F.lit(0.0))).alias("max_drawdown"))


def write_reports(summary: DataFrame, equity: DataFrame, out_dir: str, run_id: str,
                  strategy_col: str = "strategy") -> None:
    """K7: metrics as JSON and the equity curve as CSV, partitioned by
    strategy and run_id (no clock in file names, Q13)."""
    base = out_dir.rstrip("/")
    summary.withColumn("run_id", F.lit(run_id)).write.mode("append") \
        .partitionBy("run_id", strategy_col).json(f"{base}/metrics")
    equity.withColumn("run_id", F.lit(run_id)).write.mode("append").option("header", True) \
        .partitionBy("run_id", strategy_col).csv(f"{base}/equity")
