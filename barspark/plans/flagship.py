"""Flagship job: bars -> dedupe -> outlier split -> features -> point-in-time
universe -> target weights -> rebalancing with costs -> NAV -> summary."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import portfolio as pf
from ..operators import quality as dq
from ..sources import fixtures as fx
from .config import DEFAULT_CONFIG


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = fx.bars(spark, sf_dir)
    deduped = dq.collapse_duplicates(bars, ["symbol", "timestamp"], order_by=["timestamp"],
                                     tie_break=["trade_count", "volume", "close"])
    clean, _ = dq.mad_outlier_quarantine(deduped, ["close"], 3.5)
    sup, names, target = feat.prepare_supervised(clean, DEFAULT_CONFIG, "basic_price")
    # target weights: the published signals, halved where the price is stretched
    # (|20-day z-score| > 2), so the gross weight stays within the signal's
    sig = fx.signals(spark, sf_dir).join(
        sup.select("symbol", "timestamp", "zscore_close_20"), ["symbol", "timestamp"], "left")
    sig = sig.withColumn("target_weight", F.col("target_weight") *
                         F.when(F.abs(F.col("zscore_close_20")) > 2, F.lit(0.5)).otherwise(F.lit(1.0)))
    cfg = pf.BacktestConfig(start_date="1995-01-01", end_date="2001-12-31", initial_capital=1_000_000.0)
    res = pf.run_backtest(sig.drop("zscore_close_20"), clean.select("timestamp", "symbol", "close"),
                          fx.symbol_master(spark, sf_dir), cfg,
                          pf.CostModel(bps=10.0), pf.SlippageModel(bps=5.0))
    return res.summary(cfg)
