"""Corporate actions."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import ieee_div
from .schema import require_columns, with_defaults

KEYS = ["symbol", "ex_date"]
DEFAULTS = {"split_ratio": (1.0, T.DoubleType()), "cash_dividend": (0.0, T.DoubleType()),
            "close": (None, T.DoubleType())}


def _split_factor_frame(ratio: Column) -> Column:
    return ieee_div(F.lit(1.0), F.when(ratio == 0, F.lit(1.0)).otherwise(ratio))


def _dividend_factor_frame(div: Column, close: Column) -> Column:
    # NULL dividend with a known close stays NULL (three-valued OR), as in the reference
    return F.when((div == 0) | close.isNull(), F.lit(1.0)).otherwise(F.lit(1.0) - ieee_div(div, close))


def _split_factor_safe(ratio: Column) -> Column:
    return F.when(ratio.isNull() | (ratio == 0), F.lit(1.0)).otherwise(F.lit(1.0) / ratio)


def _dividend_factor_safe(div: Column, close: Column) -> Column:
    bad = div.isNull() | (div == 0) | close.isNull() | (close == 0)
    return F.when(bad, F.lit(1.0)).otherwise(F.lit(1.0) - div / close)


def compute_adjustment_factors(df: DataFrame, null_safe: bool = False) -> DataFrame:
    """N1 (frame rules, default) or N2 (record rules, ``null_safe=True``):
    split_factor, dividend_factor and their product adjustment_factor."""
    require_columns(df, KEYS, "Corporate action frame")
    df = with_defaults(df, DEFAULTS)
    r, d, c = F.col("split_ratio"), F.col("cash_dividend"), F.col("close")
    if null_safe:
        sf, dfac = _split_factor_safe(r), _dividend_factor_safe(d, c)
    else:
        sf, dfac = _split_factor_frame(r), _dividend_factor_frame(d, c)
    return (df.withColumn("split_factor", sf)
              .withColumn("dividend_factor", dfac)
              .withColumn("adjustment_factor", F.col("split_factor") * F.col("dividend_factor")))


def latest_actions(batches: Sequence[DataFrame], order_col: str | None = None) -> DataFrame:
    """Keyed overwrite, last write wins: later batches replace earlier ones
    for the same (symbol, ex_date). Within one batch the row with the greatest
    ``order_col`` wins (Spark rows have no input order)."""
    parts = []
    for i, b in enumerate(batches):
        require_columns(b, KEYS, "Corporate action frame")
        b = with_defaults(b, {"split_ratio": (None, T.DoubleType()), "cash_dividend": (None, T.DoubleType()),
                              "close": (None, T.DoubleType())})
        b = b.select(*KEYS, "split_ratio", "cash_dividend", "close",
                     F.lit(i).alias("_batch"),
                     (F.col(order_col) if order_col else F.lit(0)).alias("_ord"))
        parts.append(b)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    row = F.struct("split_ratio", "cash_dividend", "close")
    return (u.groupBy(*KEYS).agg(F.max_by(row, F.struct("_batch", "_ord")).alias("_r"))
             .select(*KEYS, "_r.*"))


def actions_table(batches: Sequence[DataFrame], order_col: str | None = None) -> DataFrame:
    """The store as a frame with the record-rule factor."""
    latest = latest_actions(batches, order_col)
    return compute_adjustment_factors(latest, null_safe=True).drop("split_factor", "dividend_factor")


def lookup_factors(keys_df: DataFrame, actions: DataFrame, symbol_col: str = "symbol",
                   date_col: str = "ex_date") -> DataFrame:
    """Factor for each (symbol, date) of ``keys_df``; no action -> 1.0.
    A left equi join; Spark/AQE choose broadcast only when the action table
    is measured small."""
    a = actions.select(F.col("symbol").alias("_s"), F.col("ex_date").alias("_d"), "adjustment_factor")
    j = keys_df.join(a, (F.col(symbol_col) == F.col("_s")) & (F.col(date_col) == F.col("_d")), "left")
    return j.drop("_s", "_d").withColumn("adjustment_factor", F.coalesce("adjustment_factor", F.lit(1.0)))


def persist_actions(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: all records with their factor to Parquet."""
    table.write.mode(mode).parquet(path)
