"""Point-in-time universes."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import valid_at
from .intervals import day_of, join_points


def universe_as_of(master: DataFrame, as_of, index_members: DataFrame | None = None,
                   index_name: str | None = None) -> DataFrame:
    """Distinct symbols listed at ``as_of`` (and members of ``index_name`` at
    that instant when given)."""
    t = F.lit(as_of).cast("timestamp_ntz") if not hasattr(as_of, "_jc") else as_of
    u = master.where(valid_at("start_date", "end_date", t)).select("symbol").distinct()
    if index_name is None:
        return u
    m = index_members.where((F.col("index") == index_name) & valid_at("start_date", "end_date", t))
    return u.join(m.select("symbol"), "symbol", "left_semi")


#: Day that stands for an open end (year 9999; days keep intervals under 64 segments)
LAST_DAY = 2_932_896


def universe_at(master: DataFrame, instants: DataFrame, time_col: str = "timestamp",
                index_members: DataFrame | None = None, index_name: str | None = None) -> DataFrame:
    """(instant, symbol) for every instant of ``instants`` and every
    symbol valid at it. The validity interval is cut into dyadic segments of days
    (``intervals``) and meets the instants in an equi join, the exact bounds are a
    residual: no nested-loop join, and a few rows per interval, however long."""
    inst = instants.select(F.col(time_col).alias("_t")).distinct()
    m = master.select("symbol", "start_date", "end_date").where(F.col("start_date").isNotNull())
    end = F.coalesce(day_of("end_date"), F.lit(LAST_DAY).cast("long"))
    u = (join_points(inst, day_of("_t"), m, day_of("start_date"), end)
         .where(valid_at("start_date", "end_date", "_t"))
         .select(F.col("_t").alias(time_col), "symbol").distinct())
    if index_name is None:
        return u
    mem = index_members.where(F.col("index") == index_name).select(
        "symbol", F.col("start_date").alias("_ms"), F.col("end_date").alias("_me"))
    cond = (u.symbol == mem.symbol) & valid_at(mem._ms, mem._me, u[time_col])
    return u.join(mem, cond, "left_semi")


def gate_signals(signals: DataFrame, master: DataFrame, time_col: str = "timestamp",
                 index_members: DataFrame | None = None, index_name: str | None = None) -> DataFrame:
    """B1: drop signals whose symbol is not in the point-in-time universe (and
    index) at the signal's instant. Semi joins on symbol with the validity
    interval as a residual condition."""
    m = master.select(F.col("symbol").alias("_ms"), F.col("start_date").alias("_s0"),
                      F.col("end_date").alias("_s1"))
    out = signals.join(m, (signals.symbol == m._ms) & valid_at(m._s0, m._s1, signals[time_col]), "left_semi")
    if index_name is not None:
        mem = index_members.where(F.col("index") == index_name).select(
            F.col("symbol").alias("_is"), F.col("start_date").alias("_i0"), F.col("end_date").alias("_i1"))
        out = out.join(mem, (out.symbol == mem._is) & valid_at(mem._i0, mem._i1, out[time_col]), "left_semi")
    return out
