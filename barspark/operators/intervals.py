"""Interval joins as equi joins on dyadic segments.

An interval of whole numbers (days, buckets) is cut into segments ``[s * 2**l, (s + 1) * 2**l)``:
at most two per level, so an interval has O(log span) rows whatever its length. A point lies
in one segment per level. Both sides carry (level, segment) and meet in a plain equi join, in
which a point and an interval that holds it meet exactly once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import epoch_us

DAY_US = 86_400_000_000
LEVELS = 30
LEVEL, SEGMENT = "_level", "_segment"
_NODES = "array<struct<level:int,segment:bigint>>"


def day_of(timestamp: str | Column) -> Column:
    """Days since the epoch, also before it."""
    us, day = epoch_us(timestamp), F.lit(DAY_US)
    return F.call_function("div", us - F.pmod(us, day), day)


def segments(lo: Column, hi: Column) -> Column:
    """The segments of ``lo``..``hi`` (both included, less than 2**30 apart); none where hi < lo or
    either is null."""
    state = F.struct(lo.cast("long").alias("a"), (hi.cast("long") + 1).alias("b"), F.array().cast(_NODES).alias("out"))

    def level(acc: Column, lev: Column) -> Column:
        left = (acc["a"] < acc["b"]) & (acc["a"].bitwiseAND(1) == 1)
        a = acc["a"] + left.cast("long")
        right = (a < acc["b"]) & (acc["b"].bitwiseAND(1) == 1)
        b = acc["b"] - right.cast("long")

        def node(taken: Column, segment: Column) -> Column:
            one = F.array(F.struct(lev.alias("level"), segment.alias("segment"))).cast(_NODES)
            return F.when(taken, one).otherwise(F.array().cast(_NODES))
        out = F.concat(acc["out"], node(left, acc["a"]), node(right, b))
        return F.struct(F.shiftright(a, 1).alias("a"), F.shiftright(b, 1).alias("b"), out.alias("out"))

    cut = F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), state, level, lambda acc: acc["out"])
    return F.when(lo <= hi, cut).otherwise(F.array().cast(_NODES))


def join_points(points: DataFrame, point: Column, intervals: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """``points`` with each row of ``intervals`` whose ``lo``..``hi`` holds ``point``. Column names of
    the two must differ. Points are spread over the levels that occur, not over all."""
    cut = (intervals.withColumn("_node", F.explode(segments(lo, hi)))
           .withColumn(LEVEL, F.col("_node.level")).withColumn(SEGMENT, F.col("_node.segment")).drop("_node"))
    levels = cut.select(LEVEL).distinct().agg(F.sort_array(F.collect_list(LEVEL)).alias("l")).scalar()
    spread = (points.withColumn("_point", point).withColumn(LEVEL, F.explode(levels))
              .withColumn(SEGMENT, F.call_function("shiftright", F.col("_point"), F.col(LEVEL))).drop("_point"))
    return spread.join(cut, [LEVEL, SEGMENT]).drop(LEVEL, SEGMENT)
