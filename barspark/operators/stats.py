"""Exact quantiles without one reducer holding every distinct value.

Spark's exact ``percentile``/``median`` aggregates merge a map of all distinct
values of a group into one task. Here a rank is found by selection in three
rounds, the same at every size; a round counts cells of an order-preserving
digit of the value and keeps the cell that holds the rank:

1. The first digit is a step on a logarithmic scale, ``STEPS`` per power of
   two, mirrored for negative values; zeros and infinities have cells of their
   own. Doubles have at most about 4.3 million such cells, whatever the
   distribution; a running count over them finds the cells of the wanted
   ranks, their ranks inside, and each cell's smallest and largest value.
2. The values of those cells (one or two per group) are counted by distinct
   value and written once. Their second digit is one of ``BINS`` equal widths
   between the cell's smallest and largest value; a running count again.
3. The distinct values of that bin are ranked. A first cell holds at most
   about 2^42 doubles, nearly evenly spaced, so a bin holds at most about
   2^22 distinct values.

All rounds are partial aggregates (a hot group, value or cell is combined
before the shuffle), the windows run over cells, and the input is read twice.
The values at ranks floor(q(n-1)) and ceil(q(n-1)) are interpolated linearly
(the median of an even count is the mean of the two middle values).
"""
from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

STEPS = 1024            # first digit: cells per power of two
BINS = 1 << 21          # second digit: equal widths within a first cell
_POWERS = 1076          # |log2| of a finite non-zero double is below this


def small(df: DataFrame) -> DataFrame:
    """Materialise a statistics table (one row per group or per bin) in the
    checkpoint directory: later passes read it instead of re-running the
    passes that produced it."""
    return materialize(df, "stats")


def exact_quantile(df: DataFrame, value: Column | str, q: float = 0.5, by: Sequence[str] = (),
                   alias: str = "quantile") -> DataFrame:
    """One row per group in ``by`` that has values, null keys included (one row
    overall when ``by`` is empty), with the exact, linearly interpolated ``q``
    quantile of the non-null values; NaN values are ignored. Without ``by``
    and without values the row holds NULL; an interpolation between opposite
    infinities is NaN."""
    keys = [f"_k{i}" for i in range(len(by))]
    v = F.col(value) if isinstance(value, str) else value
    base = (df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], v.cast("double").alias("_v"))
              .where(F.col("_v").isNotNull() & ~F.isnan("_v")).withColumn("_cell", _log_cell(F.col("_v"))))

    cells = base.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    pos = F.lit(float(q)) * (F.sum("_c").over(Window.partitionBy(*keys)) - 1)
    wanted = cells.withColumn("_pos", pos).withColumn("_ranks", F.array(F.floor("_pos"), F.ceil("_pos")))
    wanted = _holding(wanted, keys, "_cell", "_c").drop("_c")

    # without groups at most two cells are wanted: a broadcast of proven size; else Spark decides by the written size
    held = match(base, wanted if keys else F.broadcast(wanted), [*keys, "_cell"])
    held = (held.groupBy(*keys, "_cell", "_v")
                .agg(F.count(F.lit(1)).alias("_c"), *[F.first(c).alias(c) for c in ("_lo", "_hi", "_pos", "_ranks")]))
    held = materialize(held.withColumn("_bin", _linear_bin()), "quantile")

    part = [*keys, "_cell"]
    bins = held.groupBy(*part, "_bin").agg(F.sum("_c").alias("_c"), F.first("_ranks").alias("_ranks"))
    bins = _holding(bins, part, "_bin", "_c").drop("_c")
    last = match(held.drop("_ranks"), bins if keys else F.broadcast(bins), [*part, "_bin"])
    picked = _holding(last, [*part, "_bin"], "_v", "_c")

    frac = F.first("_pos", ignorenulls=True) - F.floor(F.first("_pos", ignorenulls=True))
    low, high = F.min("_v"), F.max("_v")
    result = F.when(low == high, low).otherwise((1 - frac) * low + frac * high)
    return picked.groupBy(*keys).agg(result.alias("_q")).select(
        *[F.col(k).alias(b) for b, k in zip(by, keys)], F.col("_q").alias(alias))


def _log_cell(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises: Java's logarithm, its scaling and the
    floor are all monotonic."""
    size = F.abs(v)
    step = F.floor(F.log2(size) * STEPS) + STEPS * _POWERS + 1
    infinite = F.lit(2 * STEPS * _POWERS).cast("long")
    cell = F.when(size == 0, F.lit(0).cast("long")).when(size == F.lit(float("inf")), infinite).otherwise(step)
    return F.when(v < 0, -cell).otherwise(cell)


def _linear_bin() -> Column:
    width = F.col("_hi") - F.col("_lo")
    return (F.when(F.col("_lo") == F.col("_hi"), F.lit(0).cast("long"))
             .otherwise(F.least(F.floor((F.col("_v") - F.col("_lo")) / width * BINS), F.lit(BINS - 1).cast("long"))))


def _holding(counted: DataFrame, part: Sequence[str], digit: str, count: str) -> DataFrame:
    """The rows of ``counted`` (one per ``digit`` in each ``part``, ``_ranks`` wanted there) that
    hold a wanted rank, with ``_ranks`` counted from the row's own first value."""
    upto = F.sum(count).over(Window.partitionBy(*part).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0))
    inside = F.filter(F.transform("_ranks", lambda r: r - F.col("_upto") + F.col(count)),
                      lambda r: (r >= 0) & (r < F.col(count)))
    return (counted.withColumn("_upto", upto).withColumn("_ranks", inside)
                   .where(F.size("_ranks") > 0).drop("_upto"))


def match(rows: DataFrame, wanted: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``wanted`` (one row per ``on``) and its other columns; nulls equal nulls."""
    extra = [c for c in wanted.columns if c not in on and c not in rows.columns]
    same = reduce(lambda x, y: x & y, [F.col(f"r.`{c}`").eqNullSafe(F.col(f"w.`{c}`")) for c in on])
    return rows.alias("r").join(wanted.alias("w"), same, how).select("r.*", *[F.col(f"w.`{c}`") for c in extra])
