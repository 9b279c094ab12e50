"""Skew-safe ordered sequences.

Row-ordered windows (rolling statistics, lags, leads, forward fill, EMA, gaps)
are normally written ``Window.partitionBy(symbol).orderBy(ts)``. That puts one
symbol in one task; a symbol holding a third of the rows would then be a third
of the job in a single task. Instead every key with more than ``target_rows``
rows is cut by *rank* into buckets of about that many rows, so a burst, or one
instant with many rows, is split like any other stretch:

1. Rows are counted per key, unless the caller knows a bound (``Size``). With no
   key above the target the plain per-key windows are already bounded, and are
   used. Rows are shuffled into as many tasks as ``PART_ROWS`` asks for, so a
   task's windows hold as many rows at every size of the input.
2. Bounds: a row's place is (time, tie-break, hash of the row). A mergeable
   sample keeps the places whose hash falls under ``OVERSAMPLE`` in
   ``target_rows``; every ``OVERSAMPLE``-th of a key's sorted sample is a bound.
   The rate gives a bucket its target with a deviation of 1 in 8, whatever the
   distribution; sampling is by content, so every pass finds the same bounds.
   Only the bounds are sampled: every row gets a bucket.
3. A row's bucket is found by binary search in its key's bounds. The target
   grows with the input so that at most ``MAX_BUCKETS`` bounds exist in all:
   the tables of bounds and of split buckets have a proven size, are written
   once and broadcast at every scale, and rows are shuffled once, by
   (key, bucket), for the windows.
4. ``_rn``: global 0-based position of the row inside its key = rows in the
   key's earlier buckets + ``row_number`` inside (key, bucket).
5. ``with_halo``: a bounded frame needs the last ``lookback`` rows of the
   preceding buckets (and the first ``lookahead`` rows of the following ones).
   Only those boundary rows are copied into the neighbouring buckets, marked
   ``_own = false``; windows then run per (key, bucket) and the copies are
   dropped afterwards.

Rows that are equal in every column have one place and stay in one bucket;
null keys and null times are values like others (nulls first). Nothing here
collects data or loops on the driver.
"""
from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

RN, BKT, OWN, BO, GK = "_rn", "_bkt", "_own", "_bo", "_gk"
DEFAULT_TARGET_ROWS = 1_000_000
OVERSAMPLE = 64         # sampled places per target_rows
MAX_BUCKETS = 200_000   # bounds over all keys: beyond, buckets grow with the input
PART_ROWS = 1 << 18     # rows per task of the windows, about


class Size(NamedTuple):
    """Rows of the largest key and of all keys, or bounds of them (a frame made of some of the rows)."""

    most: int
    rows: int


@dataclass
class Sequenced:
    """A frame with ``_bkt`` and ``_rn`` plus its bucket table."""

    frame: DataFrame
    buckets: DataFrame  # keys, _bkt, _bo (bucket ordinal), _n, _off
    keys: list[str]
    split: DataFrame | None = None  # the buckets of keys with several; None: plain per-key windows
    rows: int = 0                   # at most so many rows

    @property
    def single(self) -> bool:
        return self.split is None

    @property
    def part(self) -> list[str]:
        return [*self.keys, BKT]

    def window(self) -> Window:
        return Window.partitionBy(*self.part).orderBy(RN)


def size_of(df: DataFrame, keys: Sequence[str]) -> Size:
    return _largest(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn")))


def _largest(counts: DataFrame) -> Size:
    top = counts.agg(F.max("_kn").alias("most"), F.sum("_kn").alias("rows")).first()
    return Size(top["most"] or 0, top["rows"] or 0)


def spread(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """``df`` shuffled by ``by`` into tasks of about ``PART_ROWS`` rows, however many there are (Spark's own
    number of shuffle partitions is fixed). Small frames are left to Spark."""
    if rows <= PART_ROWS or list(by) == [GK]:
        return df
    return df.repartition(max(-(-rows // PART_ROWS), df.sparkSession.sparkContext.defaultParallelism), *by)


def with_small(df: DataFrame, small: DataFrame, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Join with a table of at most about ``MAX_BUCKETS`` rows: broadcast, nulls equal nulls."""
    right = small
    for c in cols:
        right = right.withColumnRenamed(c, f"_r_{c}")
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols])
    return df.join(F.broadcast(right), on, how).drop(*(f"_r_{c}" for c in cols))


def _places(df: DataFrame, time_col: str, order: Sequence[str | Column]) -> Column:
    """What orders the rows of a key, ascending, as one value."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)]
    own = [F.col(time_col), *(F.col(o) if isinstance(o, str) else o for o in order), F.xxhash64(*plain)]
    return F.struct(*(c.alias(f"c{i}") for i, c in enumerate(own)))


def _holds_map(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _holds_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_holds_map(f.dataType) for f in t.fields)
    return isinstance(t, (T.MapType, T.VariantType))


def rank_bounds(df: DataFrame, keys: Sequence[str], place: Column, large: DataFrame, target: int) -> DataFrame:
    """(keys, _cuts): sorted places that begin the second and later buckets of each key of
    ``large`` (keys), about ``target`` rows apart."""
    step = min(OVERSAMPLE, target)
    sample = (with_small(df.select(*keys, place.alias("_p")).where(F.pmod(F.xxhash64("_p"), F.lit(target)) < step), large, keys, "inner"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_p"))
    return (sample.withColumn("_i", nth).where(F.col("_i") % step == 0)
            .groupBy(*keys).agg(F.sort_array(F.collect_set("_p")).alias("_cuts")))


def _bucket(cuts: str, place: Column, most: int) -> Column:
    """Number of ``cuts`` (sorted, at most ``most``) at or before ``place``, by binary search."""
    steps = F.array(*(F.lit(1 << k).cast("long") for k in range(most.bit_length() - 1, -1, -1)))
    found = F.aggregate(steps, F.lit(0).cast("long"), lambda at, step: F.when(
        F.get(F.col(cuts), (at + step - 1).cast("int")) <= place, at + step).otherwise(at))
    return F.when(F.col(cuts).isNull(), F.lit(0).cast("long")).otherwise(found)


def index_sequence(df: DataFrame, keys: Sequence[str], time_col: str,
                   order: Sequence[str | Column] | None = None,
                   target_rows: int = DEFAULT_TARGET_ROWS, size: Size | None = None) -> Sequenced:
    """Add ``_bkt`` (bucket id within key) and ``_rn`` (0-based row index within
    key, ordered by ``time_col`` then ``order``, both ascending, as tie-break).

    ``df`` is read once for its counts (not where ``size`` tells that no key exceeds the target)
    and once for the rows; where keys are cut, twice more."""
    keys = list(keys)
    if not keys:  # one global sequence
        df, keys = df.withColumn(GK, F.lit(0)), [GK]
    order = list(order or [])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn"))
    zero = F.lit(0).cast("long")
    whole = counts.select(*keys, zero.alias(BKT), zero.alias(BO), F.col("_kn").alias("_n"), zero.alias("_off"))
    if size is None or size.most > target_rows:
        size = _largest(counts)
    if size.most <= target_rows:
        w = Window.partitionBy(*keys).orderBy(F.col(time_col), *(F.col(o) if isinstance(o, str) else o for o in order))
        frame = spread(df, keys, size.rows).withColumn(BKT, zero).withColumn(RN, (F.row_number().over(w) - 1).cast("long"))
        return Sequenced(frame, whole, keys, rows=size.rows)
    target = max(target_rows, -(-size.rows // MAX_BUCKETS))
    place = _places(df, time_col, order)
    large = counts.where(F.col("_kn") > target).select(*keys)
    cuts = materialize(rank_bounds(df, keys, place, large, target), "cuts")
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
    based = with_small(df, cuts, keys).withColumn(BKT, _bucket("_cuts", place, most))
    wk = Window.partitionBy(*keys).orderBy(BKT)
    split = materialize(
        based.where(F.col("_cuts").isNotNull()).groupBy(*keys, BKT).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(BO, (F.row_number().over(wk) - 1).cast("long"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)), zero))
        .select(*keys, BKT, BO, "_n", "_off"), "buckets")
    joined = spread(with_small(based.drop("_cuts"), split.select(*keys, BKT, "_off"), [*keys, BKT]), [*keys, BKT], size.rows)
    w = Window.partitionBy(*keys, BKT).orderBy(place)
    frame = (joined.withColumn(RN, (F.coalesce("_off", zero) + F.row_number().over(w) - 1).cast("long")).drop("_off"))
    rest = with_small(whole, cuts.select(*keys), keys, "left_anti")
    return Sequenced(frame, rest.unionByName(split), keys, split, size.rows)


def forward_fill(seq: Sequenced, column: str, out: str) -> Sequenced:
    """``out`` = last non-null ``column`` at or before each row (per key).

    Inside a bucket: ``last(ignorenulls)``; across buckets: the last non-null
    value of every earlier bucket, carried by a window over the bucket table.
    """
    keys = seq.keys
    local = F.last(column, ignorenulls=True).over(
        seq.window().rowsBetween(Window.unboundedPreceding, 0))
    if seq.single:
        return replace(seq, frame=seq.frame.withColumn(out, local))
    slots = seq.split.select(*keys, BKT)
    per_bucket = (with_small(seq.frame.where(F.col(column).isNotNull()).select(*keys, BKT, RN, column), slots, [*keys, BKT], "inner")
                  .groupBy(*keys, BKT)
                  .agg(F.max_by(F.col(column), F.col(RN)).alias("_lastv")))
    wk = Window.partitionBy(*keys).orderBy(BKT).rowsBetween(Window.unboundedPreceding, -1)
    carry = (with_small(slots, materialize(per_bucket, "last"), [*keys, BKT])
             .withColumn("_carry", F.last("_lastv", ignorenulls=True).over(wk)).select(*keys, BKT, "_carry"))
    frame = (with_small(seq.frame, carry, [*keys, BKT])
             .withColumn(out, F.coalesce(local, F.col("_carry"))).drop("_carry"))
    return replace(seq, frame=frame)


def with_halo(seq: Sequenced, lookback: int, lookahead: int = 0) -> DataFrame:
    """Own rows (``_own`` true) plus copies of the rows that bounded frames of
    ``lookback`` preceding / ``lookahead`` following rows need from other
    buckets of the same key (``_own`` false).

    One pass: every row is joined with its bucket's entry of the table of split
    buckets (a broadcast of proven size; other keys have one bucket) and
    exploded into [its own bucket] + [the later buckets it can reach when it
    is among its bucket's last ``lookback`` rows] + [the earlier buckets it
    can reach when among the first ``lookahead``]. ``_bkt`` becomes the
    bucket ordinal. Buckets are normally far larger than the frame, so a
    boundary row reaches one neighbour; a copy reaching further back than a
    frame needs is harmless (windows only look ``lookback`` rows back)."""
    keys = seq.keys
    if seq.single or (lookback <= 0 and lookahead <= 0):
        return seq.frame.withColumn(OWN, F.lit(True))
    wk = Window.partitionBy(*keys)
    b = seq.split.withColumn("_end", F.col("_off") + F.col("_n"))
    if lookback > 0:
        c1 = F.count(F.lit(1)).over(wk.orderBy("_off").rangeBetween(0, lookback - 1))
        b = b.withColumn("_c1", c1).withColumn(
            "_reach_f", F.coalesce(F.lead("_c1", 1).over(wk.orderBy(BKT)), F.lit(0)))
    else:
        b = b.withColumn("_reach_f", F.lit(0).cast("long"))
    if lookahead > 0:
        c2 = F.count(F.lit(1)).over(wk.orderBy("_end").rangeBetween(-(lookahead - 1), 0))
        b = b.withColumn("_c2", c2).withColumn(
            "_reach_b", F.coalesce(F.lag("_c2", 1).over(wk.orderBy(BKT)), F.lit(0)))
    else:
        b = b.withColumn("_reach_b", F.lit(0).cast("long"))
    b = b.select(*keys, BKT, BO, "_off", "_end", "_reach_f", "_reach_b")
    cols = [c for c in seq.frame.columns if c != BKT]
    x = with_small(seq.frame, b, [*keys, BKT]).withColumn(BO, F.coalesce(BO, F.lit(0).cast("long")))
    rn = F.col(RN)
    own = F.array(F.struct(F.col(BO).alias("t"), F.lit(True).alias("own")))
    fwd = F.when((rn >= F.col("_end") - lookback) & (F.col("_reach_f") > 0),
                 F.transform(F.sequence(F.lit(1).cast("long"), F.col("_reach_f").cast("long")),
                             lambda j: F.struct((F.col(BO) + j).alias("t"), F.lit(False).alias("own"))))
    bwd = F.when((rn < F.col("_off") + lookahead) & (F.col("_reach_b") > 0),
                 F.transform(F.sequence(F.lit(1).cast("long"), F.col("_reach_b").cast("long")),
                             lambda j: F.struct((F.col(BO) - j).alias("t"), F.lit(False).alias("own"))))
    empty = F.array().cast("array<struct<t:bigint,own:boolean>>")
    targets = own.cast("array<struct<t:bigint,own:boolean>>")
    if lookback > 0:
        targets = F.concat(targets, F.coalesce(fwd, empty))
    if lookahead > 0:
        targets = F.concat(targets, F.coalesce(bwd, empty))
    copied = (x.select(*cols, F.explode(targets).alias("_t"))
               .select(*cols, F.col("_t.t").alias(BKT), F.col("_t.own").alias(OWN)))
    return spread(copied, seq.part, seq.rows)


def finish(df: DataFrame, keep_index: bool = False) -> DataFrame:
    """Drop halo copies and helper columns."""
    out = df.where(F.col(OWN)).drop(OWN, BKT, GK)
    return out if keep_index else out.drop(RN)
