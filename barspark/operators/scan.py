"""Running values over a long ordered key, in two levels.

A running product, maximum, sum or last value over a whole key is one task per key when it
is a plain window. The operators here are associative, so they are scanned in two levels:
inside blocks of ``block`` consecutive index values (a window per (key, block)), and over a
carry table with one row per block. Block and carry meet in a join on (key, block), which
shares the window's partitioning: rows are shuffled once.

The index is a long per key, not necessarily dense (missing values are fine); rows of one
index value are one step each, in any order. Keys are not null.
"""
from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 50_000
BLK = "_blk"


class Scan(NamedTuple):
    """``kind`` of ``column`` up to and including each row, as ``out``. ``product_before`` leaves
    the row itself out; ``last`` is the last non-null value; ``lag`` is the previous row's value."""

    kind: str
    column: str
    out: str


def _of_block(s: Scan, index: str) -> Column:
    c = F.col(s.column)
    if s.kind in ("product", "product_before"):
        return F.product(c)
    if s.kind == "last":
        return F.max_by(c, F.when(c.isNotNull(), F.col(index)))
    if s.kind == "lag":
        return F.max_by(F.struct(c.alias("v")), F.col(index))   # a struct keeps a null value apart from no row
    return {"max": F.max, "sum": F.sum}[s.kind](c)


def _inside(s: Scan, order: Window) -> Column:
    c = F.col(s.column)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    if s.kind == "product":
        return F.product(c).over(upto)
    if s.kind == "product_before":
        return F.coalesce(F.product(c).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1.0))
    if s.kind == "last":
        return F.last(c, ignorenulls=True).over(upto)
    if s.kind == "lag":
        return F.lag(F.struct(c.alias("v")), 1).over(order)
    return {"max": F.max, "sum": F.sum}[s.kind](c).over(upto)


def _carried(s: Scan, blocks: Window) -> Column:
    c = F.col(s.out)
    if s.kind in ("product", "product_before"):
        return F.product(c).over(blocks)
    if s.kind in ("last", "lag"):
        return F.last(c, ignorenulls=True).over(blocks)
    return {"max": F.max, "sum": F.sum}[s.kind](c).over(blocks)


def _combined(s: Scan, carry: Column) -> Column:
    own = F.col(s.out)
    if s.kind in ("product", "product_before"):
        return F.when(own.isNull(), carry).otherwise(own * F.coalesce(carry, F.lit(1.0)))
    if s.kind == "sum":
        return F.when(own.isNull(), carry).otherwise(own + F.coalesce(carry, F.lit(0)))
    return F.greatest(own, carry) if s.kind == "max" else F.coalesce(own, carry)


def block_of(index: str, block: int) -> Column:
    return F.floor(F.col(index) / block).cast("long")


def segmented_scan(df: DataFrame, keys: Sequence[str], index: str, scans: Sequence[Scan],
                   block: int = BLOCK, last_index: int | None = None) -> DataFrame:
    """``df`` with a column per scan, in order of ``index`` within ``keys``. ``df`` is read twice
    (for the carries, for the rows). A frame already shuffled by ``keys`` and a column ``_blk``
    of ``block_of`` is not shuffled again. Where the caller knows the greatest index, an index below
    ``block`` means one block per key, and no carries are made."""
    keys = list(keys)
    part = [*keys, BLK]
    cut = df if BLK in df.columns else df.withColumn(BLK, block_of(index, block))
    order = Window.partitionBy(*part).orderBy(index)
    rows = cut.select("*", *(_inside(s, order).alias(s.out) for s in scans))
    if last_index is None or last_index >= block:
        before = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
        carry = (cut.groupBy(*part).agg(*(_of_block(s, index).alias(s.out) for s in scans))
                 .select(*(F.col(c).alias(f"_r_{c}") for c in part), *(_carried(s, before).alias(f"_c_{s.out}") for s in scans)))
        rows = rows.join(carry, [F.col(c) == F.col(f"_r_{c}") for c in part], "left")
        for s in scans:
            rows = rows.withColumn(s.out, _combined(s, F.col(f"_c_{s.out}")))
        rows = rows.drop(*(f"_r_{c}" for c in part), *(f"_c_{s.out}" for s in scans))
    for s in scans:
        if s.kind == "lag":
            rows = rows.withColumn(s.out, F.col(f"{s.out}.v"))
    return rows.drop(BLK)
