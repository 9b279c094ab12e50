"""Data-quality operators: gaps, duplicates, MAD outliers, alerts
(W1, W10, J1, A1-A7, P10, L3, O2)."""
from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import epoch_us, frequency_us
from . import sequence as sq
from .schema import require_columns
from .stats import exact_quantile, match, small

MAD_SCALE = 0.67448975  # fixed value: consistency constant of the reference's MAD score


# --------------------------------------------------------------------------
# W1 gaps
# --------------------------------------------------------------------------
def detect_time_gaps(df: DataFrame, timestamp_column: str, expected_frequency,
                     partition_by: Sequence[str] = (),
                     target_rows: int = sq.DEFAULT_TARGET_ROWS) -> DataFrame:
    """Adjacent (sorted, non-null, distinct) timestamps further apart than the
    expected frequency: start_timestamp, end_timestamp, gap (interval),
    gap_us, missing_intervals = max(delta // freq - 1, 0).

    With no ``partition_by`` gaps are global, as in the reference (another
    series' bar hides a gap); otherwise per key. The ``lead`` runs per
    (key, time bucket) with a one-row halo, so no key or global sequence
    is sorted in one task."""
    if timestamp_column not in df.columns:
        raise KeyError(f"no column {timestamp_column!r} to look for gaps in")
    freq = frequency_us(expected_frequency)
    keys = list(partition_by)
    ts = F.col(timestamp_column)
    distinct_ts = df.where(ts.isNotNull()).select(*keys, timestamp_column).distinct()
    seq = sq.index_sequence(distinct_ts, keys, timestamp_column, target_rows=target_rows)
    framed = sq.with_halo(seq, 0, 1)
    nxt = F.lead(timestamp_column, 1).over(seq.window())
    pairs = framed.select(*seq.part, sq.RN, sq.OWN, ts.alias("start_timestamp"), nxt.alias("end_timestamp"))
    pairs = sq.finish(pairs.where(F.col("end_timestamp").isNotNull()))
    delta = epoch_us("end_timestamp") - epoch_us("start_timestamp")
    return (pairs.withColumn("gap_us", delta)
                 .where(F.col("gap_us") > F.lit(freq))
                 .select(*keys, "start_timestamp", "end_timestamp",
                         (F.col("end_timestamp") - F.col("start_timestamp")).alias("gap"),
                         "gap_us",
                         F.greatest(F.expr(f"gap_us div {freq}") - 1, F.lit(0).cast("long"))
                          .alias("missing_intervals")))


def sample(df: DataFrame, order: Sequence[str | Column], n: int = 10) -> DataFrame:
    """L3: first ``n`` rows in ``order`` (top-k plan: TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


# --------------------------------------------------------------------------
# A1, J1, A2, W10 duplicates
# --------------------------------------------------------------------------
def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A1: rows per key (a null key is a group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def _all_keys_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once (null keys never match, as in an
    inner equi join). The repeated keys are found by a partial aggregate and
    the rows by a semi join, so a very frequent key is split by AQE's skew
    handling instead of being counted in one window partition."""
    keys = list(keys)
    dup = (df.where(_all_keys_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
             .where(F.col("_c") > 1).select(*keys))
    return df.join(dup, on=keys, how="left_semi")


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A2: one row: duplicate_keys, collapsed_count (every row of a repeated
    key, as the reference reports) and removed_count (rows a collapse drops)."""
    counts = df.where(_all_keys_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    d = counts.where(F.col("_c") > 1)
    return d.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                 F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("collapsed_count"),
                 F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("removed_count"))


def collapse_duplicates(df: DataFrame, subset: Sequence[str], order_by: Sequence[str] | None = None,
                        tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per ``subset`` key.

    With ``order_by``: the last row in (order_by, tie_break) order, as a sort
    then keep-last would give (nulls order first). Without: the first row in
    ``tie_break`` order, or any row when no tie-break is given (Spark rows
    have no input order). Keys with NULLs collapse together.

    Implemented as ``max_by``/``min_by`` of the whole row over the key: a
    partial aggregate, so a hot key is combined map-side, never gathered.
    """
    subset = list(subset)
    if not subset:
        return df
    require_columns(df, subset, "Duplicate collapse")
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    rank_cols = list(order_by or []) + list(tie_break or [])
    if order_by:
        pick = F.max_by(row, F.struct(*rank_cols))
    elif tie_break:
        pick = F.min_by(row, F.struct(*rank_cols))
    else:
        return df.dropDuplicates(subset)
    return df.groupBy(*subset).agg(pick.alias("_r")).select("_r.*").select(*cols)


# --------------------------------------------------------------------------
# A4-A7, P10 MAD outliers
# --------------------------------------------------------------------------
@dataclass
class MadResult:
    scored: DataFrame    # input + <col>_score per column + is_outlier
    summary: DataFrame   # column, median, mad, outliers

    @property
    def clean(self) -> DataFrame:
        return self.scored.where(~F.col("is_outlier"))

    @property
    def quarantined(self) -> DataFrame:
        return self.scored.where(F.col("is_outlier"))


def column_median(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """A4: exact interpolated median of the non-strictly-cast column (per
    group when ``by`` is given)."""
    return exact_quantile(df, F.col(column).try_cast("double"), 0.5, by=by, alias="median")


def column_mad(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """A5: median and median absolute deviation from it (per group). Global
    statistics reach the deviation pass as a scalar subquery."""
    by = list(by)
    x = F.col(column).try_cast("double")
    med = small(column_median(df, column, by))
    if not by:
        m = med.select("median").scalar()
        dev = df.select(F.abs(x - m).alias("_d"))
        mad = exact_quantile(dev, "_d", 0.5, alias="mad")
        return small(mad.select(m.alias("median"), "mad"))
    dev = match(df.select(*by, x.alias("_x")), med, by).select(*by, F.abs(F.col("_x") - F.col("median")).alias("_d"))
    mad = exact_quantile(dev, "_d", 0.5, by=by, alias="mad")
    return small(match(med, mad, by, "left").select(*by, "median", "mad"))


def mad_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 3.5,
                 by: Sequence[str] = ()) -> MadResult:
    """Flag rows whose robust score |x - median| / MAD * 0.67448975 exceeds
    ``threshold`` in any listed column. Absent columns are ignored; values are
    cast non-strictly (text -> NULL); NULL and NaN scores never flag; a column
    whose MAD is 0 or NULL is skipped. Statistics are global (scalar
    subqueries, no join) or per group of ``by`` (e.g. per source file)."""
    by = list(by)
    present = [c for c in columns if c in df.columns]
    scored = df
    flags: list[Column] = []
    summaries = []
    for c in present:
        stats = column_mad(df, c, by)
        if by:
            scored = match(scored, stats.select(*by, F.col("median").alias(f"_med_{c}"),
                                                F.col("mad").alias(f"_mad_{c}")), by, "left")
        else:
            scored = scored.withColumn(f"_med_{c}", stats.select("median").scalar()) \
                           .withColumn(f"_mad_{c}", stats.select("mad").scalar())
        x = F.col(c).try_cast("double")
        usable = F.col(f"_mad_{c}").isNotNull() & (F.col(f"_mad_{c}") != 0)
        score = F.when(usable, F.abs(x - F.col(f"_med_{c}")) / F.col(f"_mad_{c}") * F.lit(MAD_SCALE))
        scored = scored.withColumn(f"{c}_score", score)
        flag = F.coalesce(F.when(F.isnan(f"{c}_score"), F.lit(False))
                           .otherwise(F.col(f"{c}_score") > F.lit(threshold)), F.lit(False))
        scored = scored.withColumn(f"_flag_{c}", flag)
        flags.append(F.col(f"_flag_{c}"))
    is_out = F.lit(False)
    for f in flags:
        is_out = is_out | f
    scored = scored.withColumn("is_outlier", is_out)
    for c in present:
        summaries.append(scored.groupBy(*by, F.col(f"_med_{c}").alias("median"), F.col(f"_mad_{c}").alias("mad"))
                         .agg(F.count(F.when(F.col(f"_flag_{c}"), 1)).alias("outliers"))
                         .where(F.col("mad").isNotNull() & (F.col("mad") != 0))
                         .select(*by, F.lit(c).alias("column"), "median", "mad", "outliers"))
    helper = [f"_med_{c}" for c in present] + [f"_mad_{c}" for c in present] + [f"_flag_{c}" for c in present]
    scored = scored.drop(*helper)
    if summaries:
        summary = summaries[0]
        for s in summaries[1:]:
            summary = summary.unionByName(s)
    else:
        spark = df.sparkSession
        summary = spark.createDataFrame([], "column string, median double, mad double, outliers long")
    return MadResult(scored, summary)


def mad_outlier_quarantine(df: DataFrame, columns: Sequence[str], threshold: float = 3.5,
                           by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """P10: (clean, quarantined); no columns -> (input, empty)."""
    if not columns:
        return df, df.limit(0)
    r = mad_outliers(df, columns, threshold, by)
    cols = df.columns
    return r.clean.select(*cols), r.quarantined.select(*cols)


# --------------------------------------------------------------------------
# O2 alerts
# --------------------------------------------------------------------------
ALERT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("threshold", T.LongType()),
    T.StructField("fired", T.BooleanType()),
    T.StructField("severity", T.StringType()),
])


def alert_rows(counts: dict[str, DataFrame], thresholds: dict[str, int] | None = None,
               severity: str = "error") -> DataFrame:
    """One alert row per check: ``counts[check]`` is a one-row frame with a
    ``count`` column; fired when count > threshold (default 0)."""
    thresholds = thresholds or {}
    parts = []
    for check, cdf in counts.items():
        th = int(thresholds.get(check, 0))
        parts.append(cdf.select(F.lit(check).alias("check"), F.col("count").cast("long").alias("count"),
                                F.lit(th).cast("long").alias("threshold"),
                                (F.col("count") > F.lit(th)).alias("fired"),
                                F.lit(severity).alias("severity")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
