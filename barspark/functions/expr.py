"""Column-expression helpers (all JVM-side, codegen friendly)."""
from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_div(num, den) -> Column:
    """IEEE-754 division: x/0 -> +-inf, 0/0 -> NaN, null in -> null.

    ANSI Spark raises on a zero divisor and ``try_divide`` gives NULL; the
    reference (Polars/NumPy) and the DuckDB oracle give inf/NaN.
    """
    n, d = col_(num).cast("double"), col_(den).cast("double")
    by_zero = (F.when(F.isnan(n) | (n == 0), F.lit(float("nan")))
               .when(n > 0, F.lit(INF))
               .otherwise(F.lit(-INF)))
    return F.when(d == 0, F.when(n.isNull(), F.lit(None).cast("double")).otherwise(by_zero)) \
            .otherwise(n / d)


def safe_cast(c, dtype) -> Column:
    """Non-strict cast: unparseable -> NULL (``try_cast``)."""
    dtype = dtype.simpleString() if isinstance(dtype, T.DataType) else dtype
    return col_(c).try_cast(dtype)


def strict_cast(c, dtype) -> Column:
    """Strict cast: under ANSI a bad value fails the job."""
    return col_(c).cast(dtype)


def sign(c) -> Column:
    """numpy.sign: -1/0/+1, NaN stays NaN, null stays null."""
    x = col_(c).cast("double")
    return F.when(F.isnan(x), F.lit(float("nan"))).otherwise(F.signum(x))


# --------------------------------------------------------------------------
# Frequencies
# --------------------------------------------------------------------------
_FREQ = re.compile(r"^\s*([0-9]*\.?[0-9]+)\s*(ms|s|m|h|d)\s*$", re.IGNORECASE)
_UNIT_US = {"ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}


def frequency_us(freq) -> int:
    """Parse '500ms', '1m', '1.5h', '1d' (or a timedelta) into microseconds."""
    if isinstance(freq, timedelta):
        return int(round(freq.total_seconds() * 1_000_000))
    m = _FREQ.match(str(freq))
    if not m:
        raise ValueError(f"Unsupported frequency specifier: {freq}")
    amount, unit = float(m.group(1)), m.group(2).lower()
    us = int(round(amount * _UNIT_US[unit]))
    if us <= 0:
        raise ValueError(f"Frequency must be positive: {freq}")
    return us


def epoch_us(c) -> Column:
    """Microseconds since epoch of a TIMESTAMP or TIMESTAMP_NTZ column."""
    x = col_(c)
    return F.unix_micros(x.cast("timestamp"))


# --------------------------------------------------------------------------
# Exchange-local time to UTC
# --------------------------------------------------------------------------
# a zone after a time of day: Z, an offset with or without minutes, or a zone name
_ZONED_RE = r"(?i)([0-9]:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]+)?)?|T[0-9]{1,2})\s*(Z|[+-][0-9]{1,2}(:?[0-9]{2})?|[a-z][a-z_]*(/[a-z_+0-9-]+)*)$"
_HOURS_RE = r"([+-])([0-9]{1,2})$"
# date and time of day and nothing else: the usual text, told apart without the costlier search above
_PLAIN_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9:.]*)?$"


def local_to_utc(c, dtype: T.DataType, zone: str = "Asia/Kolkata") -> Column:
    """Normalise a timestamp-like column to a UTC TIMESTAMP.

    * TIMESTAMP (instant)   -> unchanged (already an instant),
    * TIMESTAMP_NTZ (naive) -> read as wall time in ``zone``,
    * string                -> with an offset (+05:30, +0530, +05, Z) or a zone name (UTC,
                               Asia/Kolkata): that instant; without: wall time in
                               ``zone``; unparseable -> NULL.
    """
    x = col_(c)
    if isinstance(dtype, T.TimestampType):
        return x
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_utc_timestamp(x.cast("timestamp"), zone)
    if isinstance(dtype, T.DateType):
        return F.to_utc_timestamp(x.cast("timestamp"), zone)
    s = F.trim(x.cast("string"))
    # Spark's cast wants minutes in an offset: +5 and +05 become +05:00
    full = F.when(s.rlike(r"[:T][0-9.]+\s*[+-][0-9]{1,2}$"),
                  F.concat(F.regexp_replace(s, _HOURS_RE, ""), F.regexp_extract(s, _HOURS_RE, 1),
                           F.lpad(F.regexp_extract(s, _HOURS_RE, 2), 2, "0"), F.lit(":00"))).otherwise(s)
    return (F.when(~s.rlike(_PLAIN_RE) & s.rlike(_ZONED_RE), full.try_cast("timestamp"))
             .otherwise(F.to_utc_timestamp(s.try_cast("timestamp_ntz").cast("timestamp"), zone)))


def valid_at(start, end, t) -> Column:
    """start <= t AND (end IS NULL OR end >= t); a null start is never valid."""
    s, e, ts = col_(start), col_(end), col_(t)
    return F.coalesce((s <= ts) & (e.isNull() | (e >= ts)), F.lit(False))
