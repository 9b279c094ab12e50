"""Time-series points from rows.

Each row becomes a point: measurement, tags (non-null tag columns as text),
fields (every other non-null, non-NaN column; booleans and numbers keep their
type, anything else becomes text) and the time. A NULL time fails the job.
The points are kept as data (maps and line-protocol text written by a file
sink); sending them to a database is not part of this library.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import epoch_us

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _escape_key(c: Column) -> Column:
    return F.regexp_replace(c, r"([ ,=])", r"\\$1")


def _field_text(name: str, dtype: T.DataType) -> Column:
    """Line-protocol rendering of one field value (NULL when skipped)."""
    c = F.col(name)
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNotNull(), F.when(c, F.lit("true")).otherwise(F.lit("false")))
    if isinstance(dtype, _INTEGRAL):
        return F.when(c.isNotNull(), F.concat(c.cast("string"), F.lit("i")))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(c.isNotNull() & ~F.isnan(c), c.cast("string"))
    if isinstance(dtype, T.DecimalType):
        return F.when(c.isNotNull(), c.cast("string"))
    s = c.cast("string")
    return F.when(c.isNotNull(), F.concat(F.lit('"'), F.regexp_replace(s, r'(["\\])', r"\\$1"), F.lit('"')))


def to_points(df: DataFrame, measurement: str, timestamp_column: str,
              tag_columns: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Columns: ``keep``..., measurement, tags map<string,string>, fields
    map<string,string> (values as line-protocol literals), time_ns, line."""
    if timestamp_column not in df.columns:
        raise KeyError(f"a point without {timestamp_column!r}")
    tags = [t for t in tag_columns if t in df.columns]
    fields = [(f.name, f.dataType) for f in df.schema.fields
              if f.name not in tags and f.name != timestamp_column]
    ts = F.col(timestamp_column)
    time_ns = F.when(ts.isNull(), F.raise_error(F.lit(f"a point without {timestamp_column!r}"))) \
               .otherwise(epoch_us(ts) * 1000)
    tag_entries = F.array(*[F.struct(F.lit(t).alias("key"), F.col(t).cast("string").alias("value")) for t in tags]) \
        if tags else F.array().cast("array<struct<key:string,value:string>>")
    field_entries = F.array(*[F.struct(F.lit(n).alias("key"), _field_text(n, d).alias("value")) for n, d in fields]) \
        if fields else F.array().cast("array<struct<key:string,value:string>>")
    tag_map = F.map_filter(F.map_from_entries(tag_entries), lambda k, v: v.isNotNull())
    field_map = F.map_filter(F.map_from_entries(field_entries), lambda k, v: v.isNotNull())
    out = df.select(*keep, F.lit(measurement).alias("measurement"), tag_map.alias("tags"),
                    field_map.alias("fields"), time_ns.alias("time_ns"))
    tag_txt = F.array_join(F.transform(F.array_sort(F.map_entries("tags")),
                                       lambda e: F.concat(_escape_key(e["key"]), F.lit("="),
                                                          _escape_key(e["value"]))), ",")
    field_txt = F.array_join(F.transform(F.map_entries("fields"),
                                         lambda e: F.concat(_escape_key(e["key"]), F.lit("="), e["value"])), ",")
    head = F.when(F.size("tags") > 0, F.concat(F.lit(measurement), F.lit(","), tag_txt)).otherwise(F.lit(measurement))
    line = F.concat_ws(" ", head, field_txt, F.col("time_ns").cast("string"))
    return out.withColumn("line", F.when(F.size("fields") > 0, line))


def write_lines(points: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """Line-protocol text sink; ``maxRecordsPerFile`` bounds each file like the
    reference's fixed-size batches (S4)."""
    w = points.where(F.col("line").isNotNull()).select("line").write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.text(path)
