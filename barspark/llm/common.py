"""Helpers shared by the operators: tables, scratch tables, batch mapping."""
from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from barspark.session import Scratch  # noqa: F401  (the operators take it from here)


#: Bounds of an Arrow batch between the JVM and a task's Python worker: texts pass in both
#: directions, so a worker holds a few batches at a time.
BATCH_ROWS, BATCH_BYTES = 2000, "8m"


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application, as a Python file of the job, and
    bound the session's Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if not getattr(context, "_barspark_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="barspark-ship-"), "barspark.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(target)
        context._barspark_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | ST.StructType) -> DataFrame:
    """``fn`` on every Arrow batch of ``df``. The batches are bounded in rows and bytes by
    Spark's Arrow settings; the map keeps nothing between them."""
    ship(df.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
    return df.mapInArrow(run, schema)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads; other columns, whatever their names, stay out."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def columns(df: DataFrame, names: list[str] | None = None) -> list[F.Column]:
    """Columns by name, whatever characters the names hold."""
    return [F.col(f"`{c}`") for c in (df.columns if names is None else names)]


def row_of(df: DataFrame, names: list[str]) -> F.Column:
    """The named columns as one struct ``row``: they pass through a batch function as they
    are, and their names cannot clash with those it adds."""
    return F.struct(*columns(df, names)).alias("row")


def row_schema(df: DataFrame, names: list[str], added: str) -> ST.StructType:
    """Schema of ``row`` and the added columns (a DDL string)."""
    row = ST.StructType([ST.StructField(c, df.schema[c].dataType, True) for c in names])
    return ST.StructType([ST.StructField("row", row, True), *ST.StructType.fromDDL(added).fields])


def text_of(batch: pa.RecordBatch, text_col: str = "text") -> pa.Array:
    """The texts of a batch of ``row`` structs: a field of the struct, or the column beside it."""
    return batch.column(1) if batch.num_columns > 1 else pc.struct_field(batch.column(0), text_col)
