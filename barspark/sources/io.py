"""Readers: CSV/Parquet scans, file hashes, reference tables."""
from __future__ import annotations

import os
from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.schema import Issue, compare


def csv_scan(spark: SparkSession, paths, schema: T.StructType | None = None,
             text_columns: tuple[str, ...] = (), with_source: bool = True,
             options: Mapping[str, object] | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass). Columns in
    ``text_columns`` are read as strings (e.g. local timestamps parsed later).
    ``_source_file`` records the file of each row (from ``_metadata``)."""
    opts = {"header": "true", "mode": "PERMISSIVE"}
    opts.update({k: str(v) for k, v in (options or {}).items()})
    r = spark.read.options(**opts)
    if schema is not None:
        fields = [T.StructField(f.name, T.StringType() if f.name in text_columns else f.dataType, True)
                  for f in schema.fields]
        r = r.schema(T.StructType(fields))
    df = r.csv(paths if isinstance(paths, (list, tuple)) else [paths])
    if with_source:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    """S3: a missing dataset raises FileNotFoundError before any job runs, on every file system."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"nothing to read at {path}") from exc


def file_issues(spark: SparkSession, path: str, schema: T.StructType,
                read_csv_options: Mapping[str, object] | None = None) -> list[Issue]:
    """What a CSV (read with the caller's options) or Parquet file has against a contract."""
    kind = os.path.splitext(path)[1].lower().lstrip(".")
    if kind not in ("csv", "parquet"):
        raise ValueError(f"cannot compare a .{kind} file: csv or parquet expected ({path})")
    options = {"header": "true", "inferSchema": "true", **{k: str(v) for k, v in (read_csv_options or {}).items()}}
    reader = spark.read.options(**options) if kind == "csv" else spark.read
    return compare(reader.format(kind).load(path), schema)


# Suffixes that Spark's text reader would decompress, and the byte order mark it drops.
CODED = r"\.(gz|bz2|deflate|snappy|lz4|zst|zstd)$"
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


def landing_files(spark: SparkSession, paths) -> DataFrame:
    """Path, length, source_hash (SHA-256 of the bytes) and header (first line) per file.

    A file of any size, on any path Spark reads, goes the same way: its lines (cut at line feeds only)
    are read as splits, shuffled once by path, sorted by their place, and hashed batch by
    batch by one task, as the hash is sequential; no cell holds more than a line. The bytes
    hashed are checked against the file's length. Compressed files, whose bytes the
    text reader doesn't give, are hashed as cells of the binary-file source (below 2 GiB).
    Files without a byte are not listed by Spark's file sources and give no row."""
    load = list(dict.fromkeys(paths)) if isinstance(paths, (list, tuple)) else [paths]
    # named like the rows that readers take from a file (its path column does not encode blanks and brackets)
    place = F.col("_metadata.file_path")
    every = spark.read.format("binaryFile").load(load)
    coded = (every.filter(place.rlike(CODED))
             .select(place.alias("path"), "length", F.sha2("content", 256).alias("source_hash"),
                     F.substring_index(F.col("content").cast("string"), "\n", 1).alias("header")))
    lines = (spark.read.option("lineSep", "\n").text(load).filter(~place.rlike(CODED))
             .select(place.alias("path"), F.col("_metadata.file_size").alias("length"),
                     F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"),
                     F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("content"))
             .repartition("path").sortWithinPartitions("path", "split", "line"))
    mark = BYTE_ORDER_MARK

    def digests(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        names = ["path", "length", "source_hash", "header"]

        def finished(path, length, plain, marked, read, header):
            # read counts a line feed after every line; the last may lack it, and the mark is not among the lines
            had_mark, last = {0: (False, b"\n"), -1: (False, b""), 3: (True, b"\n"), 2: (True, b"")}.get(length - read, (None, None))
            if had_mark is None:
                raise ValueError(f"{path}: {read} bytes in lines, {length} in the listing; it changed or a line is too long")
            digest = marked if had_mark else plain
            digest.update(last)
            text = (mark * had_mark + header).decode("utf-8", "replace")
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([length], pa.int64()),
                                               pa.array([digest.hexdigest()]), pa.array([text])], names=names)

        path = None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column("path").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            content = batch.column("content").cast(pa.large_binary())
            offsets = np.frombuffer(content.buffers()[1], np.int64)[content.offset:]
            data = memoryview(content.buffers()[2])
            for a, b in zip(starts[:-1], starts[1:]):
                own = data[offsets[a]:offsets[b]]
                if path != batch.column("path")[a].as_py():
                    if path is not None:
                        yield finished(path, length, plain, marked, read, header)
                    path, length = batch.column("path")[a].as_py(), batch.column("length")[a].as_py()
                    header = bytes(data[offsets[a]:offsets[a + 1] - 1])
                    plain, marked, read = hashlib.sha256(), hashlib.sha256(mark), 0
                elif read:
                    plain.update(b"\n")
                    marked.update(b"\n")
                plain.update(own[:-1])          # the last line feed waits until more follows
                marked.update(own[:-1])
                read += len(own)
        if path is not None:
            yield finished(path, length, plain, marked, read, header)

    hashed = lines.mapInArrow(digests, "path string, length long, source_hash string, header string")
    without = F.lit(mark)       # a file that has no line
    rest = (every.filter(~place.rlike(CODED)).select(place.alias("path"), "length")
             .join(hashed.drop("length"), "path", "left")
             .select("path", "length", F.coalesce("source_hash", F.sha2(without, 256)).alias("source_hash"),
                     F.coalesce("header", without.cast("string")).alias("header")))
    return rest.unionByName(coded)


def source_hashes(spark: SparkSession, paths) -> DataFrame:
    """Path, length and source_hash per file."""
    return landing_files(spark, paths).select("path", "length", "source_hash")


# ---- reference data (S5-S7) -------------------------------------------------
# The reference's built-in symbol master and index constituents.
SYMBOL_MASTER_ROWS = [
    ("NSE:INFY", "INE009A01021", "NSE", "Infosys Limited", "Information Technology", "1993-06-14", None),
    ("NSE:TCS", "INE467B01029", "NSE", "Tata Consultancy Services Limited", "Information Technology",
     "2004-08-25", None),
    ("NSE:HDFCBANK", "INE040A01034", "NSE", "HDFC Bank Limited", "Financials", "1995-01-23", None),
]
INDEX_CONSTITUENT_ROWS = [
    ("NIFTY50", "NSE:INFY", 0.085, "2009-01-01", None),
    ("NIFTY50", "NSE:TCS", 0.053, "2009-01-01", None),
    ("NIFTY50", "NSE:HDFCBANK", 0.112, "2009-01-01", None),
    ("NIFTYBANK", "NSE:HDFCBANK", 0.265, "2013-06-01", None),
]


def _dates(df: DataFrame) -> DataFrame:
    for c in ("start_date", "end_date"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("string").try_cast("timestamp_ntz"))
    return df


def load_symbol_master(spark: SparkSession) -> DataFrame:
    """S6."""
    df = spark.createDataFrame(SYMBOL_MASTER_ROWS, "symbol string, isin string, exchange string, name string, "
                                                   "sector string, start_date string, end_date string")
    return _dates(df)


def load_index_constituents(spark: SparkSession) -> DataFrame:
    """Sorted by (index, symbol, start_date)."""
    df = spark.createDataFrame(INDEX_CONSTITUENT_ROWS, "index string, symbol string, weight double, "
                                                       "start_date string, end_date string")
    return _dates(df).orderBy("index", "symbol", "start_date")


def load_reference(spark: SparkSession, path: str | None, fallback) -> DataFrame:
    """Parquet when the path exists, else the built-in table; date columns
    coerced (unparseable -> NULL)."""
    if path and ("://" in path or os.path.exists(path)):
        return _dates(spark.read.parquet(path))
    return _dates(fallback(spark))
