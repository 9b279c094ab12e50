"""Ingestion-run ledger kept as a table.

The ledger only ever grows: a run appends its rows as one numbered commit file, and
``current`` reads the state as the latest run per source hash, so a failed write loses
nothing and no path is overwritten. ``upsert`` gives the same merge for ledgers kept as
one table.

A commit is written to a staging folder and then given the next number by one
create-if-absent: of two runs that read the same last number, one fails, reads the
ledger again and numbers its rows after the other's. Ids are therefore distinct whoever
writes at the same time. (The file system must refuse to rename onto an existing file, as
HDFS and local disks do; object stores need a committer that does.)
"""
from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sequence as sq
from ..session import materialize

LEDGER_COLUMNS = ["id", "source_path", "destination_path", "source_hash", "row_count", "status",
                  "created_at", "completed_at"]
LEDGER_SCHEMA = ("id long, source_path string, destination_path string, source_hash string, row_count long, "
                 "status string, created_at timestamp_ntz, completed_at timestamp_ntz")
FIRST, LAST = ["id", "source_path", "created_at"], ["destination_path", "row_count", "status", "completed_at"]


def read(spark: SparkSession, path: str | None) -> DataFrame:
    """All run rows. Only a path that does not exist is an empty ledger; any other failure to
    read (a damaged file, no permission) is raised, now or by the job that reads it."""
    if path:
        try:
            return spark.read.schema(LEDGER_SCHEMA).parquet(path).select(*LEDGER_COLUMNS)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], LEDGER_SCHEMA)


def current(ledger: DataFrame) -> DataFrame:
    """One row per hash: identity of its first run, outcome of its latest."""
    first = F.min_by(F.struct(*FIRST), F.struct("created_at", "id"))
    last = F.max_by(F.struct(*LAST), F.struct("completed_at", "id"))
    return (ledger.groupBy("source_hash").agg(first.alias("f"), last.alias("l"))
            .select(*[F.col(f"f.{c}") if c in FIRST else F.col(f"l.{c}") if c in LAST else F.col(c) for c in LEDGER_COLUMNS]))


def new_files(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates whose ``source_hash`` is not recorded yet."""
    return candidates.join(ledger.select("source_hash"), "source_hash", "left_anti")


def already_ingested(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates whose hash is recorded (skipped as duplicates)."""
    return candidates.join(ledger.select("source_hash"), "source_hash", "left_semi")


def one_per_hash(runs: DataFrame) -> DataFrame:
    """The latest run of each hash in a batch (greatest path among equals)."""
    cols = [c for c in LEDGER_COLUMNS if c != "id"]
    order = ["completed_at", "source_path"]
    row = F.struct(*order, *(c for c in cols if c not in (*order, "source_hash")))     # each value once: the row is shuffled
    return runs.groupBy("source_hash").agg(F.max(row).alias("r")).select("source_hash", "r.*").select(*cols)


def numbered(runs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ids after the ledger's greatest, in (completed_at, source_hash) order, by the
    skew-safe global row index."""
    max_id = ledger.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    seq = sq.index_sequence(runs, [], "completed_at", order=["source_hash"])
    return seq.frame.withColumn("id", max_id + F.col(sq.RN) + 1).select(*LEDGER_COLUMNS)


def append(runs: DataFrame, path: str, tries: int = 100) -> int:
    """Commit a batch's runs to the ledger at ``path``; returns the commit's number. ``runs`` is
    small (a row per file) and read once per try."""
    spark, base = runs.sparkSession, path.rstrip("/")
    batch = one_per_hash(runs)
    for _ in range(tries):
        names = _committed(spark, base)
        ledger = spark.read.schema(LEDGER_SCHEMA).parquet(*[f"{base}/{n}" for n in names]) if names else \
            spark.createDataFrame([], LEDGER_SCHEMA)
        number = 1 + max([int(n[7:-8]) for n in names if n.startswith("commit-")], default=0)
        stage = f"{base}/_staging-{uuid.uuid4().hex}"
        numbered(batch, ledger).coalesce(1).write.parquet(stage)
        written = _committed(spark, stage)
        done = not written or _rename_if_absent(spark, f"{stage}/{written[0]}", f"{base}/commit-{number:012d}.parquet")
        fs, place = _place(spark, stage)
        fs.delete(place, True)
        if done:
            return number
    raise RuntimeError(f"the ledger at {path} was changed by others {tries} times in a row")


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the Parquet files at ``path``; none where it does not exist."""
    fs, place = _place(spark, path)
    if not fs.exists(place):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(place) if f.isFile()]
    return sorted(n for n in names if n.endswith(".parquet") and n[0] not in "._")


def _rename_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """One atomic step: ``target`` becomes ``source``, or exists already (false)."""
    fs, place = _place(spark, target)
    if fs.getUri().getScheme() == "file":   # Hadoop's local rename looks first and moves then; a hard link is one step
        try:
            os.link(*(unquote(urlparse(p).path) for p in (source, target)))
            return True
        except FileExistsError:
            return False
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_place(spark, source)[1], place, plain)
        return True
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
            return False
        raise


def published(data: DataFrame, ledger: DataFrame, hash_col: str = "source_hash") -> DataFrame:
    """The rows of ``data`` (clean or quarantined) whose file is recorded: what a run wrote and did
    not commit is left out, until a rerun overwrites and records it."""
    return data.join(ledger.select(F.col("source_hash").alias(hash_col)).distinct(), hash_col, "left_semi")


def upsert(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """K3: insert new hashes; on an existing hash keep id, source_path and
    created_at and take destination_path, row_count, status and
    completed_at from the new run. A hash repeated in the batch counts once."""
    old = ledger.select(*[F.col(c).alias(f"o_{c}") for c in LEDGER_COLUMNS])
    new = one_per_hash(runs).select(*[F.col(c).alias(f"n_{c}") for c in LEDGER_COLUMNS if c != "id"])
    j = old.join(new, old.o_source_hash == new.n_source_hash, "full_outer")
    merged = j.select(F.col("o_id").alias("id"), *[
        F.coalesce(*([f"o_{c}", f"n_{c}"] if c in (*FIRST, "source_hash") else [f"n_{c}", f"o_{c}"])).alias(c)
        for c in LEDGER_COLUMNS if c != "id"])
    merged = materialize(merged, "merged")      # read for the known rows and, several times, to number the new ones
    fresh = numbered(merged.where(F.col("id").isNull()).drop("id"), ledger)
    return merged.where(F.col("id").isNotNull()).select(*LEDGER_COLUMNS).unionByName(fresh)
