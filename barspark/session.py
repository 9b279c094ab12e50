"""Spark session defaults shared by the library, the tests and the benchmark."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Conservative defaults: UTC session clock, ANSI arithmetic, AQE with skew-join
# splitting. Cluster deployments override partitions and memory through their
# own spark-defaults; we only fill in what is unset.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "barspark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in conf.items():
        if not key.startswith("spark.ui") and not key.startswith("spark.driver"):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf on an existing session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names. Only a local master may go
    without the setting (tests): on a cluster, each machine would write to its own disk."""
    context = spark.sparkContext
    if context.getConf().contains("spark.checkpoint.dir"):
        if not context.getCheckpointDir():
            context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir"))
        return context.getCheckpointDir()
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    if not getattr(context, "_barspark_scratch", None):
        context._barspark_scratch = os.environ.get("BARSPARK_SCRATCH") or tempfile.mkdtemp(prefix="barspark-ckpt-")
        context.setCheckpointDir(context._barspark_scratch)
    return context.getCheckpointDir()


class Scratch:
    """Tables written once to the shared checkpoint folder and read again: the lineage ends
    there. ``drop`` removes named tables, or all; those behind a returned frame stay."""

    def __init__(self, spark: SparkSession, owner: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{owner}-{uuid.uuid4().hex}"

    def save(self, df, name: str):
        df.write.mode("overwrite").parquet(f"{self.base}/{name}")
        return self.spark.read.parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for place in [f"{self.base}/{n}" for n in names] or [self.base]:
            path = jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(conf).delete(path, True)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL defaults to a session created elsewhere (the driver's)."""
    for key, value in DEFAULTS.items():
        if key.startswith("spark.ui"):
            continue
        try:
            spark.conf.set(key, value)
        except Exception:
            pass
    ensure_checkpoint_dir(spark)
    return spark


def materialize(df, name: str = "table"):
    """Cut lineage by writing ``df`` once as Parquet under the shared checkpoint
    directory and reading it back (one job; an eager ``Dataset.checkpoint``
    would compute an unpersisted input twice)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/barspark-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def checkpoint_keep_partitioning(df):
    """Reliable checkpoint that keeps the output partitioning: persisted
    first so the checkpoint write does not recompute the input."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = p.checkpoint(eager=True)
    p.unpersist()
    return out
