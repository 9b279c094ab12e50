"""Audit events and run records as data (K8, K9, O1, O3).

An audit event is a row (timestamp, application, event, details, level)
rendered as one JSON line with sorted keys; details are a struct built from
aggregates, so a run's events are produced by Spark, not by driver loops.
"""
from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def audit_event(details: DataFrame, event: str, application: str, run_ts: str,
                level: str = "INFO") -> DataFrame:
    """``details`` is a one-row frame whose columns become the details object
    (keys sorted). Returns one row: json."""
    cols = sorted(details.columns)
    payload = F.struct(F.lit(application).alias("application"),
                       F.struct(*[F.col(c) for c in cols]).alias("details"),
                       F.lit(event).alias("event"),
                       F.lit(level).alias("level"),
                       F.lit(run_ts).alias("timestamp"))
    return details.select(F.lit(event).alias("event"), F.to_json(payload).alias("json"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def append_json(events: DataFrame, path: str) -> None:
    """Append JSON lines to the audit log directory."""
    events.select("json").write.mode("append").text(path)


def run_record(spark: SparkSession, run_name: str, params: Mapping[str, object],
               metrics: Mapping[str, float]) -> DataFrame:
    """K9: one row of a runs table (run_name, params map, metrics map)."""
    return spark.createDataFrame(
        [(run_name, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})],
        "run_name string, params map<string,string>, metrics map<string,double>")


def append_run(record: DataFrame, path: str) -> None:
    """Add a run record to the runs table at ``path``."""
    record.write.mode("append").parquet(path)


def observed(df: DataFrame, name: str, *exprs: Column) -> tuple[DataFrame, Observation]:
    """O1: attach named metrics (rows processed, failures...) collected when
    the frame's action runs, without another pass over the data."""
    obs = Observation(name)
    return df.observe(obs, *exprs), obs
