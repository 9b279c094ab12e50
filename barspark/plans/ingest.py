"""Ingest job (G1, O1-O3): landing CSV files -> clean, typed, zstd Parquet.

Any number of files at once, judged one by one:

  S9 hash and header of every file -> J7 skip hashes in the ledger, keep one path per
  hash -> C2 header gate per file -> S1 scan as text -> P3 exchange time to UTC, typed
  columns -> C2 value gate per file -> W10 keep-last dedupe -> W1 gaps, A6 MAD split per
  file -> K1 clean zstd Parquet, K2 quarantine (one partition per source hash each) -> K3
  ledger commit -> K8 audit events and O2 alerts per file.

The ledger's commit is the one point at which a file counts as ingested. Data and quarantine
are written before it, into partitions that a rerun overwrites: a run that fails anywhere
leaves nothing twice after its rerun, and ``ledger.published`` reads recorded files only.

A file that fails a gate fails alone: the others are written and recorded, then the job
raises (unless told not to). The per-file tables (``planned``, ``outcomes``) are
ordinary tables joined by path; the driver only sees the run's totals.
"""
from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import local_to_utc
from ..operators import quality as dq
from ..operators.schema import contract
from ..session import Scratch
from ..sinks import audit as au
from ..sinks import ledger as lg
from ..sinks.files import write_parquet_zstd, write_quarantine
from ..sources.io import landing_files

SRC = "_source_file"
POS = "_row_pos"
TIMES = "_n"                 # rows collapsed into this one
BAD = "_bad"                 # columns whose text did not convert


@dataclass
class IngestConfig:
    source: str | list[str]
    destination: str
    run_id: str
    timestamp_column: str = "timestamp"
    local_zone: str = "Asia/Kolkata"
    zstd_level: int = 3
    dataset: str = "market_data"
    expected_frequency: str = "1m"
    duplicate_keys: tuple[str, ...] = ("timestamp", "symbol")
    outlier_columns: tuple[str, ...] = ("close",)
    mad_threshold: float = 3.5
    gap_alert_threshold: int = 0
    duplicate_alert_threshold: int = 0
    outlier_alert_threshold: int = 0
    ledger_path: str | None = None
    quarantine_path: str | None = None
    audit_path: str | None = None
    runs_path: str | None = None     # K9/O1: one row of metrics per run, failed ones too
    application: str = "barspark.ingest"
    raise_on_rejected: bool = True


@dataclass
class IngestReport:
    files: int = 0                 # new files that passed
    skipped: int = 0               # already in the ledger
    repeated: int = 0              # same content as another file of the batch
    rejected: int = 0              # failed a gate
    rows_in: int = 0
    rows_out: int = 0
    quarantined: int = 0
    gaps: int = 0
    duplicates_collapsed: int = 0
    rows_written: int = 0          # counted by the clean write itself
    duration_s: float = 0.0
    timings: dict[str, float] = field(default_factory=dict)   # O1: seconds per step


class RejectedFiles(ValueError):
    """Some files failed a gate; the audit log says which and why."""


# --------------------------------------------------------------------------
# The transformation, on any frame of text rows with SRC (and POS)
# --------------------------------------------------------------------------
def typed_rows(text: DataFrame, cfg: IngestConfig) -> DataFrame:
    """The contract's columns from text columns of the same names, unconvertible text as
    NULL and named in ``_bad``; other columns are carried along."""
    schema = contract(cfg.dataset)
    if cfg.timestamp_column not in text.columns:
        raise KeyError(f"no column {cfg.timestamp_column!r} to read the time from")

    def typed(f: T.StructField) -> Column:
        if f.name == cfg.timestamp_column:
            return local_to_utc(f.name, text.schema[f.name].dataType, cfg.local_zone)
        return F.col(f.name).try_cast(f.dataType)

    # converted in one step and judged in the next, so each text is converted once
    converted = {f.name: f"_typed_{f.name}" for f in schema.fields}
    both = text.select("*", *[typed(f).alias(converted[f.name]) for f in schema.fields])
    bad = F.filter(F.array(*[F.when(F.col(c).isNotNull() & F.col(t).isNull(), F.lit(c)) for c, t in converted.items()]),
                   lambda c: c.isNotNull())
    rest = [c for c in text.columns if c not in schema.names]
    return both.select(*[F.col(t).alias(c) for c, t in converted.items()], bad.alias(BAD), *rest)


def value_gate(typed: DataFrame, cfg: IngestConfig) -> DataFrame:
    """One row per file: rows, bad_columns (text that does not convert), null_columns (NULLs
    where the contract has none). One aggregate for all files."""
    schema = contract(cfg.dataset)
    strict = [f.name for f in schema.fields if not f.nullable]
    named = lambda flags: F.array_sort(F.filter(F.array(*flags), lambda c: c.isNotNull()))
    return typed.groupBy(SRC).agg(
        F.count(F.lit(1)).alias("rows"),
        named([F.when(F.count_if(F.array_contains(BAD, f.name)) > 0, F.lit(f.name)) for f in schema.fields]).alias("bad_columns"),
        named([F.when(F.count_if(F.col(c).isNull()) > 0, F.lit(c)) for c in strict]).alias("null_columns"))


def passed(gate: DataFrame) -> DataFrame:
    return gate.filter((F.size("bad_columns") == 0) & (F.size("null_columns") == 0))


def keep_last(typed: DataFrame, cfg: IngestConfig) -> DataFrame:
    """W10 per file: the last row of each key in file order, and how many it stands for.
    Partial aggregates: a hot key is combined before the shuffle."""
    keys = [*cfg.duplicate_keys, SRC]
    # keys are equal in a group: they order nothing, and the row is shuffled without them
    order = [c for c in (cfg.timestamp_column, POS) if c in typed.columns and c not in keys] or [cfg.timestamp_column]
    cols = [c for c in typed.columns if c not in (BAD, POS)]
    row = F.struct(*[c for c in cols if c not in keys])
    return (typed.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_r"), F.count(F.lit(1)).alias(TIMES))
                 .select(*keys, "_r.*", TIMES).select(*cols, TIMES))


def outcomes(gate: DataFrame, deduped: DataFrame, scored: DataFrame, cfg: IngestConfig) -> DataFrame:
    """One row per file: status, rows, duplicates_collapsed (rows of repeated keys),
    duplicates_removed, gaps, outliers, rows_clean, and what a rejected file failed on."""
    dup = deduped.groupBy(SRC).agg(F.sum(F.when(F.col(TIMES) > 1, F.col(TIMES)).otherwise(0)).alias("duplicates_collapsed"),
                                   F.sum(F.col(TIMES) - 1).alias("duplicates_removed"))
    gaps = (dq.detect_time_gaps(deduped, cfg.timestamp_column, cfg.expected_frequency, partition_by=[SRC])
            .groupBy(SRC).agg(F.count(F.lit(1)).alias("gaps")))
    split = scored.groupBy(SRC).agg(F.count_if("is_outlier").alias("outliers"), F.count_if(~F.col("is_outlier")).alias("rows_clean"))
    counts = ["duplicates_collapsed", "duplicates_removed", "gaps", "outliers", "rows_clean"]
    ok = (F.size("bad_columns") == 0) & (F.size("null_columns") == 0)
    return (gate.join(dup, SRC, "left").join(gaps, SRC, "left").join(split, SRC, "left")
            .select(SRC, F.when(ok, "passed").otherwise("rejected").alias("status"), "rows", "bad_columns", "null_columns",
                    *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts]))


def assess(text: DataFrame, cfg: IngestConfig, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(deduplicated rows of the files that pass, with ``is_outlier``; outcomes per file)."""
    typed = scratch.save(typed_rows(text, cfg), "typed")
    gate = scratch.save(value_gate(typed, cfg), "gate")
    deduped = scratch.save(keep_last(typed.join(passed(gate).select(SRC), SRC, "left_semi"), cfg), "deduped")
    scratch.drop("typed")
    scored = dq.mad_outliers(deduped, list(cfg.outlier_columns), cfg.mad_threshold, (SRC,)).scored
    return scored, scratch.save(outcomes(gate, deduped, scored, cfg), "outcomes")


def alerts(result: DataFrame, cfg: IngestConfig) -> DataFrame:
    """O2: one row per file and check whose count exceeds its threshold."""
    checks = [("time_gaps_detected", "gaps", cfg.gap_alert_threshold),
              ("duplicates_collapsed", "duplicates_collapsed", cfg.duplicate_alert_threshold),
              ("mad_outliers_quarantined", "outliers", cfg.outlier_alert_threshold)]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(c).alias("count"),
                                        F.lit(limit).cast("long").alias("threshold")) for name, c, limit in checks]))
    return result.select(SRC, each.alias("a")).select(SRC, "a.*").filter("count > threshold")


# --------------------------------------------------------------------------
# The job
# --------------------------------------------------------------------------
def plan_files(files: DataFrame, ledger: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Each file's plan: ``skipped`` (hash in the ledger), ``repeated`` (another path of the
    batch has the same content), ``rejected`` (its header breaks the contract) or
    ``new``, with its column names in file order."""
    names = F.transform(F.split("header", ","), lambda c: F.trim(F.regexp_replace(c, '^\\s*"|"\\s*$|\\r', "")))
    want = F.array(*[F.lit(c) for c in contract(cfg.dataset).names])
    first = files.groupBy("source_hash").agg(F.min("path").alias("first_path"))
    seen = lg.current(ledger).select("source_hash", F.lit(True).alias("seen"))
    bad = F.concat(F.array_except(want, "columns"), F.array_except("columns", want))
    return (files.withColumn("columns", names).join(first, "source_hash").join(seen, "source_hash", "left")
            .withColumn("plan", F.when(F.col("seen"), "skipped").when(F.col("path") != F.col("first_path"), "repeated")
                        .when((F.size(bad) > 0) | (F.size("columns") != F.size(want)), "rejected").otherwise("new"))
            .select(F.col("path").alias(SRC), "length", "source_hash", "columns", "plan", bad.alias("header_issues")))


def text_rows(spark: SparkSession, cfg: IngestConfig, planned: DataFrame) -> DataFrame:
    """Rows of the new files as text under the contract's names: read by position, then
    named by each file's own header, so files may order their columns differently."""
    names = contract(cfg.dataset).names
    by_place = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(names))])
    raw = (spark.read.option("header", "true").option("enforceSchema", "true").schema(by_place)
           .csv(cfg.source if isinstance(cfg.source, list) else [cfg.source])
           .withColumn(SRC, F.col("_metadata.file_path"))
           .withColumn(POS, F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())))
    values = F.array(*[F.col(f.name) for f in by_place.fields])
    own = planned.filter("plan = 'new'").select(SRC, "source_hash", "columns")
    return raw.join(own, SRC).select(
        *[F.element_at(values, F.array_position("columns", F.lit(n)).cast("int")).alias(n) for n in names],
        "source_hash", SRC, POS)


def ingest(spark: SparkSession, cfg: IngestConfig) -> IngestReport:
    began = last = time.time()
    rep = IngestReport()
    run_ts = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    scratch = Scratch(spark, f"ingest-{cfg.run_id}")

    def mark(step: str) -> None:
        nonlocal last
        rep.timings[step], last = round(time.time() - last, 3), time.time()

    def event(details: DataFrame | dict, name: str, level: str = "INFO") -> None:
        """Append one audit line per row of ``details`` (or one for a dict)."""
        if cfg.audit_path:
            if isinstance(details, dict):
                details = spark.createDataFrame([tuple(details.values())], list(details))
            au.append_json(au.audit_event(details, name, cfg.application, run_ts, level), cfg.audit_path)

    def record(failures: int) -> None:
        """The run's metrics as a row of the runs table; ``last_success`` is the second of a good end."""
        if cfg.runs_path:
            counts = {k: v for k, v in rep.__dict__.items() if k != "timings"}
            steps = {f"seconds_{k}": v for k, v in rep.timings.items()}
            ended = {} if failures else {"last_success": time.time()}
            au.append_run(au.run_record(spark, cfg.run_id, {"source": cfg.source, "destination": cfg.destination},
                                        {**counts, **steps, "failures": failures, **ended}), cfg.runs_path)

    event({"source": str(cfg.source), "destination": cfg.destination, "run_id": cfg.run_id}, "ingestion_started")
    try:
        rejected = _run(spark, cfg, rep, scratch, event, mark)
    except Exception as exc:
        rep.duration_s = time.time() - began
        record(1)
        event({"source": str(cfg.source), "destination": cfg.destination, "error": f"{type(exc).__name__}: {str(exc)[:500]}"},
              "ingestion_failed", "ERROR")
        raise
    finally:
        scratch.drop()
    rep.duration_s = time.time() - began
    event({"row_count": rep.rows_out, "files": rep.files, "rejected": rep.rejected,
           "duration_seconds": round(rep.duration_s, 3)}, "ingestion_completed")
    record(0)
    if rejected and cfg.raise_on_rejected:
        raise RejectedFiles(f"{rep.rejected} file(s) rejected, {rep.files} ingested; see the audit log of run {cfg.run_id}")
    return rep


def _run(spark, cfg: IngestConfig, rep: IngestReport, scratch: Scratch, event, mark) -> bool:
    ledger = lg.read(spark, cfg.ledger_path)
    files = scratch.save(landing_files(spark, cfg.source), "files")
    planned = scratch.save(plan_files(files, ledger, cfg), "planned")
    plans = {r["plan"]: r["n"] for r in planned.groupBy("plan").agg(F.count(F.lit(1)).alias("n")).collect()}
    rep.skipped, rep.repeated, rep.rejected = (plans.get(k, 0) for k in ("skipped", "repeated", "rejected"))
    mark("hash_and_plan")
    for plan, name, level in (("skipped", "ingestion_skipped_duplicate", "WARNING"),
                              ("repeated", "ingestion_skipped_same_content", "WARNING"),
                              ("rejected", "schema_validation_failed", "ERROR")):
        if plans.get(plan):
            event(planned.filter(F.col("plan") == plan).select(F.col(SRC).alias("source"), "source_hash", "header_issues"),
                  name, level)
    if not plans.get("new"):
        return rep.rejected > 0

    scored, result = assess(text_rows(spark, cfg, planned), cfg, scratch)
    mark("scan_gate_dedupe_outliers")
    names = contract(cfg.dataset).names
    # every write replaces its file's partition; the ledger's commit comes last and publishes them
    clean, seen = au.observed(scored.filter(~F.col("is_outlier")).select(*names, "source_hash"), f"clean-{uuid.uuid4().hex}",
                              F.count(F.lit(1)).alias("rows"))
    write_parquet_zstd(clean, cfg.destination, cfg.zstd_level,
                       mode="overwrite", partition_by=("source_hash",), options={"partitionOverwriteMode": "dynamic"})
    rep.rows_written = seen.get["rows"]
    mark("clean_write")
    if cfg.quarantine_path:
        write_quarantine(scored.filter("is_outlier").drop(TIMES), cfg.quarantine_path, cfg.run_id, level=cfg.zstd_level)
        mark("quarantine")
    if cfg.ledger_path:
        now = F.current_timestamp().cast("timestamp_ntz")
        place = F.concat(F.lit(cfg.destination.rstrip("/") + "/source_hash="), "source_hash")
        runs = (result.filter("status = 'passed'").join(planned.select(SRC, "source_hash"), SRC)
                .select(F.col(SRC).alias("source_path"), place.alias("destination_path"), "source_hash",
                        F.col("rows_clean").alias("row_count"), F.lit("completed").alias("status"),
                        now.alias("created_at"), now.alias("completed_at")))
        lg.append(scratch.save(runs, "runs"), cfg.ledger_path)
        event(result.filter("status = 'passed'").select(F.col(SRC).alias("source"), F.col("rows_clean").alias("row_count")),
              "ingestion_metadata_recorded")
        mark("ledger")

    ok = F.col("status") == "passed"
    total = result.agg(F.count_if(ok).alias("files"), F.count_if(~ok).alias("rejected"), F.sum("rows").alias("rows_in"),
                       F.sum("rows_clean").alias("rows_out"), F.sum("outliers").alias("quarantined"), F.sum("gaps").alias("gaps"),
                       F.sum("duplicates_collapsed").alias("duplicates_collapsed")).first()
    for k, v in total.asDict().items():
        setattr(rep, k, getattr(rep, k) + int(v or 0))
    per_file = [("gaps", "time_gaps_detected"), ("duplicates_collapsed", "duplicates_collapsed"), ("outliers", "mad_outliers_persisted")]
    for count, name in per_file:
        if total["quarantined" if count == "outliers" else count]:
            event(result.filter(F.col(count) > 0).select(F.col(SRC).alias("source"), F.col(count).alias("count")), name)
    if total["rejected"]:
        event(result.filter(~ok).select(F.col(SRC).alias("source"), "bad_columns", "null_columns"), "schema_validation_failed", "ERROR")
    event(alerts(result, cfg).withColumnRenamed(SRC, "source"), "data_quality_alert", "ERROR")
    mark("audit")
    return rep.rejected > 0
