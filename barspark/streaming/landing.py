"""The ingest job run by Structured Streaming over a landing directory.

The stream notices which files have landed (its checkpoint keeps the list of those seen);
every micro-batch runs the batch job (``plans.ingest.ingest``) on its own files only, with
its gates, ledger, quarantine and audit. The ledger knows contents by hash, so a retried
batch, a restart or a file landed under another name ingests nothing twice.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..plans.ingest import IngestConfig, ingest
from ..session import ensure_checkpoint_dir

#: Files of a micro-batch: their paths are what the driver holds.
MAX_FILES = 10_000


def start_ingest_stream(spark: SparkSession, landing_dir: str, cfg: IngestConfig,
                        checkpoint_location: str | None = None, available_now: bool = True, max_files: int = MAX_FILES):
    """Start the stream; returns the StreamingQuery. ``cfg`` needs a ledger path; its source is
    replaced by each batch's files (at most ``max_files``)."""
    if not cfg.ledger_path:
        raise ValueError("a streaming ingest needs ledger_path: the ledger makes its batches repeatable")
    place = checkpoint_location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{cfg.run_id}"
    landed = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("maxFilesPerTrigger", max_files).load(landing_dir).select("path"))

    def batch(df: DataFrame, batch_id: int) -> None:
        files = [re.sub(r"([\\*?{}\[\]])", r"\\\1", r["path"]) for r in df.collect()]     # as names, not patterns
        if files:
            ingest(df.sparkSession, IngestConfig(**{**cfg.__dict__, "source": files, "run_id": f"{cfg.run_id}-{batch_id}"}))

    writer = landed.writeStream.foreachBatch(batch).option("checkpointLocation", place)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
