"""Incoming-folder stream: each micro-batch of newly delivered report files
runs the daily steps (ingest, then the incremental models).

The stream only tracks which files are new (its content column is never read);
a batch's files then go through the batch reader, so their own headers decide
and unreadable files are named.  ``trigger(availableNow=True)`` processes
everything delivered so far and stops, so a scheduler can start it like a batch
job; with a processing-time trigger it runs continuously.  The stream's
checkpoint records which files each epoch read, and ``ingest`` skips files
already in the processed-files ledger, so a re-run epoch after a failure
appends nothing twice.  Zones and archive are folders of the epoch's run.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillstack.plans import flows as P
from tillstack.sources.reports import file_key
from tillstack.sources.seeds import Vocabulary

#: Most files in one epoch; their names pass through the driver.
EPOCH_FILES = 10_000


def stream_incoming(spark: SparkSession, paths: P.Paths, checkpoint: str,
                    vocab: Vocabulary | None = None, now_utc: _dt.datetime | None = None,
                    enforce: bool = True, available_now: bool = True, epoch_files: int = EPOCH_FILES) -> StreamingQuery:
    """Start the stream over ``paths.incoming`` (CSV with a header)."""
    arrivals = (spark.readStream.format("binaryFile")
                .schema("path string, modificationTime timestamp_ltz, length long, content binary").option("recursiveFileLookup", "true")
                .option("maxFilesPerTrigger", epoch_files).load(paths.incoming).select("path"))

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        files = sorted(file_key(r.path) for r in batch.collect())  # at most EPOCH_FILES names
        if files:
            run = P.new_run(f"epoch-{epoch_id}")
            P.ingest(batch.sparkSession, paths, files, run, vocab, now_utc, enforce)
            P.build_models(batch.sparkSession, paths, vocab, enforce, run)

    writer = arrivals.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
