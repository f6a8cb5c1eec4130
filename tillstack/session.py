"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on: ANSI casts (garbage timestamps fail like
# the warehouse), naive timestamps, dynamic partition overwrite for day
# re-runs, and AQE for coalescing, skew splits and runtime broadcast.
PIPELINE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the JVM never compiles a method of more byte code than this; the parse is one, and
    # is compiled when its expressions come as methods of their own
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # smaller tables and zones than by the default codec
    "spark.sql.parquet.compression.codec": "zstd",
    # a clustered zone (``sinks.write_clustered``) is read as it was written, a task a bucket
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE coalesce/split partitions inside persisted plans too (the
    # parsed lines are persisted), instead of running them at the static
    # shuffle-partition count
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the pipeline needs to a live session."""
    for k, v in PIPELINE_CONF.items():
        spark.conf.set(k, v)
    # day folders are listed by a job: some tasks a core, not one for each folder
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillstack") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TILLSTACK_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in PIPELINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    in local mode, where one machine sees it all, is a folder made when neither
    is set; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tillstack-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/tillstack/{label}-{uuid.uuid4().hex[:12]}"
