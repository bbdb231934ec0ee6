"""Session construction and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for the engine's plans.

    AQE re-plans joins from runtime sizes, coalesces small shuffle partitions
    and splits skewed ones; the session time zone is pinned to UTC so dates
    derived from timestamps are stable across machines.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # whole documents cross into Python for NFKC: keep Arrow batches
          # small enough that long texts cannot build gigabyte batches
          .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
          .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
          .config("spark.sql.parquet.compression.codec", "zstd")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    A local session (unit tests) that leaves it unset gets a private temporary
    folder. On a cluster no folder of the driver's machine could be read by the
    executors, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for staged outputs."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tidemark-{name}-{uuid.uuid4().hex[:12]}"


def store(df, name: str):
    """Write ``df`` once as Parquet in the shared folder and read it back: later readers
    scan the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Materialise ``df`` reliably (``checkpoint``), never ``localCheckpoint``."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
