"""Parquet sources and sinks: checked reads, partition replacement,
run-stamped appends, part unions and compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C
from tidemark.schemas import assert_schema

TARGET_FILE_BYTES = 128 * 1024 * 1024


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read the named columns in schema order and fail on a type mismatch."""
    df = spark.read.parquet(path).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    return assert_schema(df, schema, path)


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Column-projected read; Catalyst prunes the scan to these columns."""
    return spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in columns])


def _writer(df: DataFrame, level: int):
    return (df.write.option("compression", "zstd")
              .option("parquet.compression.codec.zstd.level", str(level)))


def write_partitions(df: DataFrame, path: str, schema: T.StructType | None = None,
                     partition_col: str = "localDate",
                     level: int = C.DEFAULT_COMPRESSION_LEVEL) -> None:
    """Replace exactly the date partitions present in ``df`` (dynamic
    partition overwrite); other partitions are untouched and an empty input
    replaces nothing. Schema-checked before writing."""
    if schema is not None:
        assert_schema(df, schema, path)
    # rebalance by the partition column: few files per date, while AQE still
    # splits a date that holds a large share of the rows
    out = df.hint("rebalance", partition_col)
    (_writer(out, level).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col).parquet(path))


def append_run(df: DataFrame, path: str, run_ts: str,
               level: int = C.DEFAULT_COMPRESSION_LEVEL) -> None:
    """Append one run's output under ``run=<yyyyMMdd'T'HHmmss>``; run names
    sort by recency."""
    _writer(df.withColumn("run", F.lit(run_ts)).hint("rebalance"), level).mode("append") \
        .partitionBy("run").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs under ``path`` concatenated, with ``_part`` (run name) and
    ``_row`` ((file, row index) order inside the run) for keep-last dedupes."""
    df = spark.read.parquet(path)
    return (df.withColumn("_part", F.col("run"))
              .withColumn("_row", F.struct(F.col("_metadata.file_name").alias("f"),
                                           F.col("_metadata.row_index").alias("i")))
              .drop("run"))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Names of the ``column=...`` folders under ``path``, in order (file-system
    listing, not data)."""
    if not exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)
                  if s.isDirectory() and s.getPath().getName().startswith(f"{column}="))


def list_runs(spark: SparkSession, path: str) -> list[str]:
    return list_partitions(spark, path, "run")


def newest_dates(spark: SparkSession, path: str, count: int, until) -> list[str]:
    """The ``count`` newest date partitions at or before ``until`` (ISO dates)."""
    days = [n.partition("=")[2] for n in list_partitions(spark, path, "localDate")]
    return [d for d in days if d <= str(until)][-count:]


def _bytes_under(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def compact_runs(spark: SparkSession, path: str, key: str, run_ts: str,
                 limit: int = C.PARTIAL_FILE_LIMIT,
                 level: int = C.CONSOLIDATED_COMPRESSION_LEVEL) -> bool:
    """When more than ``limit`` runs exist, write their keep-last union as
    one new (newest) run sized to ~128 MB files, then delete the old runs.
    Readers that dedupe keep-last see the same rows throughout, because the
    compacted run is the newest."""
    from tidemark.operators.dataset import dedupe_keep_last
    runs = list_runs(spark, path)
    if len(runs) <= limit:
        return False
    files = max(1, -(-_bytes_under(spark, path) // TARGET_FILE_BYTES))
    merged = dedupe_keep_last(read_runs(spark, path), key)
    # in order of the key, so that files keep narrow key ranges for pruning
    out = merged.repartitionByRange(files, key).sortWithinPartitions(key)
    _writer(out.withColumn("run", F.lit(run_ts)), level).mode("append") \
        .partitionBy("run").parquet(path)
    for r in runs:
        _delete(spark, f"{path.rstrip('/')}/{r}")
    return True


def path_value(pattern_key: str, path_col: F.Column, cast: str) -> F.Column:
    """Value of ``key=...`` in a file path, cast with ``try_cast`` (an
    unparsable value becomes NULL)."""
    raw = F.regexp_extract(path_col, rf"{pattern_key}=([^/]+)/", 1)
    return F.when(raw == "", F.lit(None)).otherwise(raw).try_cast(cast)
