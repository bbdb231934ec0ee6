"""High-water marks in a control table ``(pipeline, key, value DATE)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


MARK = "localDate"


def write_marks(marks: DataFrame, path: str) -> None:
    """Replace the marks of the (pipeline, key) pairs present in ``marks`` (one partition
    each, dynamic overwrite), after the outputs they describe landed. Other keys of
    a pipeline stay."""
    (marks.select("pipeline", "key", F.col("value").cast("date")).write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy("pipeline", "key").parquet(path))


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], column: str = MARK) -> dict:
    """Run ``write`` on ``df``; ``newest`` (greatest ``column``) and ``rows`` of what went
    through it, measured by the write itself: nothing is read again.

    ``newest`` is right whatever is repeated; tasks of a stage that runs again may count
    ``rows`` twice."""
    seen = Observation()
    write(df.observe(seen, F.max(column).alias("newest"), F.count(F.lit(1)).alias("rows")))
    return seen.get


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    schema = "pipeline string, key string, value date"
    return spark.read.schema(schema).parquet(path).select("pipeline", "key", "value")


def read_mark(spark: SparkSession, path: str, pipeline: str, key: str, default=None) -> DataFrame:
    """One row: the stored date, or ``default`` when the mark or the whole table
    is absent."""
    from tidemark.sources.parquet import exists
    marks = (read_marks(spark, path) if exists(spark, path) else
             spark.createDataFrame([], "pipeline string, key string, value date"))
    stored = marks.filter((F.col("pipeline") == pipeline) & (F.col("key") == key))
    v = stored.select(F.max("value")).scalar()
    d = F.lit(default).cast("date") if default is not None else F.lit(None).cast("date")
    return spark.range(1).select(F.lit(pipeline).alias("pipeline"), F.lit(key).alias("key"),
                                 F.coalesce(v, d).alias("value"))


def joint_watermark(marks: DataFrame, key: str = "lastProcessed", pipelines=None) -> DataFrame:
    """Min over pipelines of the given mark; fails (at run time) when one is
    missing."""
    m = marks.filter(F.col("key") == key)
    if pipelines:
        m = m.filter(F.col("pipeline").isin(*pipelines))
        n = len(pipelines)
        return m.agg(F.when(F.count_distinct("pipeline") == n, F.min("value"))
                      .otherwise(F.raise_error(F.lit("missing high-water mark")))
                      .alias("watermark"))
    return m.agg(F.min("value").alias("watermark"))
