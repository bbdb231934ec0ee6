"""The ordered symbol list: the position is stored with each symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_symbols(symbols: DataFrame, path: str) -> None:
    """Replace the list (id, sector, pos)."""
    symbols.select("id", "sector", F.col("pos").cast("int")).write.mode("overwrite").parquet(path)


def load_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(id, sector, pos) as stored."""
    return spark.read.parquet(path).select("id", "sector", "pos")
