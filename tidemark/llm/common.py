"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: The white space that separates words in the contracts: x20 and x09 to x0D.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A given table, narrowed to ``columns`` at the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the cluster's shared folder and read it back.

    The table replaces the lineage: a lost executor re-reads finished files
    instead of running Python again, and every later pass sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def split_words(c: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order."""
    flat = F.translate(c, SPACES, " " * len(SPACES))
    return F.filter(F.split(flat, " "), lambda w: w != "")


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes per row; null is empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, column: str, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of a batch, so Python objects exist for few rows only."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
