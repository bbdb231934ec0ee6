"""Catalog tables: create-or-append, scan-if-exists, stable dedupe with
partition replacement, and the merge of keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def append_or_create(df: DataFrame, name: str, partition_col: str = "localDate") -> str:
    """Append when the table exists, else create it partitioned by date.
    Returns 'append' or 'create'."""
    spark = df.sparkSession
    if table_exists(spark, name):
        cols = spark.table(name).columns
        df.select(*cols).write.insertInto(name)
        return "append"
    df.write.format("parquet").partitionBy(partition_col).saveAsTable(name)
    return "create"


def scan_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if table_exists(spark, name) else None


def stable_dedupe(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with a deterministic winner (the smallest full row).
    A grouped aggregate with partial merging: a key duplicated a great many
    times is reduced per task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_v"))
    return best.select(*keys, "_v.*").select(*df.columns)


def dedupe_table(spark: SparkSession, name: str, keys: list[str],
                 partition_col: str = "localDate") -> None:
    """Deduplicate a partitioned table in place. Only partitions that hold a
    repeated key are rewritten: their result is staged (a reliable checkpoint, since
    overwriting the table being read loses data) and replaces them."""
    table = spark.table(name)
    twice = (table.groupBy(*dict.fromkeys([partition_col, *keys])).count()
             .filter("count > 1").select(partition_col).distinct())
    staged = cut_lineage(stable_dedupe(table.join(twice, partition_col, "left_semi"), keys))
    (staged.select(*spark.table(name).columns).write
        .option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True))


def keyed_upsert(current: DataFrame, updates: DataFrame, key: str,
                 overwrite: bool = True) -> DataFrame:
    """Insert-or-update per attribute, as a DataFrame merge.

    ``overwrite=True`` replaces the given attributes; ``False`` keeps values
    that already exist (if-not-exists). Attributes absent from ``updates``
    stay untouched. Adds ``action`` = 'insert' | 'update' | 'keep'."""
    attrs = [c for c in current.columns if c != key]
    new_attrs = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_n_{c}") for c in new_attrs],
                       F.lit(True).alias("_has_new"))
    c = current.select(key, *attrs, F.lit(True).alias("_has_old"))
    j = c.join(u, key, "full_outer")
    out = []
    for a in sorted(set(attrs) | set(new_attrs), key=lambda x: (x not in attrs, attrs.index(x) if x in attrs else 0)):
        old = F.col(a) if a in attrs else F.lit(None)
        if a in new_attrs:
            new = F.col(f"_n_{a}")
            out.append((F.coalesce(new, old) if overwrite else F.coalesce(old, new)).alias(a))
        else:
            out.append(old.alias(a))
    action = (F.when(F.col("_has_old").isNull(), "insert")
               .when(F.col("_has_new").isNull(), "keep").otherwise("update"))
    return j.select(key, *out, action.alias("action"))

