"""A keyed table stored in place: lookups, upserts and deletes by key.

The table is partitioned by ``part``, a hash of the key, and each partition is bucketed and sorted
by key. A change rewrites the partitions that hold one of its keys, and no others. Stored
rows meet the changes bucket by bucket: only the changes are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage
from tidemark.sources.tables import keyed_upsert

PARTS = 64


def part_of(key: str, parts: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int").alias("part")


class KeyedTable:
    """A catalog table ``name`` with one row a ``key``."""

    def __init__(self, spark: SparkSession, name: str, key: str) -> None:
        self.spark, self.name, self.key = spark, name, key
        self.parts = int(spark.sql(f"SHOW TBLPROPERTIES {name} ('parts')").first()["value"])

    @classmethod
    def create(cls, rows: DataFrame, name: str, key: str, parts: int = PARTS,
               buckets: int | None = None) -> KeyedTable:
        """Store ``rows`` (unique by ``key``) as a new table. ``buckets`` of each partition:
        the session's shuffle partitions, so that a join takes the stored layout over."""
        spark = rows.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        (rows.withColumn("part", part_of(key, parts)).repartition(n, key).write.format("parquet")
         .partitionBy("part").bucketBy(n, key).sortBy(key).saveAsTable(name))
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('parts' = '{parts}')")
        return cls(spark, name, key)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop("part")

    def touched(self, keys: DataFrame) -> list[int]:
        """The partitions that may hold one of ``keys``: ``parts`` numbers at most."""
        found = keys.select(part_of(self.key, self.parts)).distinct().collect()
        return sorted(r["part"] for r in found)

    def _stored(self, parts: list[int]) -> DataFrame:
        return self.spark.table(self.name).where(F.col("part").isin(parts)).drop("part")

    def get(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys``; other partitions are not read."""
        own = keys.select(self.key).distinct()
        return self._stored(self.touched(own)).join(own, self.key, "left_semi")

    def _replace(self, rows: DataFrame) -> None:
        """Replace the partitions that ``rows`` holds."""
        columns = self.spark.table(self.name).columns
        (rows.withColumn("part", part_of(self.key, self.parts)).select(*columns).write
         .option("partitionOverwriteMode", "dynamic").insertInto(self.name, overwrite=True))

    def upsert(self, updates: DataFrame, overwrite: bool = True) -> DataFrame:
        """Insert or update by attribute, in place; (key, action) of the given keys.

        As :func:`keyed_upsert`: with ``overwrite`` given attributes replace stored ones, without
        it stored ones stay; others are untouched."""
        parts = self.touched(updates)
        merged = cut_lineage(keyed_upsert(self._stored(parts), updates, self.key, overwrite))
        self._replace(merged.drop("action"))
        return merged.where(F.col("action") != "keep").select(self.key, "action")

    def delete(self, keys: DataFrame) -> None:
        """Remove the rows of ``keys``, in place."""
        own = keys.select(self.key).distinct()
        parts = self.touched(own)
        left = cut_lineage(self._stored(parts).join(own, self.key, "left_anti"))
        empty = set(parts) - set(self.touched(left))
        self._replace(left)
        for part in sorted(empty):            # dynamic overwrite leaves these as they are
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (part = {part})")
