"""Token ids as Parquet: list columns that can be read in part.

Layout of a token table (a folder):

* ``tokens/`` one row per document in ascending ``doc_id``: ``doc_id``, ``shard``
  (the task that wrote it), ``at`` (ids before it in its shard), ``n_tokens`` (with the end id)
  and ``ids`` as a list of 32-bit integers. The list's values are dictionary encoded (a
  vocabulary's ids fit one dictionary page, so a value takes as many bits as the
  ids in use need); ``at`` grows along the file, so it and ``n_tokens`` are left to the
  version-2 writer's delta encoding. Row groups and pages have fixed sizes, and each page's
  least and greatest value go to the file's page index.
* ``shards/`` one row per shard: its rows, its ids and the ids of all shards before it.

So a document's place in the whole sequence is ``start`` of its shard plus ``at``, found
without its ids; a read of some documents, or of a window of the sequence, touches the
row groups and pages that hold them.

Rows are dealt by ranges of (doc_id, hash of the text, row), so that an id that many
rows share spans tasks; texts are shuffled, not ids, because they are smaller, and each task
encodes what it writes. Spark commits the files, so a lost executor repeats its tasks.

Defined results: null text is empty and has the one end id; texts are encoded whole;
null ids come first; rows that repeat an id are ordered by the hash of their text, and
equal rows are all kept; an empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, pieces
from tidemark.llm.encoders import byte_encoder
from tidemark.session import scratch_path

END = 0
GROUP_BYTES = 32 << 20      # of a row group, as held by its writer
PAGE_BYTES = 128 << 10      # of a page: the least that a selective read touches
READ_ROWS = 128             # documents that a reading task decodes at once
#: Options of Spark's Parquet writer. Page indexes are part of every file it writes.
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}


def encode_rows(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id, shard, at, n_tokens, ids of sorted (doc_id, text) rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, total = byte_encoder(path, False), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in pieces(batch, "text", 256):
                ids = []
                for text in part.column(1).to_pylist():
                    ids += [own.encode(text or ""), np.array([end], np.uint32)]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)).reshape(-1, 2).sum(1)
                ends = sizes.cumsum()
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(len(sizes), shard, np.int32)),
                     pa.array(total + ends - sizes), pa.array(sizes), lists],
                    ["doc_id", "shard", "at", "n_tokens", "ids"])
                total += int(sizes.sum())

    return docs.mapInArrow(run, f"doc_id {kind}, shard int, at long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, out: str, end: int = END) -> None:
    """Write the token table of ``docs`` (doc_id, text) into the folder ``out``;
    ``path`` is the vocabulary file."""
    spark = docs.sparkSession
    key = ["doc_id", "_hash", "_row"]
    rows = (docs.select("doc_id", "text").withColumn("_hash", F.xxhash64("text"))
            .withColumn("_row", F.monotonically_increasing_id())
            .repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text"))
    encode_rows(rows, path, end).write.options(**FORMAT).parquet(f"{out}/tokens")
    per = (spark.read.parquet(f"{out}/tokens").groupBy("shard")
           .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")))
    # one row for each task that wrote: a running sum in one task
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (per.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
     .coalesce(1).write.parquet(f"{out}/shards"))


def read_places(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, shard, start, n_tokens of every document; the ids are not read."""
    rows = spark.read.parquet(f"{out}/tokens").select("doc_id", "shard", "at", "n_tokens")
    shards = spark.read.parquet(f"{out}/shards").select("shard", F.col("start").alias("_start"))
    return rows.join(shards, "shard").select(
        "doc_id", "shard", (F.col("_start") + F.col("at")).alias("start"), "n_tokens")


def read_documents(spark: SparkSession, out: str, first=None, last=None) -> DataFrame:
    """doc_id, start, n_tokens, ids of the documents from id ``first`` to ``last``
    (both included, null: no bound): the bounds prune row groups and pages."""
    rows = spark.read.parquet(f"{out}/tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    shards = spark.read.parquet(f"{out}/shards").select("shard", F.col("start").alias("_start"))
    return rows.join(shards, "shard").select(
        "doc_id", (F.col("_start") + F.col("at")).alias("start"), "n_tokens", "ids")


def read_window(spark: SparkSession, out: str, start: int, length: int) -> DataFrame:
    """doc_id, start, ids of the parts of documents that lie in the ids
    [start, start + length) of the whole sequence.

    The shards that the window meets are looked up first (one row a task); of
    their rows those that end past its begin and begin before its end."""
    stop = start + length
    met = spark.read.parquet(f"{out}/shards").where(
        (F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    rows = spark.read.parquet(f"{out}/tokens")
    found = []
    for s in met.orderBy("shard").collect():        # shards that the window spans
        at, size = F.col("at"), F.col("n_tokens")
        lo, hi = start - s["start"], stop - s["start"]
        a, b = F.greatest(F.lit(lo) - at, F.lit(0)), F.least(F.lit(hi) - at, size)
        found.append(rows.where((F.col("shard") == s["shard"]) & (at < hi) & (at + size > lo))
                     .select("doc_id", (F.lit(s["start"]) + at + a).alias("start"),
                             F.slice("ids", (a + 1).cast("int"), (b - a).cast("int")).alias("ids")))
    if not found:
        return rows.select("doc_id", F.lit(0).cast("long").alias("start"), "ids").limit(0)
    while len(found) > 1:
        found = [x.unionByName(y) if y is not None else x
                 for x, y in zip(found[::2], [*found[1::2], None])]
    return found[0]


@contextmanager
def reader_rows(spark: SparkSession, rows: int = READ_ROWS) -> Iterator[None]:
    """Within it, Parquet is decoded in batches of so many rows: Spark's default of
    4,096 long lists at once does not fit a small executor."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checksums(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ids_crc32`` (unsigned crc32 of the ids as little-endian 32-bit
    integers) in place of ``ids``."""
    kept = [c for c in rows.columns if c != "ids"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            ends = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(sums, pa.int64())],
                [*kept, "ids_crc32"])

    return rows.select(*kept, "ids").mapInArrow(run, schema + ", ids_crc32 long")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    spark = docs.sparkSession
    out = scratch_path(spark, "tokens")
    write_tokens(docs, path, out)
    with reader_rows(spark):
        return materialise(checksums(read_documents(spark, out)), "token-sums")
