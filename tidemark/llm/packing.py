"""Packing token pieces into sequences by minimum bin slack.

Each document is encoded and cut into full sequences and a remainder shorter
than ``size``. Only the lengths of the remainders matter for packing, so the
multiset of lengths is a histogram of at most ``size - 1`` counts whatever the
corpus holds. On it, minimum bin slack: the longest length left opens a window,
and a subset-sum over the lengths left (a bit set of reachable totals, with the
counts found by walking back) picks the multiset that comes closest to ``size``.
The pattern found is repeated while the counts last, so there are at most about
as many patterns as lengths. The driver holds the histogram and the patterns,
never a document.

Documents are matched to places by their rank among equal lengths: rows are
range-partitioned by (length, doc_id), so that a length that many rows share
spans many tasks, and per-task counts give the offsets. Sequence ids: even for
packed remainders, odd for full sequences.

Defined results: null text is empty and has the one end id; a row that repeats
another is packed as well; null ids sort first; an empty table gives an empty
result; other columns are ignored; texts are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Codec, encoded
from tidemark.llm.common import materialise

SIZE = 2048
END = np.array([1], "<u4").tobytes()


def cut(size: int = SIZE, end: bytes = END) -> Callable[[bytes, Codec], list[tuple]]:
    """Rows (start, length, ids_crc32, doc_tokens) of a document's pieces."""

    def rows(ids: bytes, _: Codec) -> list[tuple]:
        ids += end
        n = len(ids) // 4
        return [(at, min(size, n - at), zlib.crc32(ids[4 * at:4 * (at + size)]), n)
                for at in range(0, n, size)]

    return rows


def fullest(counts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The multiset (length, count) that fills ``size`` best and holds the
    longest length left.

    ``reach[k]`` has bit t set when some multiset of the first k lengths adds
    up to t; a length with c copies is added in steps of 1, 2, 4, …, rest. Long
    lengths come first, so short ones are left to close later windows."""
    lengths = np.flatnonzero(counts)[::-1].tolist()
    first, mask = lengths[0], (1 << (size + 1)) - 1
    left = {x: int(min(counts[x], size // x)) for x in lengths}
    left[first] -= 1
    reach, steps = [1 << first], []
    for x in lengths:
        copies, lump = left[x], 1
        while copies > 0 and not reach[-1] >> size & 1:
            take = min(lump, copies)
            now = reach[-1] | (reach[-1] << (take * x)) & mask
            if now != reach[-1]:
                reach.append(now)
                steps.append((x, take))
            copies, lump = copies - take, 2 * lump
    total = reach[-1].bit_length() - 1
    chosen = {first: 1}
    for k in range(len(steps) - 1, -1, -1):
        if not reach[k] >> total & 1:
            x, take = steps[k]
            chosen[x] = chosen.get(x, 0) + take
            total -= take * x
    return sorted(chosen.items(), reverse=True)


def patterns(counts: np.ndarray, size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """(repeats, pattern) until every length is placed."""
    counts = counts.astype(np.int64).copy()
    out = []
    while counts.any():
        pattern = fullest(counts, size)
        times = min(int(counts[x]) // c for x, c in pattern)
        for x, c in pattern:
            counts[x] -= times * c
        out.append((times, pattern))
    return out


@dataclass
class Places:
    """By length: from which rank on which pattern places its copies."""

    first_rank: np.ndarray   # key: length * 2**48 + rank
    copies: np.ndarray       # of the length in one sequence of the pattern
    sequence: np.ndarray     # first sequence of the pattern
    offset: np.ndarray       # of the length's first copy in a sequence

    @classmethod
    def of(cls, found: list[tuple[int, list[tuple[int, int]]]]) -> Places:
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for times, pattern in found:
            offset = 0
            for x, c in pattern:
                rows.append(((x << 48) + used.get(x, 0), c, sequence, offset))
                used[x] = used.get(x, 0) + times * c
                offset += x * c
            sequence += times
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 4).T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << 48) + rank
        at = np.searchsorted(self.first_rank, key, side="right") - 1
        past = key - self.first_rank[at]
        return (self.sequence[at] + past // self.copies[at],
                self.offset[at] + past % self.copies[at] * length)


def pack(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of
    every piece."""
    spark = docs.sparkSession
    cells = materialise(encoded(docs.select("doc_id", "text"), path,
                                "start long, length long, ids_crc32 long, doc_tokens long",
                                cut(size)), "pieces")
    whole = cells.where(F.col("length") == size).select(
        *cells.columns, (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["length", "doc_id", "doc_tokens", "ids_crc32"]
    rest = materialise(cells.where(F.col("length") < size)
                       .repartitionByRange(parts, *key).sortWithinPartitions(*key)
                       .withColumn("_part", F.spark_partition_id())
                       .withColumn("_at", F.monotonically_increasing_id()), "remainders")
    # at most one row for each length, and one more for each task
    tally = rest.groupBy("length", "_part").agg(
        F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).toPandas()
    tally = tally.sort_values(["length", "_part"])
    counts = np.zeros(size, np.int64)
    np.add.at(counts, tally["length"].to_numpy(np.int64), tally["n"].to_numpy(np.int64))
    before = tally.groupby("length")["n"].cumsum() - tally["n"]
    shift = (before - tally["first"]).to_numpy(np.int64)
    where = (tally["length"].to_numpy(np.int64) << 32) + tally["_part"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((Places.of(patterns(counts, size)), where, shift))
    names = cells.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, where, shift = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            length, part, at = (get(c).to_numpy().astype(np.int64)
                                for c in ("length", "_part", "_at"))
            rank = at + shift[np.searchsorted(where, (length << 32) + part)]
            sequence, offset = places.find(length, rank)
            yield pa.RecordBatch.from_arrays(
                [get(c) for c in names] + [pa.array(2 * sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"])

    return whole.unionByName(rest.mapInArrow(place, whole.schema))
