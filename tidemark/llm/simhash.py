"""SimHash near-duplicates by a range join over per-segment bit counts.

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words, XXH64 with seed 42; a bit is 1 when it is set in over half
of the shingles' hashes.

Candidates: a 64-bit fingerprint is mapped to 32 counts, one for each segment
of 2 bits. Two fingerprints that differ in d bits differ by at most d in these
counts under the Manhattan distance, which is therefore a lower bound. The
grid: the 32 coordinates are cut into ``bits + 3`` blocks; a Manhattan distance
of at most ``bits`` leaves at least 3 blocks unchanged, so linked fingerprints
share a grid cell in one of the choices of 3 blocks. Within a cell a sorted
range join on the sum of the other counts, the full Manhattan distance and
at last the exact bit distance decide. Nothing is capped: a cell above
``BLOCK`` members is dealt out as pairs of chunks to many tasks. A task holds
two chunks and returns a spanning forest of the links it found, never all
pairs. Equal fingerprints meet once, through an aggregate.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; null ids take no part in ``component_id`` (null if a component
has no other); repeated rows each get a row; an empty table gives an empty
result; texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from tidemark.llm.common import materialise, pieces, utf8
from tidemark.llm.components import connected

SEED = 42
ODD = 0x5555555555555555     # the low bit of each segment
BLOCK = 2048                 # members of a cell that one task compares at once


def simhash(data: bytes, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    words = data.lower().split()     # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    text = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = (size + 1).cumsum() - 1
    starts, n = (ends - size).tolist(), max(1, len(words) - shingle + 1)
    ends = ends[shingle - 1:].tolist() or [len(text)]
    digests = b"".join([xxh64_digest(text[a:b], SEED) for a, b in zip(starts, ends)])
    bits = np.frombuffer(digests, np.uint8).reshape(n, 8)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        votes += np.unpackbits(bits[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by ``fp`` (signed 64-bit)."""
    kept = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                fps = [simhash(t, shingle) for t in utf8(part.column(len(names)))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(names))] + [pa.array(fps, pa.int64())],
                    [*names, "fp"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "fp long"
    return docs.select(*names, text).mapInArrow(run, schema)


def segment_counts(fp: Column) -> Column:
    """32 bit counts of 2 bits each, in the places of their segments."""
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(ODD)
    low = fp.bitwiseAND(ODD)
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseXOR(low))


def grid_masks(bits: int) -> list[int]:
    """One mask for each choice of 3 of the ``bits + 3`` blocks of segments."""
    cut = np.array_split(np.arange(32), bits + 3)
    block = [sum(3 << (2 * int(s)) for s in c) for c in cut]
    masks = [sum(block[i] for i in pick) for pick in combinations(range(len(cut)), 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _counts(fp: np.ndarray) -> np.ndarray:
    high, low = (fp >> np.uint64(1)) & np.uint64(ODD), fp & np.uint64(ODD)
    return ((high & low) << np.uint64(1)) | (high ^ low)


def near_links(left: np.ndarray, right: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two sets of fingerprints (within
    one set when ``left is right``), as index pairs into their union."""
    own = left is right
    fps = left if own else np.concatenate([left, right])
    counts = _counts(fps)
    total = np.bitwise_count(counts & np.uint64(ODD)).astype(np.int16)
    total += 2 * np.bitwise_count(counts & ~np.uint64(ODD)).astype(np.int16)
    base = 0 if own else len(left)
    order = base + np.argsort(total[base:], kind="stable")
    keys = total[order]
    walk = np.argsort(total[:len(left)], kind="stable")
    label = np.arange(len(fps))
    out = []
    for at in range(0, len(walk), 256):
        rows = walk[at:at + 256]
        lo = np.searchsorted(keys, total[rows[0]] - bits, side="left")
        hi = np.searchsorted(keys, total[rows[-1]] + bits, side="right")
        cols = order[lo:hi]
        differ = counts[rows][:, None] ^ counts[cols][None, :]
        one = differ & np.uint64(ODD)
        two = (differ >> np.uint64(1)) & np.uint64(ODD) & ~one
        bound = np.bitwise_count(one) + 2 * np.bitwise_count(two)
        r, c = np.nonzero(bound <= bits)
        c = cols[c]
        exact = (np.bitwise_count(fps[rows[r]] ^ fps[c]) <= bits) & (rows[r] != c)
        r, c = r[exact], c[exact]
        for k in np.unique(r):
            i, near = rows[k], c[np.searchsorted(r, k):np.searchsorted(r, k, side="right")]
            found, first = np.unique(label[near], return_index=True)
            new = found != label[i]
            if new.any():   # one link to each part of the forest that it joins
                out += [(int(i), int(near[f])) for f in first[new]]
                parts = np.append(found, label[i])
                label[np.isin(label, parts)] = parts.min()
    return out


def _cells(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links of each cell; its rows come together, the sides one after another.

    Only the rows of the cell that is being read are held."""
    keys, rest = ("combo", "cell", "low", "high"), None
    for batch in (*batches, None):
        if batch is not None:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            rest = cols if rest is None else [np.concatenate(x) for x in zip(rest, cols)]
        if rest is None or not len(rest[0]):
            continue
        change = np.zeros(len(rest[0]), bool)
        for k in range(len(keys)):
            change[1:] |= rest[k][1:] != rest[k][:-1]
        starts = np.r_[0, np.flatnonzero(change)]
        ends = np.r_[starts[1:], len(rest[0])]
        done = len(starts) - (batch is not None)
        fps, side = rest[5].view(np.uint64), rest[4]
        a, b = [], []
        for s, e in zip(starts[:done], ends[:done]):
            if e - s < 2:
                continue
            members, cut = fps[s:e], int(np.searchsorted(side[s:e], 1))
            left = members[:cut]
            right = left if rest[2][s] == rest[3][s] else members[cut:]
            for i, j in near_links(left, right, bits):
                a.append(members[i])
                b.append(members[j])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])
        rest = [x[starts[done]:] for x in rest] if batch is not None else None


def links(distinct: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints ``fp`` as all pairs at
    most ``bits`` apart would."""
    grid = F.array(*[F.struct(F.lit(k).alias("combo"), F.lit(m).alias("mask"))
                     for k, m in enumerate(grid_masks(bits))])
    cells = (distinct.select("fp", segment_counts(F.col("fp")).alias("counts"),
                             F.explode(grid).alias("g"))
             .select("fp", F.col("g.combo").alias("combo"),
                     F.col("counts").bitwiseAND(F.col("g.mask")).alias("cell")))
    large = (cells.groupBy("combo", "cell").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > BLOCK)
             .withColumn("chunks", F.ceil(F.col("n") / (BLOCK // 2)).cast("int")).drop("n"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    units = (cells.join(large, ["combo", "cell"], "left")
             .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("combo", "cell", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"),
                     F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "fp"))
    key = ["combo", "cell", "low", "high"]
    return (units.repartition(*key).sortWithinPartitions(*key, "side", "fp")
            .mapInArrow(lambda batches: _cells(batches, bits), "a long, b long"))


def components(docs: DataFrame, shingle: int = 3, bits: int = 3,
               keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, fp, root (a fingerprint), component_id and the columns ``keep``."""
    keep = keep or {}
    named = docs.select(F.col("doc_id"), *[c.alias(n) for n, c in keep.items()],
                        F.col("text").alias("_text"))
    marked = materialise(fingerprints(named, shingle, "_text"), "simhash")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected(links(distinct.select("fp"), bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "root", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", *keep, "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    return components(docs, shingle, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row of each component stays: that of its smallest doc_id."""
    mark = {"_hash": F.xxhash64("text")}
    found = components(docs, shingle, bits, mark)
    best = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min(F.struct("doc_id", "_hash")).alias("best"))
            .select(F.col("best.doc_id").alias("_id"), F.col("best._hash").alias("_best")))
    marked = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_key"),
                         *[c.alias(n) for n, c in mark.items()])
    kept = marked.join(best, marked["_key"].eqNullSafe(best["_id"])
                       & (marked["_hash"] == best["_best"]), "left_semi")
    # rows that repeat one id and text are one row of their component
    return kept.dropDuplicates(["_key", "_hash"]).select("_row.*")
