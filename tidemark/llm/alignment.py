"""Alignment of two tokenizers over a corpus, each distinct text once.

1. Rows are grouped by their full text, so every distinct text is tokenised and
   aligned once however many documents hold it; ``copies`` counts them. From
   here on a text goes by its SHA-256.
2. A task takes the texts in blocks of ``BLOCK_BYTES``. Both tokenisations cover
   the same bytes (those of a space and the text); the byte offsets where a token ends on both
   sides cut them into groups, found for the whole block by one intersection of
   the two sorted lists of ends. Every pair of tokens of a group is a link. A block keeps its
   distinct id pairs once, each with the number of documents that hold it, and
   for each text the places of its pairs in that list and their links.
3. A pair's count is the sum of the blocks' numbers; an A id's highest count is an
   aggregate with one row per id of the vocabulary. A hot pair is one row a block.
4. Counts go back to the blocks (a join on the pair, then a cogroup by block: a
   block is bounded by construction) and become per-text sums, which join the documents on
   the digest.

A text of more links than ``BLOCK_LINKS`` (long stretches without a common end) is
cut by ranges of A ids into parts that are blocks of their own: pairs of different parts
differ, so counts and sums add up, and memory stays bounded.

Defined results: null and empty texts, and texts of which a tokenisation does not
give back the bytes of space + text, have no tokens: zeros and an empty
``groups_sha256``; strings of special tokens are plain text; texts are aligned whole; each row of
``docs`` gives one row, null and repeated ids included; an id pair held by n equal
documents counts n; ties for the highest count are all best; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, pieces
from tidemark.llm.encoders import ByteEncoder, byte_encoder

BLOCK_BYTES = 2 << 20       # text of a block, one text at least
BLOCK_LINKS = 1 << 21       # distinct (group, A id, B id) of a block, one A id at least
IDS = 1 << 21               # ids of either vocabulary are smaller
SEPARATORS = (",", "|", ";", "")


class Pieces:
    """A sentencepiece model: ids and the bytes of each id."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode())
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def piece_model(path: str) -> Pieces:
    """One model for each Python worker."""
    return Pieces(path)


@lru_cache(maxsize=1)
def decimals(size: int) -> list[str]:
    """By separator and id: the id in decimal, then the separator."""
    return [f"{i}{s}" for s in SEPARATORS for i in range(size)]


def covers(ids: list[int], table: list[bytes], data: bytes) -> bool:
    return b"".join(map(table.__getitem__, ids)) == data


def run_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])


def distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id), sorted, and how often each is there."""
    key = np.sort(group * IDS + ids)
    at = run_starts(key) if len(key) else np.zeros(0, np.int64)
    return key[at] // IDS, key[at] % IDS, np.diff(np.r_[at, len(key)])


class Aligned:
    """The texts of a block, tokenised and cut into groups.

    Tokens of all texts follow each other; group numbers run through the block."""

    def __init__(self, texts: list[str], byte: ByteEncoder, piece: Pieces) -> None:
        a_ids, b_ids, self.valid = [], [], []
        for text, b in zip(texts, piece.encode(texts)):
            data = b" " + text.encode()
            a = byte.encode(" " + text)
            good = (text != "" and covers(b, piece.bytes, data)
                    and int(byte.lengths[a].sum()) == len(data))
            self.valid.append(good)
            a_ids.append(a if good else a[:0])
            b_ids.append(b if good else [])
        self.n_a = np.array([len(x) for x in a_ids], np.int64)
        self.n_b = np.array([len(x) for x in b_ids], np.int64)
        self.a = np.concatenate(a_ids).astype(np.int64)
        self.b = np.concatenate([np.array(x, np.int64) for x in b_ids])
        a_end, b_end = byte.lengths[self.a].cumsum(), piece.lengths[self.b].cumsum()
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        self.in_a = np.bincount(self.a_group, minlength=len(common))
        self.in_b = np.bincount(self.b_group, minlength=len(common))
        # a text's last tokens end together, so no group spans two texts
        last = self.n_a.cumsum() - 1
        self.n_groups = np.zeros(len(texts), np.int64)
        filled = self.n_a > 0
        ends = self.a_group[last[filled]] + 1
        self.n_groups[filled] = np.diff(np.r_[0, ends])
        self.text_of_group = np.repeat(np.arange(len(texts)), self.n_groups)
        self.n_links = np.bincount(self.text_of_group, self.in_a * self.in_b,
                                   len(texts)).astype(np.int64)

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        before_a, before_b = self.in_a.cumsum() - self.in_a, self.in_b.cumsum() - self.in_b
        size = shown_ids(self.a, self.b)
        shown = np.empty(len(self.a) + len(self.b), np.int64)
        place = np.arange(len(self.a))
        ends = place + 1 == (before_a + self.in_a)[self.a_group]
        shown[place + before_b[self.a_group]] = self.a + size * ends
        place = np.arange(len(self.b))
        ends = place + 1 == (before_b + self.in_b)[self.b_group]
        at = place + (before_a + self.in_a)[self.b_group]
        shown[at] = self.b + 2 * size * ends
        stops = (self.n_a + self.n_b).cumsum()
        shown[stops[self.n_a > 0] - 1] += size       # nothing follows a text's last id
        name, out, start = decimals(size).__getitem__, [], 0
        for stop, good in zip(stops.tolist(), self.valid):
            if not good:
                out.append("")
                continue
            sha = hashlib.sha256()
            for k in range(start, stop, 1 << 18):
                sha.update("".join(map(name, shown[k:min(stop, k + (1 << 18))].tolist())).encode())
            out.append(sha.hexdigest())
            start = stop
        return out

    def parts(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, pair, links) of distinct (text, id pair), sorted, in parts of about
        ``limit`` expanded rows; a pair of a text is in one part only."""
        ga, a, na = distinct(self.a_group, self.a)
        gb, b, nb = distinct(self.b_group, self.b)
        ub = np.bincount(gb, minlength=len(self.in_a))
        first_b = ub.cumsum() - ub
        # by text, then A id: a cut between two A ids of a text parts no pair of it
        order = np.lexsort((a, self.text_of_group[ga]))
        ga, a, na = ga[order], a[order], na[order]
        rows = ub[ga]
        total = rows.cumsum()
        owner = self.text_of_group[ga] * IDS + a
        starts = run_starts(owner) if len(owner) else np.zeros(0, np.int64)
        # fill parts with whole (text, A id) runs
        bounds, used = [0], 0
        for s, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(owner)]):
            if total[stop - 1] - used > limit and s > bounds[-1]:
                bounds.append(s)
                used = total[s - 1]
        for lo, hi in zip(bounds, [*bounds[1:], len(owner)]):
            if lo == hi:
                continue
            r = rows[lo:hi]
            at = np.repeat(np.arange(lo, hi), r)
            inner = np.arange(len(at)) - np.repeat(r.cumsum() - r, r)
            other = first_b[ga[at]] + inner
            # a block has fewer texts than a vocabulary may have ids
            key = (self.text_of_group[ga[at]] * IDS + a[at]) * IDS + b[other]
            links = na[at] * nb[other]
            order = np.argsort(key)
            key, links = key[order], links[order]
            at = run_starts(key)
            yield key[at] // (IDS * IDS), key[at] % (IDS * IDS), np.add.reduceat(links, at)


def shown_ids(a: np.ndarray, b: np.ndarray) -> int:
    """A power of two above every id, so that few tables of decimals are made."""
    top = max(int(a.max(initial=0)), int(b.max(initial=0)))
    return 1 << max(16, top.bit_length())


def blocks(texts: DataFrame, byte_path: str, piece_path: str, block_bytes: int = BLOCK_BYTES,
           block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row for each text (digest, n_a, n_b, n_groups, n_links, groups_sha256) with the
    text's pairs in its block (steps, links), or for a block its pairs (pairs, held).

    ``steps`` are the distances between the places of a text's pairs in its block's
    list. A text cut into parts has its measures in the first one; ``pairs`` is null in
    text rows."""
    schema = ("block string, digest string, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, steps array<int>, links array<int>, "
              "pairs array<long>, held array<long>")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32()),
             pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def rows(texts: list[str], digests: list[str], copies: np.ndarray) -> Iterator[pa.RecordBatch]:
        done = Aligned(texts, byte_encoder(byte_path, True), piece_model(piece_path))
        measures = [done.n_a, done.n_b, done.n_groups, done.n_links]
        shas, told = done.digests(), np.zeros(len(texts), bool)
        for number, (text, pair, links) in enumerate(done.parts(block_links)):
            pairs, place = np.unique(pair, return_inverse=True)
            held = np.bincount(place, copies[text]).astype(np.int64)
            at = run_starts(text)
            steps = np.diff(place, prepend=0).astype(np.int32)
            steps[at] = place[at]
            mine = text[at]
            tell = ~told[mine]
            told[mine] = True
            lists = pa.array(np.r_[at, len(text)].astype(np.int32))
            own = f"{digests[0]}-{number}"
            yield table([own] * len(mine), [digests[i] for i in mine.tolist()],
                        [np.where(tell, m[mine], 0) for m in measures],
                        [shas[i] if t else "" for i, t in zip(mine.tolist(), tell.tolist())],
                        pa.ListArray.from_arrays(lists, pa.array(steps)),
                        pa.ListArray.from_arrays(lists, pa.array(links.astype(np.int32))),
                        pa.nulls(len(mine), kinds[9]), pa.nulls(len(mine), kinds[10]))
            yield table([own], [None], [[0]] * 4, [""], pa.nulls(1, kinds[7]),
                        pa.nulls(1, kinds[8]), pa.array([pairs], kinds[9]),
                        pa.array([held], kinds[10]))

    def table(*columns) -> pa.RecordBatch:
        block, digest, numbers, sha, *lists = columns
        flat = [block, digest, *numbers, sha]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(flat, kinds)] + lists, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, digests, copies, size = [], [], [], 0
        for batch in batches:
            for part in pieces(batch, "text", 64):
                for text, digest, n in zip(*(c.to_pylist() for c in part.columns)):
                    if texts and size + len(text) > block_bytes:
                        yield from rows(texts, digests, np.array(copies))
                        texts, digests, copies, size = [], [], [], 0
                    texts.append(text)
                    digests.append(digest)
                    copies.append(n)
                    size += len(text)
        if texts:
            yield from rows(texts, digests, np.array(copies))

    return texts.select("text", "digest", "copies").mapInArrow(run, schema)


def text_sums(key, texts: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each text of one block."""
    place = np.argsort(counts["place"].to_numpy())
    count = counts["n"].to_numpy()[place]
    best = counts["best"].to_numpy(zero_copy_only=False)[place]
    steps = texts["steps"].combine_chunks()
    sizes = np.diff(steps.offsets.to_numpy())
    links = texts["links"].combine_chunks().values.to_numpy().astype(np.int64)
    walked = steps.values.to_numpy().astype(np.int64).cumsum()
    at = sizes.cumsum() - sizes
    first = steps.values.to_numpy()[at]
    walked -= np.repeat(walked[at] - first, sizes)
    best_links = np.add.reduceat(links * best[walked], at)
    sums = np.add.reduceat(links * count[walked], at)
    keep = ["digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    return pa.table([*(texts[c] for c in keep), pa.array(best_links.astype(np.int64)),
                     pa.array(sums.astype(np.int64))], [*keep, "n_best", "count_sum"])


def align(docs: DataFrame, byte_path: str, piece_path: str, block_bytes: int = BLOCK_BYTES,
          block_links: int = BLOCK_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of
    every row."""
    docs = docs.select("doc_id", "text")
    held = F.col("text").isNotNull() & (F.col("text") != "")
    texts = (docs.where(held).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
             .withColumn("digest", F.sha2("text", 256)))
    made = materialise(blocks(texts, byte_path, piece_path, block_bytes, block_links),
                       "alignment")

    entries = made.where(F.col("pairs").isNotNull()).select(
        "block", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "e")).select(
        "block", "place", F.col("e.pairs").alias("pair"), F.col("e.held").alias("held"))
    total = materialise(entries.groupBy("pair").agg(F.sum("held").alias("n")), "pairs")
    a_id = F.shiftright("pair", IDS.bit_length() - 1)
    highest = total.groupBy(a_id.alias("a")).agg(F.max("n").alias("top"))   # one row an A id
    judged = (total.withColumn("a", a_id).join(highest, "a")
              .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    back = entries.join(judged, "pair").select(F.col("block").alias("owner"), "place", "n", "best")
    sums = (made.where(F.col("pairs").isNull()).groupBy("block").cogroup(back.groupBy("owner"))
            .applyInArrow(text_sums, "digest string, n_a long, n_b long, n_groups long, "
                          "n_links long, groups_sha256 string, n_best long, count_sum long"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    # parts of one text add up; the first has its digest, the others an empty one
    per_text = sums.groupBy("digest").agg(*[F.sum(c).alias(c) for c in numbers],
                                          F.max("groups_sha256").alias("groups_sha256"))
    # texts without tokens have no row there
    whole = (docs.where(held).select("doc_id", F.sha2("text", 256).alias("digest"))
             .join(per_text, "digest", "left").drop("digest")
             .unionByName(docs.where(~held | F.col("text").isNull()).select("doc_id"), True))
    return whole.select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
                        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
