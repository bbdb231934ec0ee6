"""Approximate nearest neighbours: one small-world graph for each shard.

Vectors of each length are dealt into shards of about ``SHARD_BYTES`` by a hash of id and vector,
after rows that repeat both have become one: no id, and no repeated row, fills a shard.
Each shard gets a hierarchical navigable small-world graph: a node is on layers
0..l with l drawn geometrically; a layer holds a flat array of neighbour
numbers, ``2 * LINKS`` on layer 0 and ``LINKS`` above. Layers are built from the top;
nodes go in batches, each searching the layer above for its entry and then its
own layer (a beam over all nodes of the batch at once), and its links are
chosen by the usual rule that a neighbour must be nearer to the node than to
the neighbours taken before. The largest inner product is made a distance by one
more component that brings all vectors of a shard to one norm. The graphs are
written to the shared folder; every query is sent to every shard of its length, in packed blocks
of ``QUERIES``, scored exactly in double precision, and the shards' best are merged by rank. Equal vectors of a shard are
one node with a list of ids, so a vector that many rows share neither fills the neighbour
lists nor hides the smallest ids.

Memory of a task: one shard and a block of queries.

Defined results: vectors that are null, zero, or that hold null or non-finite components take
no part, nor do null ids; a query's candidates are the vectors of its length; rows
with the query's id are its own and are left out; a query id that repeats counts
once, with its least vector; candidates that repeat a row exactly count once;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

SHARD_BYTES = 16 << 20   # of a shard's vectors in double precision
QUERIES = 2048           # queries of a packed block
LINKS = 16            # neighbours a node chooses
BUILD_BEAM = 64
SEARCH_BEAM = 320
BATCH = 256           # nodes or queries that search together
WIDTH = 4             # beam entries that are expanded at once


def beam_search(links: np.ndarray, points: np.ndarray, queries: np.ndarray,
                entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and inner products of the ``beam`` best nodes found, best first
    (-1 where fewer), from ``entries`` (queries x any) along ``links``."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n, len(points) + 1), bool)         # the last column takes the -1
    seen[:, -1] = True

    def score(ids: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.sort(ids, axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        ids[seen[who, ids]] = -1
        seen[who, ids] = True
        found = np.einsum("ad,akd->ak", queries[who[:, 0]], points[ids])
        found[ids < 0] = -np.inf
        return ids, found

    def best(ids: np.ndarray, found: np.ndarray, old: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(-found, axis=1, kind="stable")[:, :beam]
        return [np.take_along_axis(x, order, axis=1) for x in (ids, found, old)]

    ids, found = score(entries.astype(np.int64), rows)
    ids, found, old = best(ids, found, np.zeros(ids.shape, bool))
    live = np.arange(n)
    pad = beam - ids.shape[1]
    if pad > 0:
        ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
        found = np.pad(found, ((0, 0), (0, pad)), constant_values=-np.inf)
        old = np.pad(old, ((0, 0), (0, pad)))
    while len(live):
        fresh = (ids[live] >= 0) & ~old[live]
        more = fresh.any(axis=1)
        live, fresh = live[more], fresh[more]
        if not len(live):
            break
        # the list is sorted, so the first fresh entries are the best ones
        pick = np.argsort(~fresh, axis=1, kind="stable")[:, :WIDTH]
        usable = np.take_along_axis(fresh, pick, axis=1)
        node = np.where(usable, ids[live[:, None], pick], -1)
        old[live[:, None], pick] |= usable
        near = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(live), -1)
        new, value = score(near.astype(np.int64), live[:, None])
        ids[live], found[live], old[live] = best(
            np.concatenate([ids[live], new], axis=1),
            np.concatenate([found[live], value], axis=1),
            np.concatenate([old[live], np.zeros(new.shape, bool)], axis=1))
    ids[np.isneginf(found)] = -1
    return ids, found


def choose(points: np.ndarray, ids: np.ndarray, found: np.ndarray, limit: int) -> np.ndarray:
    """Of candidates sorted by nearness (-1 at the end), up to ``limit`` that are
    nearer to the node than to each other; then the nearest of the rest."""
    out = np.full((len(ids), limit), -1, np.int64)
    for at in range(0, len(ids), 512):
        cand, near = ids[at:at + 512], found[at:at + 512]
        vectors = points[cand]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        kept = np.zeros(cand.shape, bool)
        count = np.zeros(len(cand), np.int64)
        for j in range(cand.shape[1]):
            hidden = (kept & (between[:, j, :] > near[:, j, None])).any(axis=1)
            kept[:, j] = (cand[:, j] >= 0) & ~hidden & (count < limit)
            count += kept[:, j]
        rank = np.where(cand < 0, 2, np.where(kept, 0, 1))
        order = np.argsort(rank, axis=1, kind="stable")[:, :limit]
        out[at:at + 512, :order.shape[1]] = np.take_along_axis(cand, order, axis=1)
    return out


@dataclass
class Graph:
    points: np.ndarray                       # float32, all of one norm
    layers: list[np.ndarray] = field(default_factory=list)   # neighbour arrays, layer 0 first
    members: list[np.ndarray] = field(default_factory=list)  # nodes of each layer

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> Graph:
        norms = np.einsum("nd,nd->n", vectors, vectors)
        lift = np.sqrt(np.maximum(norms.max() - norms, 0))
        graph = cls(np.column_stack([vectors, lift]).astype(np.float32))
        rng = np.random.default_rng(seed)
        n = len(vectors)
        level = np.floor(-np.log(1 - rng.random(n)) / math.log(LINKS)).astype(int)
        order = rng.permutation(n)
        top = int(level.max())
        layers, members = [], []
        for k in range(top, -1, -1):
            own = order[level[order] >= k]
            above = own[level[own] > k]
            own = np.concatenate([above, own[level[own] == k]])
            layers.insert(0, graph._layer(own, 2 * LINKS if k == 0 else LINKS,
                                          layers, members))
            members.insert(0, own)
        graph.layers, graph.members = layers, members
        return graph

    def _layer(self, own: np.ndarray, width: int, above: list[np.ndarray],
               members: list[np.ndarray]) -> np.ndarray:
        links = np.full((len(self.points) + 1, width), -1, np.int32)   # last row: for -1
        at = 0
        while at < len(own):
            new = own[at:at + min(BATCH, max(16, at))]
            inside = own[:at]
            if at <= 4 * BUILD_BEAM:      # everything so far is within the beam's reach
                pool = np.concatenate([inside, new])
                found = self.points[new] @ self.points[pool].T
                found[new[:, None] == pool[None, :]] = -np.inf
                order = np.argsort(-found, axis=1, kind="stable")[:, :BUILD_BEAM]
                ids, found = pool[order], np.take_along_axis(found, order, axis=1)
                ids = np.where(np.isneginf(found), -1, ids)
            else:
                entry = (self.descend(self.points[new], above, members) if above
                         else np.repeat(inside[:1], len(new))[:, None])
                ids, found = beam_search(links, self.points, self.points[new], entry, BUILD_BEAM)
                # nodes of one batch may be near each other too
                among = self.points[new] @ self.points[new].T
                np.fill_diagonal(among, -np.inf)
                keep = np.argsort(-among, axis=1)[:, :LINKS]
                ids = np.concatenate([ids, new[keep]], axis=1)
                found = np.concatenate([found, np.take_along_axis(among, keep, axis=1)], axis=1)
                order = np.argsort(-found, axis=1, kind="stable")
                ids, found = (np.take_along_axis(x, order, axis=1) for x in (ids, found))
                ids = np.where(np.isneginf(found), -1, ids)
            picked = choose(self.points, ids, found, LINKS)
            links[new, :LINKS] = picked
            self._back(links, np.repeat(new, LINKS), picked.ravel())
            at += len(new)
        return links

    def _back(self, links: np.ndarray, source: np.ndarray, target: np.ndarray) -> None:
        """Links from ``target`` back to ``source``, with the lists kept to their width."""
        width = links.shape[1]
        real = target >= 0
        target, source = target[real], source[real]
        touched = np.unique(target)
        have = links[touched]
        t = np.concatenate([target, np.repeat(touched, width)])
        s = np.concatenate([source, have.ravel().astype(np.int64)])
        t, s = t[s >= 0], s[s >= 0]
        both = np.unique(t * len(links) + s)
        t, s = both // len(links), both % len(links)
        near = np.einsum("nd,nd->n", self.points[t], self.points[s])
        order = np.lexsort((-near, t))
        t, s, near = t[order], s[order], near[order]
        starts = np.searchsorted(t, touched)
        place = np.arange(len(t)) - np.repeat(starts, np.diff(np.r_[starts, len(t)]))
        most = 2 * width
        row = np.searchsorted(touched, t)
        inside = place < most
        ids = np.full((len(touched), most), -1, np.int64)
        found = np.full((len(touched), most), -np.inf, np.float32)
        ids[row[inside], place[inside]] = s[inside]
        found[row[inside], place[inside]] = near[inside]
        over = (ids >= 0).sum(axis=1) > width
        links[touched[~over]] = ids[~over, :width]
        if over.any():
            links[touched[over]] = choose(self.points, ids[over], found[over], width)

    def descend(self, queries: np.ndarray, layers: list[np.ndarray],
                members: list[np.ndarray]) -> np.ndarray:
        """Entries for the layer below ``layers``: the best few nodes of the lowest."""
        entry = np.repeat(members[-1][:1], len(queries))[:, None]
        for k in range(len(layers) - 1, -1, -1):
            beam = 8 if k else 16
            entry, _ = beam_search(layers[k], self.points, queries, entry, beam)
        return entry

    def search(self, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
        """Numbers of the nodes found for each query, -1 where fewer than ``beam``."""
        lifted = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32)
        above = self.layers[1:]
        entry = (self.descend(lifted, above, self.members[1:]) if above
                 else np.repeat(self.members[0][:1], len(queries))[:, None])
        return beam_search(self.layers[0], self.points, lifted, entry, beam)[0]


INDEX = ("shard int, n int, dim int, ids binary, id_ends binary, vectors binary, levels int, "
         "members binary, member_ends binary, links binary")


def distinct_vectors(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """(ids, id_ends, vectors): each different vector once, with its ids in order."""
    vectors = np.ascontiguousarray(vectors + 0.0)          # -0.0 is 0.0
    rows = vectors.view(f"V{vectors.itemsize * vectors.shape[1]}").ravel()
    _, first, node = np.unique(rows, return_index=True, return_inverse=True)
    pairs = np.unique(np.column_stack([node.ravel(), ids]), axis=0)
    return pairs[:, 1], np.bincount(pairs[:, 0]).cumsum(), vectors[first]


def pack_graph(shard: int, ids: np.ndarray, id_ends: np.ndarray, vectors: np.ndarray,
               graph: Graph) -> dict:
    """Flat arrays of one shard: layer 0 for all nodes, upper layers for members."""
    rows = [layer[m].ravel() for layer, m in zip(graph.layers, graph.members)]
    return {"shard": shard, "n": len(vectors), "dim": vectors.shape[1],
            "ids": ids.astype("<i8").tobytes(), "id_ends": id_ends.astype("<i8").tobytes(),
            "vectors": vectors.astype("<f8").tobytes(),
            "levels": len(rows),
            "members": np.concatenate(graph.members).astype("<i4").tobytes(),
            "member_ends": np.cumsum([len(m) for m in graph.members]).astype("<i4").tobytes(),
            "links": np.concatenate(rows).astype("<i4").tobytes()}


def unpack_graph(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    """(ids, id_ends, vectors, graph)"""
    n, dim = row["n"], row["dim"]
    ids, id_ends = (np.frombuffer(row[c], "<i8") for c in ("ids", "id_ends"))
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(n, dim)
    norms = np.einsum("nd,nd->n", vectors, vectors)
    lift = np.sqrt(np.maximum(norms.max() - norms, 0))
    graph = Graph(np.column_stack([vectors, lift]).astype(np.float32))
    members = np.frombuffer(row["members"], "<i4")
    ends = np.frombuffer(row["member_ends"], "<i4")
    flat, at = np.frombuffer(row["links"], "<i4"), 0
    for k, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
        width = 2 * LINKS if k == 0 else LINKS
        own = members[a:b]
        layer = np.full((n + 1, width), -1, np.int32)
        layer[own] = flat[at:at + width * len(own)].reshape(len(own), width)
        at += width * len(own)
        graph.layers.append(layer)
        graph.members.append(own)
    return ids, id_ends, vectors, graph


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, vec_id, vector) in order of shard; one index row a shard."""

    def index(shard: int, ids: list, parts: list) -> pa.RecordBatch:
        ids, ends, vectors = distinct_vectors(np.concatenate(ids), np.concatenate(parts))
        row = pack_graph(shard, ids, ends, vectors, Graph.build(vectors))
        return pa.RecordBatch.from_pylist([row], pa.schema(
            [(c.split()[0], pa.int32() if c.split()[1] == "int" else pa.binary())
             for c in INDEX.split(", ")]))

    shard, ids, parts = None, [], []
    for batch in batches:
        shards = batch.column(0).to_numpy()
        own, vectors = batch.column(1).to_numpy(), batch.column(2)
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if shards[a] != shard:
                if ids:
                    yield index(shard, ids, parts)
                shard, ids, parts = int(shards[a]), [], []
            ids.append(own[a:b].copy())
            parts.append(_matrix(vectors.slice(a, b - a)).copy())
    if ids:
        yield index(shard, ids, parts)


PACKED = "dim int, query_ids binary, queries binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, vector) to blocks of queries of one length."""
    for batch in batches:
        sizes = np.diff(batch.column(1).offsets.to_numpy())
        for dim in np.unique(sizes).tolist():
            same = batch.filter(pa.array(sizes == dim))
            for at in range(0, same.num_rows, QUERIES):
                part = same.slice(at, QUERIES)
                vectors = _matrix(part.column(1)).astype("<f8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()),
                     pa.array([part.column(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                     pa.array([vectors.tobytes()], pa.binary())], ["dim", "query_ids", "queries"])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A shard's index row comes before the blocks of queries sent to it."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda c: batch.column(batch.schema.get_field_index(c))[row].as_py()  # noqa: E731, B023
            if not get("is_query"):
                ids, ends, vectors, graph = unpack_graph({c.split()[0]: get(c.split()[0])
                                                          for c in INDEX.split(", ")})
                # of equal vectors only the first ids can be among the best (one is the
                # query's own at most)
                starts = np.r_[0, ends[:-1]]
                place = starts[:, None] + np.arange(min(k + 1, int((ends - starts).max())))
                heads = np.where(place < ends[:, None], ids[np.minimum(place, len(ids) - 1)], -1)
                used = place < ends[:, None]
                continue
            own = np.frombuffer(get("query_ids"), "<i8")
            wanted = np.frombuffer(get("queries"), "<f8").reshape(len(own), -1)
            for at in range(0, len(own), BATCH):
                q, who = wanted[at:at + BATCH], own[at:at + BATCH]
                near = graph.search(q)
                exact = np.einsum("qd,qkd->qk", q, vectors[near])
                found = heads[near].reshape(len(q), -1)
                real = (used[near] & (near >= 0)[:, :, None]).reshape(len(q), -1)
                exact = np.repeat(exact, heads.shape[1], axis=1)
                exact[~real | (found == who[:, None])] = -np.inf
                order = np.lexsort((found, -exact), axis=1)[:, :k]
                found, exact = (np.take_along_axis(x, order, axis=1) for x in (found, exact))
                r, c = np.nonzero(~np.isneginf(exact))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who[r]), pa.array(found[r, c]), pa.array(exact[r, c])],
                    ["query_id", "vec_id", "score"])


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id",
            vector: str = "embedding", shard_rows: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (inner product) of the ``k``
    best found for each row of ``vectors`` where ``queries`` holds.

    ``shard_rows``: vectors of a shard; from their length and ``SHARD_BYTES`` unless given."""
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"), queries.alias("is_query"))
    # one row a length: how many shards it has, and their first number
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()
    count = {r["dim"]: math.ceil(r["n"] / (shard_rows or max(1, SHARD_BYTES // (8 * r["dim"]))))
             for r in sizes}
    first, total = {}, 0
    for dim in sorted(count):
        first[dim], total = total, total + count[dim]
    if not total:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0.0).alias("score")).limit(0)
    of = lambda table, dim: F.element_at(F.create_map(*[
        F.lit(x) for pair in table.items() for x in pair]), dim)
    dim = F.size("vector")
    dealt = rows.select("vec_id", "vector").distinct().select(
        (of(first, dim) + F.pmod(F.xxhash64("vec_id", "vector"), of(count, dim))).cast("int")
        .alias("shard"), "vec_id", "vector")
    index = materialise(dealt.repartitionById(total, "shard").sortWithinPartitions("shard", "vec_id")
                        .mapInArrow(_build, INDEX), "ann-index")
    # every query meets every shard of its length: blocks of queries, dealt by shard number
    asked = (rows.where("is_query").groupBy("vec_id").agg(F.min("vector").alias("vector"))
             .mapInArrow(_pack, PACKED))
    blocks = asked.withColumn("shard", F.explode(F.sequence(
        of(first, F.col("dim")), of(first, F.col("dim")) + of(count, F.col("dim")) - 1)))
    both = (index.withColumn("is_query", F.lit(False))
            .unionByName(blocks.drop("dim").withColumn("is_query", F.lit(True)),
                         allowMissingColumns=True))
    found = (both.repartitionById(total, "shard").sortWithinPartitions("shard", "is_query")
             .mapInArrow(lambda b: _search(b, k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
