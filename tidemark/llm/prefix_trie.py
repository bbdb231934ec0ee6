"""The prefix trie of conversations, from radix trees over ranges of their keys.

A turn's id is the first 16 bytes of the SHA-256 of its role's length, role and text,
read big-endian; equal turns have equal ids in every task without a table of turns. A
conversation's key is its turns' ids one after the other, so the byte order of the keys is the
order of a walk through the trie.

1. Keys are dealt by ranges of (key, conv_id): a first turn, or a whole
   conversation, that a third of the rows share spans tasks. Each task joins
   equal keys to one row for up to ``CHUNK`` members, with their ids in order as text.
2. These rows are dealt by ranges of the key. A task streams them: equal keys are
   closed by hashing their texts one after the other, and the distinct keys go into an adaptive
   radix tree: nodes of 4, 16, 48 or 256 places that grow as children come, with chains of
   single children kept as one byte string. The tree is walked once, children first; each
   turn-aligned byte depth, inside such strings too, gives a node.
3. Only nodes on the way to a task's first or last key can have members elsewhere.
   They leave the task as open rows (two ways of a conversation's depth a task); equal prefixes are
   added up and one ordered pass with a stack of one way puts their subtrees together. Closed
   nodes below an open one get its smallest member by a join on (task, way, depth).

Defined results: rows without conv_id belong to no conversation and are left out;
turns are in order of turn (null first), then role, then turn id, so ties and
repeated turns have one order and are all kept; null role or text is empty; texts are hashed
whole; an empty table gives an empty result; other columns are ignored. A conversation's list of
ids (24 bytes a turn), not its text, is held in one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

WIDTH = 16          # bytes of a turn id
CHUNK = 4096        # members of one row of a key


class Node:
    """A radix-tree node: the bytes that lead to it from its parent's branch byte on
    (``path``), and its children in one of four layouts.

    Up to 16 children: sorted branch bytes beside the children. 48: a table of 256
    places that point into the list of children. 256: the children by branch byte."""

    __slots__ = ("path", "size", "bytes", "children", "leaf")

    def __init__(self, path: bytes, leaf=None) -> None:
        self.path, self.leaf = path, leaf
        self.size, self.bytes, self.children = 4, bytearray(), []

    def find(self, byte: int):
        if self.size <= 16:
            at = self.bytes.find(byte)
            return self.children[at] if at >= 0 else None
        if self.size == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            table = bytearray(256)
            for k, byte in enumerate(self.bytes):
                table[byte] = k + 1
            self.size, self.bytes = 48, table
        else:
            wide = [None] * 256
            for byte, at in enumerate(self.bytes):
                if at:
                    wide[byte] = self.children[at - 1]
            self.size, self.bytes, self.children = 256, bytearray(), wide

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or replace the one with that branch byte."""
        if self.size <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.children[at] = child
                return
        elif self.size == 48 and self.bytes[byte]:
            self.children[self.bytes[byte] - 1] = child
            return
        if self.size < 256 and len(self.children) == self.size:
            self.grow()
        if self.size <= 16:
            at = sum(b < byte for b in self.bytes)
            self.bytes.insert(at, byte)
            self.children.insert(at, child)
        elif self.size == 48:
            self.children.append(child)
            self.bytes[byte] = len(self.children)
        else:
            self.children[byte] = child

    def ordered(self) -> list[Node]:
        """The children by branch byte."""
        if self.size <= 16:
            return self.children
        if self.size == 48:
            return [self.children[at - 1] for at in self.bytes if at]
        return [c for c in self.children if c is not None]


def shared(a: bytes, at: int, b: bytes, start: int) -> int:
    """How many bytes a[at:] and b[start:] have in common."""
    n = min(len(a) - at, len(b) - start)
    if a[at:at + n] == b[start:start + n]:
        return n
    x = int.from_bytes(a[at:at + n], "big") ^ int.from_bytes(b[start:start + n], "big")
    return n - (x.bit_length() + 7) // 8


class RadixTree:
    """Distinct byte keys with one value each."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, leaf) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.leaf = leaf
                return
            child = node.find(key[at])
            if child is None:
                node.put(key[at], Node(key[at:], leaf))
                return
            same = shared(child.path, 0, key, at)
            if same < len(child.path):          # the path parts inside the child
                fork = Node(child.path[:same])
                node.put(key[at], fork)
                child.path = child.path[same:]
                fork.put(child.path[0], child)
                child = fork
            node, at = child, at + same


NOBODY = hashlib.sha256(b"").hexdigest()
CLOSED = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string")
#: Rows of ``trees``: closed nodes, with (part, way) if their parent is open; or open
#: nodes, with a ``node``.
ROWS = CLOSED + ", node binary, size long, part int, way int"


def chain(key: bytes) -> list[bytes]:
    """A name for each prefix of whole turns: digests of (name before, turn id)."""
    names = [bytes(WIDTH)]
    for at in range(0, len(key), WIDTH):
        names.append(hashlib.sha256(names[-1] + key[at:at + WIDTH]).digest()[:WIDTH])
    return names


class Frame:
    """A radix-tree node during the walk, with the sums of what lies below it."""

    __slots__ = ("node", "kids", "seen", "bottom", "on_first", "on_last", "waiting",
                 "n", "least", "children", "leaves", "saved", "sizes")

    def __init__(self, node: Node, above: Frame | None, first: bytes, last: bytes) -> None:
        self.node, self.kids, self.seen = node, node.ordered(), 0
        start = above.bottom if above else 0
        self.bottom = start + len(node.path)
        # how many bytes of the way here agree with the first and the last key
        self.on_first = above.on_first if above else 0
        self.on_last = above.on_last if above else 0
        if self.on_first == start:
            self.on_first += shared(node.path, 0, first, start)
        if self.on_last == start:
            self.on_last += shared(node.path, 0, last, start)
        self.waiting: list[tuple] = []      # closed nodes that lack their parent's least member
        self.n, self.least, self.sizes = 0, None, None
        self.children = self.leaves = self.saved = 0

    def add(self, n: int, least: int, sizes: list[int]) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)
        self.sizes = sizes

    def take(self, below: Frame) -> None:
        self.add(below.n, below.least, below.sizes)
        self.children += below.children
        self.leaves += below.leaves
        self.saved += below.saved
        self.waiting += below.waiting


def node_rows(keys: list[tuple], part: int) -> Iterator[tuple]:
    """Rows of the nodes of one task's sorted distinct keys, children before parents.

    ``keys`` has (key, turn sizes, members, smallest member, digest of the members)."""
    first, last = keys[0][0], keys[-1][0]
    names = chain(first), chain(last)
    tree = RadixTree()
    for key, *leaf in keys:
        tree.insert(key, leaf)
    frames = [Frame(tree.root, None, first, last)]
    while frames:
        frame = frames[-1]
        if frame.seen < len(frame.kids):
            frame.seen += 1
            frames.append(Frame(frame.kids[frame.seen - 1], frame, first, last))
            continue
        frames.pop()
        ends, leaf = NOBODY, frame.node.leaf
        if leaf is not None:
            sizes, n, least, ends = leaf
            frame.add(n, least, sizes)
        top = frame.bottom - len(frame.node.path)
        # turn-aligned depths of this node's bytes, deepest first; the root is its own
        for depth in range(frame.bottom // WIDTH, (top // WIDTH if frames else -1), -1):
            mine = ends if depth * WIDTH == frame.bottom else NOBODY
            size = frame.sizes[depth - 1] if depth else 0
            if depth * WIDTH <= max(frame.on_first, frame.on_last):
                way = 0 if depth * WIDTH <= frame.on_first else 1
                yield from ((*w, None, None, part, way) for w in frame.waiting)
                yield (frame.least, depth, None, frame.n, frame.children, frame.leaves,
                       frame.saved, mine, names[way][depth], size, part, way)
                # it is counted above when the tasks' parts of it have met
                frame.waiting, frame.children, frame.leaves, frame.saved = [], 0, 0, 0
            else:
                yield from ((*w[:2], frame.least, *w[3:], None, None, None, None)
                            for w in frame.waiting)
                leaves = frame.leaves or 1
                saved = (frame.n - 1) * size + frame.saved
                frame.waiting = [(frame.least, depth, None, frame.n, frame.children, leaves,
                                  saved, mine)]
                frame.children, frame.leaves, frame.saved = 1, leaves, saved
        if frames:
            frames[-1].take(frame)


def keyed(turns: DataFrame, shared_turns=None) -> DataFrame:
    """key, sizes (UTF-8 bytes of each turn's text) and conv_id of each rebuilt
    conversation.

    ``shared_turns`` is (group size, head): a Column function of conv_id for the number
    of first turns taken over from the conversation that begins its group."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role,
                                         text), 256), 1, 2 * WIDTH)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", role.alias("role"), digest.alias("id"),
                            F.octet_length(text).cast("long").alias("size")).alias("t"))
    own = rows.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list("t")),
        lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("own"))
    if shared_turns:
        group, head, most = shared_turns
        own = materialise(own, "turn-ids")
        conv = F.col("conv_id")
        base = own.where(conv % group == 0).select(
            conv.alias("base"), F.slice("own", 1, most).alias("lead"))
        joined = own.withColumn("base", conv - conv % group).join(base, "base", "left")
        h = head(conv)
        # a head of no turns: slices of length 0 are empty, an absent base as well
        lead = F.slice(F.coalesce("lead", F.array().cast(base.schema["lead"].dataType)), F.lit(1), h)
        rest = F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))
        own = joined.select("conv_id", F.concat(lead, rest).alias("own"))
    return own.select(F.unhex(F.array_join(F.transform("own", lambda t: t["id"]), "")).alias("key"),
                      F.transform("own", lambda t: t["size"]).alias("sizes"), "conv_id")


def chunks(rows: DataFrame) -> DataFrame:
    """Sorted (key, sizes, conv_id) rows to one row for up to ``CHUNK`` members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sizes, members, out = None, None, [], []

        def close() -> None:
            if members:
                out.append((key, sizes, members[0], len(members), ",".join(map(str, members))))
                members.clear()

        for batch in batches:
            for k, s, c in zip(*(x.to_pylist() for x in batch.columns)):
                if k != key or len(members) == CHUNK:
                    close()
                    key, sizes = k, s
                members.append(c)
            if out:
                yield records(out, kinds)
                out = []
        close()
        if out:
            yield records(out, kinds)

    kinds = [("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("least", pa.int64()),
             ("n", pa.int64()), ("members", pa.string())]
    return rows.select("key", "sizes", "conv_id").mapInArrow(
        run, "key binary, sizes array<long>, least long, n long, members string")


def records(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])


def fields(schema: str) -> list[tuple]:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    return [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]


def distinct_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, sizes, members, smallest member, digest) of sorted chunk rows."""
    key = sizes = least = sha = None
    n = 0
    for batch in batches:
        for k, s, first, count, members in zip(*(x.to_pylist() for x in batch.columns)):
            if k == key:
                sha.update(b",")
            else:
                if key is not None:
                    yield key, sizes, n, least, sha.hexdigest()
                key, sizes, least, n, sha = k, s, first, 0, hashlib.sha256()
            n += count
            sha.update(members.encode())
    if key is not None:
        yield key, sizes, n, least, sha.hexdigest()


def trees(rows: DataFrame) -> DataFrame:
    """Closed and open node rows of key ranges, one radix tree a task."""
    kinds = fields(ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = list(distinct_keys(batches))
        if not keys:
            return
        found = node_rows(keys, TaskContext.get().partitionId())
        while part := list(islice(found, 8192)):
            yield records(part, kinds)

    return rows.mapInArrow(run, ROWS)


def put_together(opened: DataFrame) -> DataFrame:
    """Open nodes with members of several tasks: name and the node's result row."""
    merged = opened.groupBy("node").agg(
        F.min(F.col("part").cast("long") * 2 + F.col("way")).alias("at"),
        F.max("depth").alias("depth"), F.min("conv_id").alias("least"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("size").alias("size"),
        # one task at most has the key that ends here
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NOBODY, F.col("ends_sha256"))),
                   F.lit(NOBODY)).alias("ends"))
    schema = "node binary, " + CLOSED
    kinds = fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []           # the nodes above, from the root
        out: list[tuple] = []

        def close() -> None:
            _, depth, node, least, n, children, leaves, saved, size, ends = stack.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * size
            if stack:
                above = stack[-1]
                above[5] += 1
                above[6] += leaves
                above[7] += saved
            out.append((node, least, depth, stack[-1][3] if stack else None, n, children, leaves,
                        saved, ends))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                while len(stack) > row[1]:
                    close()
                stack.append(list(row))
            if out:
                yield records(out, kinds)
                out = []
        while stack:
            close()
        if out:
            yield records(out, kinds)

    # ways follow each other in key order and a node belongs to its first: parents come
    # before children. Two ways a task, so one ordered task
    return (merged.select("at", "depth", "node", "least", "n_convs", "n_children", "n_leaves",
                          "saved_tokens", "size", "ends")
            .repartition(1).sortWithinPartitions("at", "depth").mapInArrow(run, schema))


def prefix_nodes(turns: DataFrame, shared_turns=None) -> DataFrame:
    """One row for each distinct prefix of the (rebuilt) conversations: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256."""
    key = ["key", "conv_id"]
    # sampling for the ranges reads a table, not the grouping before it
    rows = materialise(keyed(turns, shared_turns), "keys")
    rows = chunks(rows.repartitionByRange(*key).sortWithinPartitions(*key))
    rows = materialise(rows, "members")
    rows = rows.repartitionByRange("key").sortWithinPartitions("key", "least")
    made = materialise(trees(rows), "trees")
    columns = [n for n, _ in fields(CLOSED)]
    opened = made.where(F.col("node").isNotNull())
    whole = materialise(put_together(opened), "open-nodes")
    closed = made.where(F.col("node").isNull())
    above = (opened.select("part", "way", "node", F.col("depth").alias("_up"))
             .join(whole.select("node", F.col("conv_id").alias("_least")), "node").drop("node"))
    hanging = (closed.where(F.col("part").isNotNull()).withColumn("_up", F.col("depth") - 1)
               .join(above, ["part", "way", "_up"]).withColumn("parent_conv_id", F.col("_least")))
    return (closed.where(F.col("part").isNull()).select(*columns)
            .unionByName(hanging.select(*columns)).unionByName(whole.select(*columns)))


def rebuilt_nodes(turns: DataFrame) -> DataFrame:
    """The nodes of conversations of which each takes over the first
    crc32(conv_id) % 9 turns of the one that begins its group of five ids."""
    return prefix_nodes(turns, (5, lambda c: (F.crc32(c.cast("string")) % 9).cast("int"), 8))
