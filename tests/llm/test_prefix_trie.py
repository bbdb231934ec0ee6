import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as PT

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def brute(rows, shared=True):
    own = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((n is not None, n or 0, role, name[:32], text))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if shared else 0
        built[c] = own.get(c - c % 5, [])[:h] + v[h:] if shared else v
    nodes, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(built):
        turns = tuple(built[c])
        for k in range(len(turns) + 1):
            nodes[turns[:k]].append(c)
            if k:
                kids[turns[:k - 1]].add(turns[:k])
        ends[turns].append(c)
    leaves, saved, out = {}, {}, []
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in kids[p]) or 1
        own_size = len(p[-1][1].encode()) if p else 0
        saved[p] = (len(nodes[p]) - 1) * own_size + sum(saved[q] for q in kids[p])
        out.append((nodes[p][0], len(p), nodes[p[:-1]][0] if p else None, len(nodes[p]),
                    len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def conversations(seed, n):
    """Few roles and texts, so prefixes meet; null, tied and repeated turns, null ids."""
    rng = random.Random(seed)
    rows = [(c, None if rng.random() < 0.05 else k - (rng.random() < 0.05),
             rng.choice(["user", "bot", None, ""]), rng.choice(["", "x", "hé", None]))
            for c in range(n) for k in range(rng.randint(0, 12))]
    rows += [(10_000 + c, k, "user", "the same") for c in range(n) for k in range(3)]
    return rows + [(None, 0, "user", "x"), rows[0]]


@pytest.mark.parametrize("tasks", [1, 7, 40])
def test_nodes_against_brute_force(spark, tasks):
    """Whatever number of key ranges: hot first turns and copies span them."""
    rows = conversations(3, 60)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in (
        "key", "own", "sizes", "node", "part", "way", "depth", "base", "members")})
    conf = {"spark.sql.shuffle.partitions": str(tasks),
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert got(PT.rebuilt_nodes(df)) == brute(rows)
        assert got(PT.prefix_nodes(df)) == brute(rows, shared=False)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_turnless_and_long(spark):
    assert got(PT.rebuilt_nodes(spark.createDataFrame([], SCHEMA))) == []
    # 11: base absent, all of its own turns replaced by none
    some = next(c for c in range(11, 999, 5) if zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(some, 0, "user", "a"), (some, 1, "bot", "b")]
    nodes = got(PT.rebuilt_nodes(spark.createDataFrame(rows, SCHEMA)))
    assert nodes == brute(rows) and len(nodes) == 1 and nodes[0][1] == 0
    long = [(k, t, "user", f"turn {t}" + "x" * (t == 5) * 100_000) for k in (0, 5)
            for t in range(3000)]
    long += [(10, t, "user", f"turn {t}") for t in range(2)]
    assert got(PT.prefix_nodes(spark.createDataFrame(long, SCHEMA))) == brute(long, False)


def test_many_members_in_chunks(spark, monkeypatch):
    rows = [(c, 0, "user", "hi") for c in range(0, 3 * PT.CHUNK, 2)]
    assert got(PT.prefix_nodes(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_radix_tree_layouts():
    """Nodes grow through all four layouts; keys that begin others end inside paths."""
    rng = random.Random(1)
    keys = {bytes([rng.choice([k, 7])]) + rng.randbytes(rng.randint(0, 6)) for k in range(256)
            for _ in range(4)} | {bytes([9, k, 1]) for k in range(30)} | {b"", b"\x07" * 9}
    tree = PT.RadixTree()
    for k in rng.sample(sorted(keys), len(keys)):
        tree.insert(k, k)
    found, sizes, stack = [], set(), [(tree.root, b"")]
    while stack:
        node, way = stack.pop()
        way += node.path
        sizes.add(node.size)
        if node.leaf is not None:
            assert node.leaf == way
            found.append(way)
        kids = node.ordered()
        assert [k.path[0] for k in kids] == sorted({k.path[0] for k in kids})
        assert all(node.find(k.path[0]) is k for k in kids)
        assert node.leaf is not None or len(kids) > 1 or node is tree.root
        stack += [(k, way) for k in kids]
    assert sorted(found) == sorted(keys) and sizes == {4, 16, 48, 256}
