import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import simhash as S
from tidemark.llm.components import connected


def brute_fingerprint(text, k=3):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_awkward_documents(docs, empty):
    rows = docs.select("doc_id", "text").collect()
    got = S.near_duplicates(docs).collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    roots = brute_roots(fps, 3)
    ids = {}
    for r, k in zip(rows, roots):
        ids.setdefault(k, []).append(r["doc_id"])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    want = [(r["doc_id"], f"{f:016x}", least[k]) for r, f, k in zip(rows, fps, roots)]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert S.near_duplicates(empty).count() == 0
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert S.drop_near_duplicates(empty).count() == 0


def test_links_connect_like_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    fps = set()
    for _ in range(60):
        base = int(rng.integers(0, 1 << 63))
        for _ in range(rng.integers(1, 8)):
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                base ^= 1 << int(b)
            fps.add(base)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {}
    for f, r in zip(signed, brute_roots(fps, 3)):
        want.setdefault(r, set()).add(f)
    want = {frozenset(v) for v in want.values() if len(v) > 1}
    for block in (S.BLOCK, 4):        # 4: cells are dealt out as pairs of chunks
        monkeypatch.setattr(S, "BLOCK", block)
        parts = {}
        for r in connected(S.links(df, 3)).collect():
            parts.setdefault(r["root"], {r["root"]}).add(r["node"])
        assert {frozenset(v) for v in parts.values()} == want


@settings(max_examples=50, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.lists(st.integers(0, 63), max_size=3))
def test_lower_bound_and_grid(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    a, b = (S._counts(np.array([x], np.uint64))[0] for x in (fp, other))
    counts = [[int(c) >> 2 * k & 3 for k in range(32)] for c in (a, b)]
    assert counts[0] == [(fp >> 2 * k & 3).bit_count() for k in range(32)]
    assert sum(abs(x - y) for x, y in zip(*counts)) <= (fp ^ other).bit_count() <= 3
    assert any(int(a) & m % (1 << 64) == int(b) & m % (1 << 64) for m in S.grid_masks(3))


def test_large_clique_has_few_links(spark):
    base = 0x0123456789ABCDEF
    near = {base ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(40)}
    df = spark.createDataFrame([(f,) for f in near], "fp long")
    found = S.links(df, 3)
    assert found.count() < 30 * len(near)
    assert connected(found).agg(F.countDistinct("root")).first()[0] == 1


def test_chain_of_components(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(5, 5)],
                               "a long, b long")
    got = {r["node"]: r["root"] for r in connected(df).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41) if i not in (0, 21)}
