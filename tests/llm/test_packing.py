import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_fullest_is_the_best_subset(lengths):
    size = 31
    counts = np.bincount(lengths, minlength=size)
    pattern = P.fullest(counts, size)
    first, rest = max(lengths), sorted(lengths)[:-1]
    best = max(first + sum(c) for n in range(len(rest) + 1) for c in combinations(rest, n)
               if first + sum(c) <= size)
    assert sum(x * c for x, c in pattern) == best
    assert pattern[0][0] == first and all(c <= counts[x] for x, c in pattern)


def test_patterns_place_every_length():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, 2048)
    counts[0] = 0
    found = P.patterns(counts)
    used = np.zeros(2048, int)
    for times, pattern in found:
        assert sum(x * c for x, c in pattern) <= 2048
        for x, c in pattern:
            used[x] += times * c
    assert (used == counts).all()
    waste = sum(t * (2048 - sum(x * c for x, c in p)) for t, p in found)
    assert waste < 0.01 * sum(x * c for x, c in enumerate(counts.tolist()))


def check(rows, docs, size=2048):
    library = Tokenizer.from_file(PATH)
    want = sorted(([*library.encode(t or "", add_special_tokens=False).ids, 1] for t in docs),
                  key=lambda x: (len(x), x))
    groups, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        groups[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    crcs = defaultdict(int)
    for ids in want:
        for at in range(0, len(ids), size):
            piece = np.array(ids[at:at + size], "<u4").tobytes()
            crcs[at, len(piece) // 4, zlib.crc32(piece), len(ids)] += 1
    got = defaultdict(int)
    for r in rows:
        got[r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
    assert got == crcs
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size


def test_awkward_documents(docs, empty):
    rows = P.pack(docs, PATH).collect()
    check(rows, [r["text"] for r in docs.collect()])
    assert P.pack(empty, PATH).count() == 0
    check(P.pack(docs, PATH, size=64).collect(), [r["text"] for r in docs.collect()], 64)


def test_a_length_that_most_rows_share(spark):
    df = spark.createDataFrame([(k % 7, "the river" if k % 9 else f"river {k}")
                                for k in range(3000)], "doc_id long, text string")
    rows = P.pack(df, PATH).collect()
    check(rows, [r["text"] for r in df.collect()])
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-tokens // 2048) + 1
