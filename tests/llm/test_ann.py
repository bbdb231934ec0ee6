import math

import numpy as np
import pytest

from tidemark.llm import ann


def clustered(n, dim, seed, same=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, dim))
    x *= rng.uniform(0.5, 2, size=(n, 1))
    if same:                                # a third are copies of one vector, or nearly
        x[:n // 6] = x[0]
        x[n // 6:n // 3] = x[0] + 0.01 * rng.normal(size=(n // 3 - n // 6, dim))
    return x.astype(np.float32)


def frame(spark, ids, vectors):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 0)
                                  for i, v in zip(ids, vectors)],
                                 "vec_id long, embedding array<float>, score int")


@pytest.mark.parametrize("same", [False, True])
def test_recall(spark, same):
    x = clustered(3000, 24, 1, same)
    got = ann.nearest(frame(spark, range(3000), x), ann.F.col("vec_id") % 20 == 0,
                      shard_rows=1200).toPandas()
    y, found, total = x.astype(np.float64), 0, 0
    for q in range(0, 3000, 20):
        scores = y @ y[q]
        scores[q] = -np.inf
        kth = np.sort(scores)[-20]
        own = got[got["query_id"] == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        assert np.allclose(own["score"], scores[own["vec_id"]], atol=1e-9, rtol=0)
        order = list(zip(-own["score"], own["vec_id"]))
        assert order == sorted(order) and len(set(own["vec_id"])) == 20
        found += (own["score"] >= kth - 1e-12).sum()
        total += 20
    assert found / total >= 0.9


def test_awkward_rows(spark):
    ids = [0, 1, 2, 3, 4, 5, 6, None, 20, 20, 7, 7]
    vectors = [[1, 0], None, [0, 0], [math.nan, 1], [math.inf, 1], [1, 2], [3, 4, 5], [1, 1],
               [2, 1], [2, 1], [-1, 5], [-1, 5]]
    got = ann.nearest(frame(spark, ids, vectors), ann.F.col("vec_id") % 20 == 0).collect()
    rows = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        rows.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert rows == {0: [(20, 2.0), (5, 1.0), (7, -1.0)], 20: [(5, 4.0), (7, 3.0), (0, 2.0)]}


def test_empty_and_alone(spark):
    df = frame(spark, [0], [[1.0, 2.0]])
    assert ann.nearest(df, ann.F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(df.where("false"), ann.F.col("vec_id") % 20 == 0).count() == 0


def test_index_round_trip():
    x = clustered(700, 8, 2)
    graph = ann.Graph.build(x.astype(np.float64))
    ids, ends, vectors, back = ann.unpack_graph(ann.pack_graph(
        0, np.arange(700), np.arange(700) + 1, x, graph))
    assert (vectors == x).all() and ids.tolist() == list(range(700)) == (ends - 1).tolist()
    q = x[:50].astype(np.float64)
    assert (graph.search(q, 32) == back.search(q, 32)).all()
    assert len(graph.layers) > 1 and (graph.layers[0][:700] >= 0).any(axis=1).all()


def test_equal_vectors_go_by_their_ids(spark):
    """A third of the rows share one vector: the smallest ids are the answer."""
    x = clustered(1500, 16, 4)
    x[::3] = 3 * x[0]
    got = ann.nearest(frame(spark, range(1500), x), ann.F.col("vec_id") % 300 == 0,
                      shard_rows=500).collect()
    same = list(range(0, 1500, 3))
    for q in range(0, 1500, 300):
        own = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert own == [i for i in same if i != q][:20]


def test_each_length_on_its_own(spark):
    """Vectors of several lengths: candidates are those of the query's length; nothing drops."""
    lengths = {0: 3, 1: 5, 2: 8}
    x = {i: clustered(1, lengths[i % 3], 100 + i)[0] for i in range(240)}
    got = ann.nearest(frame(spark, x, x.values()), ann.F.col("vec_id") % 20 == 0, k=5,
                      shard_rows=30).collect()
    for q in range(0, 240, 20):
        same = [i for i in x if i % 3 == q % 3 and i != q]
        scores = {i: float(x[i].astype(np.float64) @ x[q].astype(np.float64)) for i in same}
        want = sorted(same, key=lambda i: (-scores[i], i))[:5]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["vec_id"] for r in own] == want
        assert all(abs(r["score"] - scores[r["vec_id"]]) < 1e-9 for r in own)


def test_repeated_rows_and_ids_fill_no_shard(spark):
    """One id with many vectors is spread over the shards; one row many times is one row."""
    x = clustered(600, 6, 9)
    ids = [7] * 300 + list(range(1000, 1300))
    df = frame(spark, ids + [20] * 500, np.concatenate([x, np.repeat(x[:1], 500, axis=0)]))
    rows = ann.nearest(df, ann.F.col("vec_id") == 20, k=30, shard_rows=200).collect()
    y = x.astype(np.float64)
    scores = y @ y[0]
    want = sorted(zip(-scores, ids))[:30]
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [i for _, i in want]


def test_queries_in_blocks():
    packed = list(ann._pack([ann.pa.RecordBatch.from_pydict(
        {"v": list(range(5000)), "x": [[float(k)] * (1 + k % 2) for k in range(5000)]})]))
    assert [b.num_rows for b in packed] == [1] * 4
    sizes = [len(b.column(1)[0].as_py()) // 8 for b in packed]
    assert sizes == [2048, 452, 2048, 452]
    one = np.frombuffer(packed[2].column(2)[0].as_py()).reshape(-1, 2)
    assert one[:3].tolist() == [[1.0, 1.0], [3.0, 3.0], [5.0, 5.0]]
