"""The fitted classifier and its batches of a token budget."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import classifier as CL
from tidemark.operators import sentiment as SN
from tidemark.plans import q_news as Q
from tidemark.sources import fixtures as FX


def test_batches_keep_to_the_budget_and_every_text():
    rng = np.random.default_rng(3)
    lengths = np.r_[rng.integers(0, 400, 500), 0, 0, 9_000]
    batches = CL.budget_batches(lengths, 4_096)
    assert sorted(np.concatenate(batches)) == list(range(len(lengths)))
    for b in batches:
        assert len(b) == 1 or lengths[b].max() * len(b) <= 4_096
    in_order = np.array_split(np.arange(len(lengths)), len(batches))
    assert CL.padding_share(lengths, batches) < 0.12 < CL.padding_share(lengths, in_order)
    assert CL.budget_batches(np.zeros(0, np.int64)) == []


def test_scores_come_back_in_the_order_of_the_rows():
    texts = ["b a", "", "c", "a " * 50 + "b c d", "d"]
    place = {w: k + 1 for k, w in enumerate("abcd")}
    encode = lambda t: np.array([place[w] for w in t.split()], np.int64)
    weights = np.r_[np.zeros((1, 3)), np.arange(12.0).reshape(4, 3)]
    seen = []

    def forward(padded):
        seen.append(padded.shape)
        return weights[padded].sum(axis=1)

    got = CL.score_batch(texts, encode, forward, budget=6)
    want = [weights[encode(t)].sum(axis=0) for t in texts]
    assert np.allclose(got, want) and len(seen) > 1
    assert CL.score_batch([], encode, forward).shape == (0, 3)


def brute(rows, gate):
    """Weights by word and the prior, from the definition."""
    n = Counter(label for _, label in rows)
    held = Counter((w, label) for t, label in rows for w in set(re.findall(r"\w+|[^\w\s]", t.lower(), re.A)))
    out = {}
    for w in {w for w, _ in held}:
        each = []
        for c in range(3):
            a, b = held[w, c] + 0.5, sum(held[w, k] for k in range(3) if k != c) + 0.5
            own, rest = n[c] + 1, len(rows) - n[c] + 1
            o = math.log(a / (own - a)) - math.log(b / (rest - b))
            each.append(o if abs(o) / math.sqrt(1 / a + 1 / b) >= gate else 0.0)
        if any(each):
            out[w] = each
    return out, [math.log((n[c] + 1) / (len(rows) + 3)) for c in range(3)]


def test_weights_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(400):
        c = int(rng.integers(0, 3))
        words = rng.choice(["Sun", "rain", "wind", "snow", "!"], 3).tolist() + [f"only{c}"] * (k % 2)
        rows.append((" ".join(words), c))
    want, prior = brute(rows, CL.GATE)
    df = spark.createDataFrame([*rows, ("only0 never", None)], "t string, label int")
    got = CL.learn(df)
    assert {w: tuple(got.weights[k + 1]) for k, w in enumerate(got.words)} == \
        {w: pytest.approx(v) for w, v in want.items()}
    assert {"only0", "only1", "only2"} <= set(want) and np.allclose(got.prior, prior)
    assert len(CL.learn(df, vocabulary=2).words) == 2


def test_nothing_learned_and_empty_texts(spark):
    model = CL.learn(spark.createDataFrame([], "t string, label int"))
    assert model.words == () and np.allclose(model.prior, math.log(1 / 3))
    a = spark.createDataFrame([("2024-01-01", "1", None, None), ("2024-01-01", "2", "", "x")],
                              "localDate string, id string, title string, body string")
    got = SN.score_articles(a, CL.budget_scorer(model.load)).collect()
    assert [r.sentiment_score for r in got] == [0.0, 0.0]
    assert SN.score_articles(a.limit(0), CL.budget_scorer(model.load)).count() == 0


def test_held_out_accuracy(spark):
    """Held-out articles (a quarter by id): clean ones are left alone, toxic ones score lower."""
    sf_dir = "/root/testdata/sf0.01"
    model = Q.polarity_model(spark, sf_dir)
    a = FX.articles(spark, sf_dir).where(F.col("doc_id") % 4 == 2)
    known = FX.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), "toxic")
    got = SN.score_articles(a, CL.budget_scorer(model.load)).join(known, "id").collect()
    clean = [r.sentiment_score > 0 for r in got if not r.toxic]
    toxic = np.array([r.sentiment_score for r in got if r.toxic])
    assert np.mean(clean) > 0.95
    assert len(toxic) > 5 and toxic.mean() < np.mean([r.sentiment_score for r in got if not r.toxic])
