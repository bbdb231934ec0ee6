"""Whole results of the model queries against features times the saved coefficients."""

import datetime as dt
import math

import numpy as np
import pytest

from tidemark import config as C
from tidemark.operators import dataset as DS
from tidemark.operators import halo
from tidemark.operators import heads as H
from tidemark.operators import models as MD
from tidemark.plans import q_models as Q
from tidemark.session import scratch_path


@pytest.fixture
def small(spark, monkeypatch):
    """Two symbols over 400 weekdays and two news columns, in place of the orders."""
    rng = np.random.default_rng(3)
    first, days = dt.date(2020, 1, 1), []
    while len(days) < 400:
        day = first + dt.timedelta(days=len(days) * 7 // 5)
        while day.weekday() > 4 or day in days:
            day += dt.timedelta(days=1)
        days.append(day)
    num = lambda n: [float(v) for v in rng.normal(size=n)]
    features = ", ".join(f"{f} double" for f in C.PIVOTED_FEATURES)
    panel = spark.createDataFrame([(d, i, k, *num(len(C.PIVOTED_FEATURES))) for d in days
                                   for k, i in enumerate("AB")],
                                  f"localDate date, id string, pos int, {features}")
    row = lambda: [0.01 * v if h in MD.LOG_HEADS else float(v > 0) if h == "direction_1d"
                   else v for h, v in zip(MD.HEADS, num(len(MD.HEADS)))]
    targets = spark.createDataFrame([(d, i, *row()) for d in days for i in "AB"],
                                    "localDate date, id string, " +
                                    ", ".join(f"{h} double" for h in MD.HEADS))
    lagged = spark.createDataFrame([(d, *num(2)) for d in days],
                                   "localDate date, `m-1` double, `m-2` double")
    symbols = spark.createDataFrame([("A", 0), ("B", 1)], "id string, pos int")
    made = [x.cache() for x in (panel, targets, lagged, panel.select("localDate").distinct(), symbols)]
    monkeypatch.setattr(Q, "dataset", lambda *_, **__: tuple(made))
    return made


def coefficients(root):
    """Per head: (weights, the stock's steps first, and intercept) of the one model under ``root``."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    heads = H.load(spark, MD.best_model_dir(spark, root))
    return {h: (w, b) for h, w, b in zip(H.HEADS, heads.vectors(), heads.intercept)}


def matrix(small, labels=True):
    """(date position, X, Y) of every sample, each a whole vector."""
    panel, targets, lagged, aligned, _ = small
    dates = sorted(r.localDate for r in aligned.collect())
    at = {d: k for k, d in enumerate(dates)}
    bars = {(at[r.localDate], r.id): [float(r[f]) for f in C.PIVOTED_FEATURES]
            for r in panel.collect()}
    news = {at[r.localDate]: [float(v) for v in r[1:]] for r in lagged.collect()}
    y = {(at[r.localDate], r.id): [float(r[f"y_{h}"]) for h in H.HEADS]
         for r in H.scaled_targets(targets).collect()}
    t, x, out = [], [], []
    for k in range(C.WINDOW_SIZE, len(dates)):
        for i in "AB":
            steps = range(k - C.WINDOW_SIZE, k)
            x.append([v for j in steps for v in bars[j, i]] + [v for j in steps for v in news[j]])
            out.append(y[k, i])
            t.append(k)
    return np.array(t), np.array(x), np.array(out)


def test_ridge_equals_numpy(spark, sf_dir, small):
    """Weights of the five continuous heads are the numpy ridge solution; those of the
    direction are where the gradient of its penalised likelihood is zero."""
    s, _ = Q.head_samples(spark, sf_dir)
    heads = H.ridge(s)
    t, x, y = matrix(small)
    x, y = x[t < s.first_validation], y[t < s.first_validation]
    mean, std = x.mean(axis=0), x.std(axis=0)
    z = (x - mean) / std
    a = z.T @ z / len(z) + H.RIDGE * np.eye(z.shape[1])
    want = np.linalg.solve(a, z.T @ (y - y.mean(axis=0)) / len(z)) / std[:, None]
    got = heads.vectors()
    for k, h in enumerate(H.HEADS):
        if k != H.UP:
            assert np.allclose(got[k], want[:, k], rtol=1e-6, atol=1e-6 * np.abs(want[:, k]).max()), h
            assert math.isclose(heads.intercept[k], y[:, k].mean() - mean @ want[:, k],
                                rel_tol=1e-6, abs_tol=1e-6)
    p = 1 / (1 + np.exp(-(x @ got[H.UP] + heads.intercept[H.UP])))
    gradient = (z.T @ (y[:, H.UP] - p)) / len(z) - H.RIDGE * got[H.UP] * std
    assert np.abs(gradient).max() < 1e-8 and abs((y[:, H.UP] - p).mean()) < 1e-8


def test_moments_are_sums_over_samples(spark, sf_dir, small):
    """The matrix of one pass is that of the whole samples; the dates span two blocks."""
    t, x, y = matrix(small)
    assert max(t) > halo.BLOCK
    s, _ = Q.head_samples(spark, sf_dir)
    m = H.moments(s)
    own = t < s.first_validation
    ones = np.column_stack([np.ones(own.sum()), x[own]])
    assert np.allclose(m.gram, ones.T @ ones, rtol=1e-9, atol=1e-9)
    assert np.allclose(m.cross, ones.T @ y[own], rtol=1e-9, atol=1e-9)
    assert np.allclose(m.total, m.gram[0]) and np.allclose(m.squares, np.diag(m.gram))
    part = H.moments(s, full=False)
    assert part.gram is None and all(np.allclose(getattr(part, c), getattr(m, c)) for c in (
        "total", "squares", "cross", "low", "high"))
    assert np.allclose(m.low, x[own].min(axis=0)) and np.allclose(m.high, x[own].max(axis=0))


def test_no_plan_makes_whole_vectors(spark, sf_dir, small):
    """Predictions come from rows and step weights: the plan holds no window of rows but the
    blocks', and reads only the dates that some window needs."""
    panel, _, lagged, aligned, _ = small
    heads = H.Heads(np.zeros((6, 30, 5)), np.zeros((6, 30, 2)), np.zeros(6))
    dates = sorted(r.localDate for r in aligned.collect())
    pending = spark.createDataFrame([(dates[-1],), (dates[-2],)], "query_date date")
    out = MD.predict_for_dates(heads, pending, panel, lagged, aligned)
    assert {(r.localDate, r.symbol, r.direction_1d) for r in out.collect()} == {
        (d, i, 0.5) for d in dates[-2:] for i in "AB"}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "UDT" not in plan and "VectorUDT" not in plan
    assert MD.predict_for_dates(heads, pending.where("false"), panel, lagged, aligned).count() == 0


def test_marginal_heads_and_constant_features(spark, sf_dir, small):
    s, _ = Q.head_samples(spark, sf_dir)
    t, x, y = matrix(small)
    own = t < s.first_validation
    x, y = x[own], y[own]
    heads = H.marginal(s)
    cov = (x - x.mean(axis=0)).T @ (y - y.mean(axis=0)) / len(x)
    want = (cov / x.var(axis=0)[:, None]).T / x.shape[1]
    assert np.allclose(heads.vectors(), want, rtol=1e-8, atol=1e-12)
    m = H.moments(s)
    m.low[3] = m.high[3]                   # a feature without variation weighs nothing
    weights, _ = H.solve_ridge(m, H.RIDGE)
    assert (weights[:, 3] == 0).all() and (weights[:, 4] != 0).all()


def test_saved_heads_come_back(spark):
    rng = np.random.default_rng(1)
    heads = H.Heads(rng.normal(size=(6, 3, 5)), rng.normal(size=(6, 3, 2)), rng.normal(size=6), "linear")
    root = scratch_path(spark, "heads")
    H.save(heads, spark, root)
    back = H.load(spark, root)
    assert back.link == "linear" and (back.vectors() == heads.vectors()).all()
    assert (back.intercept == heads.intercept).all() and back.window == 3


def test_every_pending_weekday_has_its_heads(spark, sf_dir, small):
    root = scratch_path(spark, "model")
    got = {(r.localDate, r.symbol): r for r in Q.q_predict_pending_heads(spark, sf_dir, root).collect()}
    panel, _, lagged, aligned, symbols = small
    dates = sorted(r.localDate for r in aligned.collect())
    ids = [r.id for r in symbols.collect()]
    bars = {(r.localDate, r.id): [float(r[f]) for f in C.PIVOTED_FEATURES] for r in panel.collect()}
    news = {r.localDate: [float(v) for v in r[1:]] for r in lagged.collect()}
    last = dates[DS.split_point(len(dates))[0] - 1]              # the last date trained on
    end = dates[-1] + dt.timedelta(days=1)
    while end.weekday() > 4:
        end += dt.timedelta(days=1)
    days = [d for k in range(1, (end - last).days + 1)
            if (d := last + dt.timedelta(days=k)).weekday() < 5]
    assert len(days) > 50 and got.keys() == {(d, i) for d in days for i in ids}
    heads = coefficients(root)
    for d in days:
        window = [x for x in dates if x < d][-C.WINDOW_SIZE:]
        for i in ids:
            x = np.array([v for w in window for v in bars[w, i]] + [v for w in window for v in news[w]])
            for h, (beta, b0) in heads.items():
                want = float(x @ beta + b0)
                if h == "direction_1d":
                    want = 1 / (1 + math.exp(-want))
                elif h in MD.LOG_HEADS:
                    want /= C.TARGET_SCALE
                assert math.isclose(got[d, i][h], want, rel_tol=1e-4, abs_tol=1e-6), (d, i, h)


def test_losses_match_brute_force(spark, sf_dir, small):
    root = scratch_path(spark, "model")
    got = {r["head"]: r.loss for r in Q.q_train_heads(spark, sf_dir, root).collect()}
    t, x, labels = matrix(small)
    held = t >= DS.split_point(max(t) + 1)[0]
    want = {}
    for k, (h, (beta, b0)) in enumerate(coefficients(root).items()):
        p, y = x[held] @ beta + b0, labels[held, k]
        if h == "direction_1d":
            p = np.clip(1 / (1 + np.exp(-p)), 1e-7, 1 - 1e-7)
            each = -(y * np.log(p) + (1 - y) * np.log(1 - p))
        elif h == "rank_1d":
            e, d = np.abs(p - y), C.HUBER_DELTA
            each = np.where(e <= d, e * e / 2, d * (e - d / 2))
        elif h in MD.LOG_HEADS:
            clip = 10 * C.TARGET_SCALE
            each = (np.clip(p, -clip, clip) - np.clip(y, -clip, clip)) ** 2
        else:
            each = (p - y) ** 2
        want[h] = each.mean()
    total = sum(w * want[h] / (C.TARGET_SCALE if h in MD.LOG_HEADS else 1)
                for h, w in MD.WEIGHTS.items())
    want["normalized"] = total / sum(MD.WEIGHTS.values())
    assert got.keys() == want.keys()
    for h in want:
        assert math.isclose(got[h], want[h], rel_tol=1e-6), h
