"""Daily roll-up guards, thresholds, calendar spine and lag naming."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators import rollup as RU

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5)


def _sent(spark, rows):
    return spark.createDataFrame(
        [(d, str(i), float(s), int(L), 3) for i, (d, s, L) in enumerate(rows)],
        "localDate date, id string, sentiment_score float, text_length int, token_count int")


def test_small_groups_and_constant_scores(spark):
    rows = [(D1, 0.5, 10), (D1, -0.2, 30),                 # n = 2: skew and kurtosis 0
            (D2, 0.3, 5), (D2, 0.3, 5), (D2, 0.3, 5), (D2, 0.3, 5)]   # sigma = 0
    out = {r.localDate: r for r in RU.daily_rollup(_sent(spark, rows)).collect()}
    a, b = out[D1], out[D2]
    assert a.count_articles == 2 and a.sentiment_skewness == 0.0 and a.sentiment_kurtosis == 0.0
    assert b.sentiment_skewness == 0.0 and b.sentiment_kurtosis == 0.0
    s = np.float32([0.5, -0.2]).astype(float)
    assert np.isclose(a.median_sentiment, s.mean())
    assert np.isclose(a.weighted_mean_sentiment, (s[0] * 10 + s[1] * 30) / (40 + 1e-9))
    assert a.pct_positive == 0.5 and a.pct_negative == 0.5 and a.polarity_ratio == 0.0
    assert np.isclose(a.ratio_pos_neg, 0.5 / (0.5 + 1e-9))
    assert a.article_length_variance == 100.0


def test_thresholds_compare_as_float32(spark):
    # 0.05 and 0.15 are inclusive for conflict; 0.1 is exclusive for neutral;
    # 0.5 exclusive for extreme
    rows = [(D1, 0.05, 1), (D1, -0.15, 1), (D1, 0.1, 1), (D1, 0.5, 1), (D1, 0.5000001, 1)]
    r = RU.daily_rollup(_sent(spark, rows)).first()
    assert np.isclose(r.conflict_share, 3 / 5)    # 0.05, -0.15, 0.1
    assert np.isclose(r.neutral_share, 1 / 5)     # 0.05 only
    assert np.isclose(r.extreme_sentiment_share, 1 / 5)


def test_moments_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.uniform(-1, 1, 50).astype(np.float32)
    r = RU.daily_rollup(_sent(spark, [(D1, float(v), 1) for v in vals])).first()
    x = vals.astype(float)
    z = (x - x.mean()) / x.std()
    assert np.isclose(r.sentiment_skewness, np.mean(z ** 3))
    assert np.isclose(r.sentiment_kurtosis, np.mean(z ** 4) - 3)
    assert np.isclose(r.median_sentiment, np.median(x))


def test_spine_and_lags(spark):
    daily = RU.daily_rollup(_sent(spark, [(D1, 0.5, 10), (D3, -0.5, 20)]))
    spine = RU.spine_zero_fill(daily).collect()
    assert [r.localDate for r in spine] == [D1 + dt.timedelta(days=i) for i in range(5)]
    assert all(r.count_articles == 0 for r in spine if r.localDate not in (D1, D3))
    lag = RU.lagged_features(daily)
    assert lag.columns == ["localDate"] + RU.lagged_columns()
    assert lag.columns[1:17] == [f"{m}-1" for m in C.AGGREGATED_METRICS]
    rows = {r.localDate: r.asDict() for r in lag.collect()}
    assert min(rows) == D1 and max(rows) == D3 + dt.timedelta(days=1)
    assert rows[D1]["count_articles-1"] == 0.0                 # nothing before the start
    assert rows[D1 + dt.timedelta(days=1)]["count_articles-1"] == 1.0
    assert rows[D3]["count_articles-4"] == 1.0 and rows[D3]["count_articles-1"] == 0.0
    assert np.isclose(rows[D3 + dt.timedelta(days=1)]["mean_sentiment-1"], -0.5)


def test_lagged_incremental_equals_full(spark, sf_dir):
    from tidemark.plans.q_news import daily
    d = daily(spark, sf_dir)
    full = RU.lagged_features(d).filter(F.col("localDate") >= F.lit("2024-01-12").cast("date"))
    inc = RU.lagged_features(d, start="2024-01-12")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, inc.collect()))
