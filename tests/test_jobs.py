"""End-to-end lifecycle on one storage root: two landings, incremental
jobs, and the stored results equal a one-shot computation."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as SC
from tidemark.operators import panel as P
from tidemark.operators import rollup as RU
from tidemark.operators import sentiment as SN
from tidemark.operators import targets as TG
from tidemark.plans import jobs as J
from tidemark.session import scratch_path
from tidemark.sources import fixtures as FX
from tidemark.sources import parquet as PQ
from tidemark.sources.symbols import replace_symbols


@pytest.fixture(scope="module")
def lifecycle(spark, sf_dir):
    root = scratch_path(spark, "root")
    bars = FX.bars_orders(spark, sf_dir).select(*SC.RAW_STOCK.fieldNames())
    symbols = FX.symbols_from_bars(bars)
    replace_symbols(symbols, f"{root}/symbols")
    arts = FX.articles(spark, sf_dir).select(*SC.RAW_NEWS.fieldNames())
    cut_s, cut_n = dt.date(1999, 12, 31), dt.date(2024, 1, 15)
    PQ.write_partitions(bars.filter(F.col("localDate") <= cut_s), f"{root}/raw/stock", SC.RAW_STOCK)
    PQ.write_partitions(arts.filter(F.col("localDate") <= cut_n), f"{root}/raw/news", SC.RAW_NEWS)
    assert J.price_features_job(spark, root, gate="any") == "processed"
    assert J.news_features_job(spark, root) == "processed"
    PQ.write_partitions(bars.filter(F.col("localDate") > cut_s), f"{root}/raw/stock", SC.RAW_STOCK)
    PQ.write_partitions(arts.filter(F.col("localDate") > cut_n), f"{root}/raw/news", SC.RAW_NEWS)
    assert J.price_features_job(spark, root, gate="any") == "processed"
    assert J.price_features_job(spark, root, gate="any") == "nothing new"
    assert J.news_features_job(spark, root) == "processed"
    return root, bars, symbols, arts


def test_incremental_targets_equal_full(spark, lifecycle):
    root, bars, symbols, _ = lifecycle
    stored = spark.read.parquet(f"{root}/stock/target")
    bars = bars.filter(F.col("localDate") >= F.lit(J.START))      # history starts at START_DATE
    dates = P.trading_dates(bars, symbols, "any")
    full = TG.daily_targets(P.dense_panel(bars, symbols, dates))
    a = {(r.localDate, r.id): r for r in stored.collect()}
    b = {(r.localDate, r.id): r for r in full.collect()}
    assert a.keys() == b.keys()
    for k, r in b.items():
        for c in TG.TARGET_COLS[:5]:
            assert math.isclose(a[k][c], r[c], rel_tol=1e-6, abs_tol=1e-6), (k, c)
        assert a[k].direction_1d == r.direction_1d


def test_incremental_lags_equal_full(spark, lifecycle):
    root, _, _, arts = lifecycle
    stored = J._latest(spark, f"{root}/news/lagged")
    daily = RU.daily_rollup(SN.score_articles(arts))
    daily = daily.select("localDate", *[F.col(m).cast("float").cast("double").alias(m)
                                        for m in daily.columns[1:]])
    hi = arts.agg(F.max("localDate")).first()[0] + dt.timedelta(days=1)
    full = RU.lagged_features(daily, start=J.START, end=hi)
    a = {r.localDate: r for r in stored.collect()}
    b = {r.localDate: r for r in full.collect()}
    assert a.keys() == b.keys() and min(a) == J.START and max(a) == hi
    for d in b:
        for c in full.columns[1:]:
            assert math.isclose(a[d][c], b[d][c], rel_tol=1e-6, abs_tol=1e-6), (d, c)


def test_train_infer_notify(spark, lifecycle):
    root, *_ = lifecycle
    score = J.train_job(spark, root, window=10)
    assert float(score) >= 0
    meta = spark.read.text(f"{root}/model/score={score}/meta.json", wholetext=True).first()[0]
    assert f'"score":"{score}"' in meta
    assert J.infer_job(spark, root, first_date="2001-07-02", window=10) == "predicted"
    preds = spark.read.parquet(f"{root}/inference")
    assert preds.select("localDate").distinct().count() >= 2
    assert J.infer_job(spark, root, window=10) == "nothing pending"
    body = J.notify_job(spark, root, "P1,P3").first().body
    assert " prediction\nWatched symbols\nP1 " in body and "predicted vs actual" in body


def test_seed_reads_only_the_newest_partitions(spark, lifecycle):
    root, *_ = lifecycle
    path = f"{root}/stock/panel"
    days = PQ.newest_dates(spark, path, 5, "1999-12-31")
    every = [n.partition("=")[2] for n in PQ.list_partitions(spark, path, "localDate")]
    assert len(days) == 5 and days == [d for d in every if d <= "1999-12-31"][-5:]
    seed = J.seed_panel(spark, path, days)
    plan = seed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [localDate" in plan
    assert {str(r.localDate) for r in seed.select("localDate").distinct().collect()} == set(days)


def test_compaction_is_its_own_job(spark, lifecycle):
    root, *_ = lifecycle
    before = {r.localDate: tuple(r) for r in J._latest(spark, f"{root}/news/lagged").collect()}
    assert J.compact_job(spark, root) == "compacted"
    assert len(PQ.list_runs(spark, f"{root}/news/lagged")) == 1
    after = {r.localDate: tuple(r) for r in J._latest(spark, f"{root}/news/lagged").collect()}
    assert before == after and J.compact_job(spark, root) == "one run"


def test_missing_news_stops_inference(spark):
    """A pending day whose news window is short raises; nothing is skipped."""
    import numpy as np

    from tidemark.operators import heads as H
    from tidemark.operators import models as MD
    heads = H.Heads(np.ones((6, 3, 5)), np.ones((6, 3, 1)), np.zeros(6))
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    panel = spark.createDataFrame([(d, "A", 0, 1.0, 1.0, 1.0, 1.0, 1) for d in days],
                                  "localDate date, id string, pos int, close double, high double, "
                                  "low double, open double, volume long")
    lagged = spark.createDataFrame([(d, 1.0) for d in days[:6]], "localDate date, `m-1` double")
    pending = spark.createDataFrame([(d,) for d in days[6:9]], "query_date date")
    with pytest.raises(Exception, match="news window"):
        MD.predict_for_dates(heads, pending, panel, lagged, panel.select("localDate"), 3).collect()
    holes = panel.where("localDate <> '2024-01-05'")
    with pytest.raises(Exception, match="missing or repeated among the rows of A"):
        MD.predict_for_dates(heads, pending.limit(1), holes, lagged, panel.select("localDate"),
                             3).collect()
    early = spark.createDataFrame([(days[2],)], "query_date date")
    with pytest.raises(Exception, match="fewer than 3 trading dates"):
        MD.predict_for_dates(heads, early, panel, lagged, panel.select("localDate"), 3).collect()
