"""Streaming runs: catch-up ingest is exactly-once across reruns; the
partition upsert converges to the batch roll-up."""

import datetime as dt
import json
import math
import random

import numpy as np

from tidemark import config as C
from tidemark.operators import states as ST
from tidemark.operators.rollup import daily_rollup
from tidemark.schemas import SENTIMENT
from tidemark.session import scratch_path
from tidemark.sources import fixtures as FX
from tidemark.streaming import jobs as SJ


def test_ingest_reruns_are_exactly_once(spark, sf_dir):
    landing, out, ck = (scratch_path(spark, n) for n in ("landing", "out", "ck"))
    p = FX.price_payloads(spark, sf_dir)
    p.write.json(landing)
    SJ.stream_ingest_prices(spark, landing, out, ck)
    n1 = spark.read.parquet(out).count()
    SJ.stream_ingest_prices(spark, landing, out, ck)
    assert spark.read.parquet(out).count() == n1 > 0


def test_upsert_converges_to_batch(spark, sf_dir):
    landing, store, out, ck = (scratch_path(spark, n) for n in ("s", "store", "agg", "ck"))
    s = FX.sentiment_fixed(spark, sf_dir).select(*SENTIMENT.fieldNames())
    s.repartitionByRange(4, "localDate").write.parquet(landing)
    SJ.stream_upsert_rollup(spark, landing, store, out, ck)
    got = spark.read.parquet(out).select("localDate", "count_articles", "median_sentiment")
    want = daily_rollup(s).select("localDate", "count_articles", "median_sentiment")
    r = lambda df: sorted((x.localDate, x.count_articles, round(x.median_sentiment, 9))
                          for x in df.collect())
    assert r(got) == r(want)


def test_days_count_in_any_order(spark):
    import datetime as dt
    landing, out, ck = (scratch_path(spark, n) for n in ("s", "agg", "ck"))

    def land(days, tag):
        rows = [(d, f"{tag}{d}", 0.5, 10, 5) for d in days]
        spark.createDataFrame(rows, SENTIMENT).coalesce(1).write.mode("append").parquet(landing)
        SJ.stream_daily_subset(spark, landing, out, ck)

    june, old = dt.date(2024, 6, 1), [dt.date(2024, 1, 10), dt.date(2024, 1, 11)]
    land([june], "a")
    land(old, "b")                     # months behind the newest day
    land([old[0], june], "c")
    got = {r.localDate: r.count_articles for r in spark.read.parquet(out).collect()}
    assert got == {june: 2, old[0]: 2, old[1]: 1}


def _land(spark, landing, rows):
    spark.createDataFrame(rows, SENTIMENT).coalesce(1).write.mode("append").parquet(landing)


def _random_rows(seed, days, n):
    rng = random.Random(seed)
    first = dt.date(2024, 1, 1)
    return [(first + dt.timedelta(days=rng.randrange(days)), f"{seed}-{k}",
             float(np.float32(rng.choice([-1.0, 0.0, 0.25, rng.uniform(-1, 1)]))), rng.randrange(500), 3)
            for k in range(n)]


def test_late_days_fold_into_stored_rows(spark):
    """Days far behind the watermark, several times over: metrics equal those of all rows, the
    state holds recent days only, and each store one row a day."""
    landing, out, ck = (scratch_path(spark, n) for n in ("s", "agg", "ck"))
    every = []
    for k, days in enumerate((60, 60, 3, 60, 90)):
        rows = _random_rows(k, days, 80)
        every += rows
        _land(spark, landing, rows)
        SJ.stream_daily_subset(spark, landing, out, ck, delay_days=5)
    want = {r.localDate: r for r in daily_rollup(spark.createDataFrame(every, SENTIMENT)).collect()}
    got = {r.localDate: r for r in spark.read.parquet(out).collect()}
    assert got.keys() == want.keys()
    for d in want:
        for m in SJ.STREAMABLE:
            assert math.isclose(got[d][m], want[d][m], rel_tol=1e-9, abs_tol=1e-9), (d, m)
    for table in ("days", "folded"):
        held = [r.localDate for r in spark.read.parquet(f"{out}-state/{table}").collect()]
        assert len(held) == len(set(held)) > 0
    state = spark.read.format("statestore").load(f"{ck}/days")
    assert 0 < state.count() <= 12 < len(want)


def test_an_empty_first_file(spark):
    """Streams that start with a file without rows go on when rows come."""
    for run, stores in ((SJ.stream_daily_subset, 0), (SJ.stream_upsert_rollup, 1)):
        landing, out, ck, *rest = (scratch_path(spark, n) for n in ("s", "agg", "ck", "store")[:3 + stores])
        _land(spark, landing, [])
        run(spark, landing, *rest, out, ck)
        _land(spark, landing, _random_rows(1, 3, 20))
        run(spark, landing, *rest, out, ck)
        assert spark.read.parquet(out).agg({"count_articles": "sum"}).first()[0] == 20


def test_states_merge_to_the_whole(spark):
    """Moments merged pairwise in any cut, and medians from counts, equal the roll-up."""
    rows = _random_rows(7, 6, 300) + [(dt.date(2025, 1, 1), str(k), 0.1, 5, 1) for k in range(9)]
    whole = {r.localDate: r for r in daily_rollup(spark.createDataFrame(rows, SENTIMENT)).collect()}
    states, counts = scratch_path(spark, "states"), scratch_path(spark, "counts")
    cuts = [0, 1, 2, 50, 51, 200, len(rows)]
    for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = spark.createDataFrame(rows[a:b], SENTIMENT)
        for _ in range(2):                    # a replay changes nothing
            days = ST.fold_states(ST.daily_states(part), states, batch)
            ST.fold_counts(ST.score_counts(part), counts, batch, days)
        assert days == sorted({r[0] for r in rows[a:b]})
    every = ST.stored_metrics(spark, states, counts)
    some = ST.stored_metrics(spark, states, counts, days)
    assert some.count() == len(days) and "PartitionFilters: [localDate" in \
        some._jdf.queryExecution().executedPlan().toString()
    got = {r.localDate: r for r in every.collect()}
    assert got.keys() == whole.keys()
    for d, r in whole.items():
        for m in C.AGGREGATED_METRICS:
            assert math.isclose(got[d][m], r[m], rel_tol=1e-8, abs_tol=1e-8), (d, m)


def test_stream_quarantines_and_goes_on(spark):
    landing, out, ck = (scratch_path(spark, n) for n in ("landing", "out", "ck"))

    def payload(close, date="11/21/2025"):
        return json.dumps({"status": {"rCode": 200}, "data": {"totalRecords": 1, "tradesTable": {
            "rows": [{"date": date, "close": close, "high": "1", "low": "1", "open": "1",
                      "volume": "1"}]}}})

    def land(rows):
        spark.createDataFrame(rows, SJ.LANDED_PRICE).coalesce(1).write.mode("append").json(landing)
        SJ.stream_ingest_prices(spark, landing, out, ck)

    land([("A", payload("$5")), ("B", payload("abc")), ("C", "<html>"), ("D", payload("1", "?"))])
    land([("A", payload("$7")), ("E", payload("1")[:-9])])
    assert [(r.id, r.close) for r in SJ.stored_bars(spark, out).collect()] == [("A", 7.0)]
    bad = {r.id: (r.reason, r.payload) for r in spark.read.parquet(f"{out}-quarantine").collect()}
    assert {k: v[0] for k, v in bad.items()} == {"B": "bad_value", "C": "undecodable",
                                                 "D": "bad_value", "E": "undecodable"}
    assert bad["C"][1] == "<html>"


def test_daily_subset_is_time_zone_independent(spark, sf_dir):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        landing, out, ck = (scratch_path(spark, n) for n in ("s", "agg", "ck"))
        s = FX.sentiment_fixed(spark, sf_dir).select(*SENTIMENT.fieldNames())
        s.write.parquet(landing)
        SJ.stream_daily_subset(spark, landing, out, ck)
        got = {r.localDate: r.count_articles for r in spark.read.parquet(out).collect()}
        want = {r.localDate: r["count"] for r in s.groupBy("localDate").count().collect()}
        assert got == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
