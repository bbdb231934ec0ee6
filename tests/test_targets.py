"""Guards of the price targets: zero fill, short history, MIN_PRICE,
sigma = 0, single symbol, ties by position, incremental == full."""

import datetime as dt
import math

import numpy as np

from pyspark.sql import functions as F

from tidemark.operators import panel as P
from tidemark.operators import targets as TG

D = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8, 9, 10)]


def _bars(spark, rows):
    return spark.createDataFrame(rows, "localDate date, id string, close double, high double, "
                                       "low double, open double, volume long")


def _symbols(spark, ids):
    return spark.createDataFrame([(s, s[0], i) for i, s in enumerate(ids)],
                                 "id string, sector string, pos int")


def test_gate_and_zero_fill(spark):
    bars = _bars(spark, [(D[0], "A", 10.0, 11.0, 9.0, 10.0, 5),
                         (D[1], "B", 20.0, 21.0, 19.0, 20.0, 6),   # A missing: no trading day
                         (D[2], "A", 11.0, 11.0, 11.0, 11.0, 7)])
    sym = _symbols(spark, ["A", "B"])
    dates = P.trading_dates(bars, sym)
    assert sorted(r.localDate for r in dates.collect()) == [D[0], D[2]]
    panel = P.dense_panel(bars, sym, dates)
    rows = {(r.localDate, r.id): r for r in panel.collect()}
    assert len(rows) == 4
    assert rows[(D[0], "B")].close == 0.0 and rows[(D[0], "B")].volume == 0
    any_dates = P.trading_dates(bars, sym, "any")
    assert any_dates.count() == 3


def test_log_returns_guards(spark):
    closes = [10.0, 11.0, 0.0005, 12.0, 13.0, 14.0, 15.0]
    bars = _bars(spark, [(d, "A", c, c, c, c, 1) for d, c in zip(D, closes)])
    sym = _symbols(spark, ["A"])
    panel = P.dense_panel(bars, sym, P.trading_dates(bars, sym))
    r = {x.localDate: x for x in TG.log_returns(panel).collect()}
    f = lambda a, b: float(np.float32(math.log(float(np.float32(a)) / float(np.float32(b)))))
    assert r[D[0]].log_return_1d == 0.0                       # no earlier row
    assert math.isclose(r[D[1]].log_return_1d, f(11.0, 10.0))
    assert r[D[2]].log_return_1d == 0.0 and r[D[3]].log_return_1d == 0.0  # below MIN_PRICE
    assert r[D[2]].log_return_3d == 0.0                       # only 2 earlier rows
    assert math.isclose(r[D[3]].log_return_3d, f(12.0, 10.0))
    assert r[D[4]].log_return_5d == 0.0 and math.isclose(r[D[5]].log_return_5d, f(14.0, 10.0))


def test_cross_section_zero_sigma_single_symbol_and_ties(spark):
    bars = _bars(spark, [(d, s, 10.0, 10.0, 10.0, 10.0, 1) for d in D[:3] for s in "ABC"])
    sym = _symbols(spark, ["A", "B", "C"])
    panel = P.dense_panel(bars, sym, P.trading_dates(bars, sym))
    t = {(r.localDate, r.id): r for r in TG.daily_targets(panel).collect()}
    assert all(r.zscore_1d == 0.0 and r.direction_1d == 0 for r in t.values())
    # all returns tie at 0: rank follows list position
    assert [t[(D[1], s)].rank_1d for s in "ABC"] == [0.0, 0.5, 1.0]
    one = P.dense_panel(bars.filter("id = 'A'"), _symbols(spark, ["A"]),
                        P.trading_dates(bars, _symbols(spark, ["A"])))
    assert {r.rank_1d for r in TG.daily_targets(one).collect()} == {0.0}


def test_zscore_sums_to_zero(spark, sf_dir):
    from tidemark.plans.q_stock import target_table
    t = target_table(spark, sf_dir)
    sums = t.groupBy("localDate").agg(F.sum("zscore_1d").alias("s")).collect()
    assert all(abs(r.s) < 1e-9 for r in sums)
    n = t.groupBy("localDate").agg(F.count("*").alias("n"), F.max("rank_1d").alias("m")).collect()
    assert all(r.m == 1.0 for r in n if r.n > 1)


def test_incremental_equals_full(spark, sf_dir):
    from tidemark.plans.q_stock import panel_inputs
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    panel = P.dense_panel(b, s, d)
    full = TG.daily_targets(panel).filter(F.col("localDate") > F.lit("1996-03-01").cast("date"))
    inc = TG.incremental_targets(panel, "1996-03-01")
    key = lambda r: (r.localDate, r.id)
    a = sorted(full.collect(), key=key)
    b2 = sorted(inc.collect(), key=key)
    assert len(a) == len(b2) > 0
    for x, y in zip(a, b2):
        for c in TG.TARGET_COLS:
            assert math.isclose(x[c], y[c], abs_tol=1e-12), (x, y, c)


def test_returns_are_narrowed_before_ranking(spark):
    """Returns that differ only beyond float32 tie, and the list position decides."""
    rows = [(D[0], s, 1000.0) for s in "ABC"]
    rows += [(D[1], s, c) for s, c in zip("ABC", (1200.0, 1200.0, 900.0))]
    panel = spark.createDataFrame([(d, s, "ABC".index(s), c, c, c, c, 1) for d, s, c in rows],
                                  "localDate date, id string, pos int, close double, high double, "
                                  "low double, open double, volume long")
    r = TG.log_returns(panel, horizons=(1,))
    tiny = F.when(F.col("id") == "A", F.lit(1e-12)).otherwise(0.0)
    near = r.withColumn("log_return_1d", (F.col("log_return_1d") + tiny).cast("float").cast("double"))
    t = {x.id: x for x in TG.add_cross_section(near).filter(F.col("localDate") == D[1]).collect()}
    assert [t[s].rank_1d for s in "ABC"] == [0.5, 1.0, 0.0]
    stored = np.float32(math.log(1.2))
    assert t["B"].log_return_1d == float(stored) != math.log(1.2)
    x = np.array([t[s].log_return_1d for s in "ABC"])
    assert np.allclose([t[s].zscore_1d for s in "ABC"], (x - x.mean()) / x.std())
