"""Split guards, windows without leakage, batches, alignment, reshapes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dataset as DS
from tidemark.operators import halo
from tidemark.operators import reshape as RS


def _dates(spark, n):
    return spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(days=i),) for i in range(n)],
                                 "localDate date")


def test_split_point_and_errors():
    assert DS.split_point(300, 30) == (240, 60)
    with pytest.raises(DS.SplitError):
        DS.split_point(299, 30)             # 59 < 60 validation rows
    with pytest.raises(DS.SplitError):
        DS.split_point(70, 30, share=0.9)   # training part shorter than a window


def test_chrono_split_overlap(spark):
    s = DS.chrono_split(DS.date_index(_dates(spark, 300)), 30)
    tr = s.filter("split = 'train'").agg(F.min("t"), F.max("t"), F.count("*")).first()
    va = s.filter("split = 'validation'").agg(F.min("t"), F.max("t"), F.count("*")).first()
    assert tuple(tr) == (0, 239, 240) and tuple(va) == (210, 299, 90)


def test_sliding_windows_never_contain_target(spark):
    d = _dates(spark, 40)
    long = d.select("localDate", F.lit("A").alias("id"), F.lit(0).alias("pos"),
                    *[F.dayofyear("localDate").cast("double").alias(f) for f in DS.FEATURES])
    w = DS.sliding_windows(long, 30).collect()
    assert len(w) == 10
    for r in w:
        dates = [x.date for x in r.window]
        assert len(dates) == 30 and dates == sorted(dates) and max(dates) < r.localDate


def test_windows_are_cut_from_blocks(spark):
    """Windows across block borders; a long symbol is many blocks; rows shuffled 1.2 times at most."""
    d = _dates(spark, 1000)
    long = d.join(spark.createDataFrame([("A", 0), ("B", 1)], "id string, pos int")).select(
        "localDate", "id", "pos", *[(F.datediff("localDate", F.lit("2020-01-01")) * (1 + F.col("pos")))
                                    .cast("double").alias(f) for f in DS.FEATURES])
    want = {(k, i): [j * (1 + i) for j in range(k - 30, k)] for k in range(30, 1000) for i in (0, 1)}
    first = dt.date(2020, 1, 1)
    for block in (30, 64, 256):
        got = DS.sliding_windows(long, 30, block=block).collect()
        assert {((r.localDate - first).days, r.pos): [x.close for x in r.window] for r in got} == want
        assert len(got) == len(want)
    parts = halo.blocked(long, DS.date_index(d), 30, ["close"], ["id"])
    sizes = [(r.block, r.n) for r in parts.select("block", F.size("rows").alias("n")).collect()]
    assert max(n for _, n in sizes) <= 286 and sum(n for _, n in sizes) <= 1.2 * 2000
    assert len(sizes) == 10          # the last dates also stand before a fifth block
    with pytest.raises(Exception, match="missing or repeated"):
        DS.sliding_windows(long.where("localDate <> '2020-02-01' OR id = 'A'"), 30).collect()


def test_batches_drop_remainder(spark):
    b = DS.assign_batches(_dates(spark, 70), 32).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in b) == [(0, 32), (1, 32)]


def test_alignment(spark):
    a, b = _dates(spark, 10), _dates(spark, 5)
    assert DS.common_dates(a, b).count() == 5
    assert DS.check_alignment(a, b) == 5
    assert tuple(DS.alignment_report(a, b).first()) == (5, 5)
    empty = a.filter(F.lit(False))
    with pytest.raises(DS.AlignmentError):
        DS.check_alignment(a, empty)
    with pytest.raises(DS.AlignmentError):            # one date twice
        DS.check_alignment(a, b.unionByName(b.limit(1)))


def test_union_strict_rejects_schema_drift(spark):
    a = spark.createDataFrame([(1,)], "x long")
    b = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        DS.union_strict(a, b)


def test_pivot_unpivot_round_trip(spark):
    long = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 1.0, 2.0), (dt.date(2024, 1, 1), "B", 3.0, 4.0)],
                                 "localDate date, id string, zscore_1d double, rank_1d double")
    wide = RS.pivot_wide(long, ["B", "A"], ["zscore_1d", "rank_1d"])
    assert wide.columns == ["localDate", "B_zscore_1d", "B_rank_1d", "A_zscore_1d", "A_rank_1d"]
    back = {(r.symbol, r.metric): r.value for r in RS.unpivot_wide(wide).collect()}
    assert back[("A", "zscore_1d")] == 1.0 and back[("B", "rank_1d")] == 4.0


def test_news_windows_and_collector_dates(spark):
    from tidemark.operators.incremental import collector_dates
    lag = _dates(spark, 8).select("localDate", F.dayofmonth("localDate").cast("double").alias("m-1"))
    w = {r.localDate: r.news_window for r in DS.news_windows(lag, DS.date_index(lag.select("localDate")), 5).collect()}
    assert len(w) == 3
    for d, win in w.items():
        assert [x.date for x in win] == [d - dt.timedelta(days=k) for k in range(5, 0, -1)]
        assert [x["values"][0] for x in win] == [float(x.date.day) for x in win]
    days = spark.range(1).select(collector_dates(F.lit("2024-01-03"), F.lit("2024-01-06"))
                                 .alias("d")).first().d
    assert days == [dt.date(2024, 1, 4), dt.date(2024, 1, 5)]
