"""As-of lookups against a plain search, and with most queries on one date."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof as AO

FIRST = dt.date(2020, 1, 1)


def day(k):
    return FIRST + dt.timedelta(days=k)


@pytest.fixture(scope="module")
def trading(spark):
    rng = random.Random(1)
    days = sorted(rng.sample(range(900), 500))
    return days, spark.createDataFrame([(day(k),) for k in days], "localDate date")


@pytest.mark.parametrize("strict", [True, False])
def test_every_day_against_a_search(spark, trading, strict):
    days, table = trading
    queries = [k for k in range(-20, 950)] + [3, 3, 400]
    df = spark.createDataFrame([(day(k),) for k in queries], "query_date date")
    got = AO.asof_index(df, AO.index_dates(table), strict=strict).collect()
    find = bisect.bisect_left if strict else bisect.bisect_right
    want = sorted((day(k), find(days, k) - 1) for k in queries)
    assert sorted((r.query_date, -1 if r.t is None else r.t) for r in got) == want


def test_latest_dates_and_short_history(spark, trading):
    days, table = trading
    df = spark.createDataFrame([(day(500),)], "query_date date")
    got = AO.latest_before(df, table, count=4).orderBy("k").collect()
    assert [r.localDate for r in got] == [day(k) for k in [k for k in days if k < 500][:-5:-1]]
    with pytest.raises(Exception, match="fewer than 3 trading dates"):
        early = spark.createDataFrame([(day(days[1]),)], "query_date date")
        AO.latest_before(early, table, count=3).collect()


def test_no_queries_and_no_dates(spark, trading):
    _, table = trading
    none = spark.createDataFrame([], "query_date date")
    assert AO.asof_index(none, AO.index_dates(table)).count() == 0
    some = spark.createDataFrame([(day(3),)], "query_date date")
    assert AO.asof_index(some, AO.index_dates(table.where("false"))).first()["t"] is None


def test_ten_million_queries_on_one_date(spark, trading):
    """No query row is brought to one task: the plan's only single partition holds days."""
    days, table = trading
    df = spark.range(10_000_000, numPartitions=8).select(
        F.lit(day(700)).alias("query_date"))
    out = AO.asof_index(df, AO.index_dates(table))
    row = out.agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    assert tuple(row) == (10_000_000,) + (bisect.bisect_left(days, 700) - 1,) * 2
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the query rows are one side of the join; the ordering is of the other side's days
    assert plan.index("Join LeftOuter") < plan.index("Range (0, 10000000") < plan.index("Window")
