"""As-of lookups and the fixed-width report lines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof as AO
from tidemark.operators import report as RP


def test_asof_strict_and_short_history(spark):
    trading = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (2, 3, 5)], "localDate date")
    q = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 9),)], "query_date date")
    got = {r.query_date: r.localDate for r in AO.latest_before(q, trading, 1).collect()}
    assert got == {dt.date(2024, 1, 5): dt.date(2024, 1, 3), dt.date(2024, 1, 9): dt.date(2024, 1, 5)}
    with pytest.raises(Exception):
        AO.latest_before(q.filter("query_date = '2024-01-05'"), trading, 3).collect()
    w = AO.trailing_window(q.withColumnRenamed("query_date", "end_date"), trading, 2).collect()
    assert sorted((r.end_date.day, r.step, r.localDate.day) for r in w) == \
        [(5, 0, 3), (5, 1, 5), (9, 0, 3), (9, 1, 5)]


def test_report_lines_match_python_format(spark):
    p = dict(zscore_1d=0.12345, rank_1d=-0.5, direction_1d=0.49, log_return_1d=0.001234,
             log_return_3d=-0.02, log_return_5d=0.0)
    a = dict(zscore_1d=-1.5, rank_1d=0.25, direction_1d=1, log_return_1d=-0.0031,
             log_return_3d=0.004, log_return_5d=0.12)
    df = spark.createDataFrame([("goog", *map(float, p.values()), *map(float, a.values()))],
                               "symbol string, " + ", ".join(f"{k}_p double" for k in p) + ", " +
                               ", ".join(f"{k}_a double" for k in a))
    row = df.select(RP.prediction_line(F.col("symbol"), {k: F.col(f"{k}_p") for k in p}).alias("l1"),
                    RP.comparison_line(F.col("symbol"), {k: F.col(f"{k}_p") for k in p},
                                       {k: F.col(f"{k}_a") for k in a}).alias("l2")).first()
    assert row.l1 == "goog   +0.123 -0.500 0.49 +0.00123 -0.02000 +0.00000"
    assert row.l2 == ("goog   +0.123 -1.500 -0.500 +0.250  0   1  +0.00123 -0.00310 "
                      "-0.02000 +0.00400 +0.00000 +0.12000")


def test_latest_two_needs_two_dates(spark):
    one = spark.createDataFrame([(dt.date(2024, 1, 1), "A")], "localDate date, symbol string")
    with pytest.raises(Exception):
        RP.latest_two_dates(one).collect()


def test_actual_row_fails_when_missing(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0)], "localDate date, A_zscore_1d double")
    assert RP.actual_row(df, dt.date(2024, 1, 2)).count() == 1
    with pytest.raises(ValueError):
        RP.actual_row(df, dt.date(2024, 1, 3))
