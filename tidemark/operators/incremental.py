"""Incremental processing: pending date ranges and bounded back-fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _date(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("date")


def pending_dates(dates: DataFrame, last_processed, last_added) -> DataFrame:
    """Dates with ``last_processed < d <= last_added``. On a table partitioned
    by localDate the range prunes partitions."""
    d = F.col("localDate")
    return dates.filter((d > _date(last_processed)) & (d <= _date(last_added)))


def collector_dates(last_added, today) -> Column:
    """Calendar days a collector still has to fetch: ``last_added < d < today``."""
    lo, hi = F.date_add(_date(last_added), 1), F.date_sub(_date(today), 1)
    return F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 day")))\
            .otherwise(F.array().cast("array<date>"))


def bounded_backfill(dates: DataFrame, max_days: int, max_date=None) -> DataFrame:
    """Cap one run at the first ``max_days`` pending dates and, optionally,
    below ``max_date`` (exclusive). The input is one row per date (bounded by
    the calendar), so one ordered window is fine."""
    d = dates
    if max_date is not None:
        d = d.filter(F.col("localDate") < _date(max_date))
    r = F.dense_rank().over(Window.orderBy("localDate"))
    return d.withColumn("_r", r).filter(F.col("_r") <= max_days).drop("_r")


def missing_dates(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Dates in ``wanted`` with no stored output (read-through cache)."""
    return wanted.join(stored.select("localDate").distinct(), "localDate", "left_anti")
