"""Date helpers: US dates, weekdays, ISO strings and partition paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config as C


def parse_us_date(s: Column, strict: bool = True) -> Column:
    """'MM/dd/yyyy' -> DATE; unless ``strict``, null where it does not parse."""
    if not strict:
        return F.try_to_timestamp(s, F.lit(C.US_DATE_FORMAT)).cast("date")
    return F.to_date(s, C.US_DATE_FORMAT)


def format_us_date(d: Column) -> Column:
    return F.date_format(d, C.US_DATE_FORMAT)


def next_weekday(d: Column) -> Column:
    """The next Monday-Friday strictly after ``d`` (weekday(): Monday = 0)."""
    wd = F.weekday(d)
    return F.date_add(d, F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1))


def calendar_days(start: Column, end: Column) -> Column:
    """Array of calendar days in [start, end] (empty when start > end)."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))) \
            .otherwise(F.array().cast("array<date>"))


def is_weekday(d: Column) -> Column:
    return F.weekday(d) < 5


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def partition_path(prefix: str, d: Column) -> Column:
    """``{prefix}localDate=YYYY-MM-DD/data.parquet``."""
    return F.concat(F.lit(f"{prefix}localDate="), iso_date(d), F.lit("/data.parquet"))


def score_key(score: Column, prefix: str = "model/score=") -> Column:
    """``model/score={score:.4f}/model.keras``."""
    return F.concat(F.lit(prefix), F.format_string("%.4f", score), F.lit("/model.keras"))