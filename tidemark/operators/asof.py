"""As-of lookups over the trading calendar without theta joins.

Trading dates get a dense index t. The index of the latest trading date strictly before
(or at/before) a day is a step function, kept as a table of one row a calendar day; query
rows are equi-joined with it. Windows of k dates are then index ranges, exploded and
equi-joined. Only tables of one row a day are ordered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class InsufficientHistory(ValueError):
    pass


def index_dates(trading: DataFrame) -> DataFrame:
    """(localDate, t): 0-based position of each trading date."""
    d = trading.select("localDate").distinct()
    return d.withColumn("t", (F.row_number().over(Window.orderBy("localDate")) - 1).cast("long"))


def step_calendar(indexed: DataFrame, last, strict: bool) -> DataFrame:
    """(day, t): for each calendar day from the first trading date to ``last``, the position of
    the latest trading date before it (``strict``) or at it. One row a day."""
    lo = indexed.select(F.min("localDate")).scalar()
    days = indexed.sparkSession.range(1).select(F.explode(F.when(
        last >= lo, F.sequence(lo, last, F.expr("interval 1 day")))).alias("day"))
    seen = indexed.select((F.date_add("localDate", 1) if strict else F.col("localDate")).alias("day"),
                          F.col("t").alias("_t"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)   # of days, not queries
    return days.join(seen, "day", "left").select(
        "day", F.last("_t", ignorenulls=True).over(upto).alias("t"))


def asof_index(queries: DataFrame, indexed: DataFrame, strict: bool = True,
               qcol: str = "query_date") -> DataFrame:
    """For each query row: ``t`` of the latest trading date before its date
    (``strict``) or at/before it. NULL when there is none.

    The answer is a step function of the day. It is written out for every calendar day, and the
    queries, however many and on however few dates, are joined with it by date: they are
    neither sorted nor brought together."""
    last = queries.select(F.max(qcol)).scalar()
    steps = step_calendar(indexed, last, strict)
    return queries.select(qcol).join(steps, F.col(qcol) == F.col("day"), "left").select(qcol, "t")


def latest_before(queries: DataFrame, trading: DataFrame, count: int = 1,
                  qcol: str = "query_date", fail: bool = True) -> DataFrame:
    """The ``count`` latest trading dates strictly before each query date,
    as (query_date, k, localDate) with k = 0 for the newest. Fails when a
    query date has fewer than ``count`` earlier trading dates."""
    idx = index_dates(trading)
    a = asof_index(queries, idx, strict=True, qcol=qcol)
    if fail:
        a = a.withColumn("t", F.when(F.col("t") >= count - 1, F.col("t")).otherwise(
            F.raise_error(F.concat(F.lit("fewer than "), F.lit(str(count)),
                                   F.lit(" trading dates before "), F.col(qcol).cast("string")))))
    e = a.select(qcol, F.posexplode(F.sequence(F.col("t"), F.col("t") - count + 1, F.lit(-1)))
                 .alias("k", "t")).filter(F.col("t") >= 0)
    return e.join(idx, "t").select(qcol, F.col("k").cast("int").alias("k"), "localDate")


def trailing_window(ends: DataFrame, trading: DataFrame, window: int,
                    ecol: str = "end_date") -> DataFrame:
    """The latest ``window`` trading dates at or before each end date, oldest
    first: (end_date, step, localDate). Fails when short."""
    idx = index_dates(trading)
    a = asof_index(ends, idx, strict=False, qcol=ecol)
    a = a.withColumn("t", F.when(F.col("t") >= window - 1, F.col("t")).otherwise(
        F.raise_error(F.concat(F.lit(f"fewer than {window} trading dates up to "),
                               F.col(ecol).cast("string")))))
    e = a.select(ecol, F.posexplode(F.sequence(F.col("t") - window + 1, F.col("t")))
                 .alias("step", "t"))
    return e.join(idx, "t").select(ecol, F.col("step").cast("int").alias("step"),
                                                "localDate")
