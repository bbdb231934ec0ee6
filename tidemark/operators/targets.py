"""Price targets: log returns over trading rows, cross-sectional z-score,
rank and direction (long form: one row per date and symbol)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators.rank import row_number_within


def close_f64(col: str = "close") -> F.Column:
    """Closes are stored as float32 features; returns are taken from those
    float32 values widened to float64."""
    return F.col(col).cast("float").cast("double")


def safe_log_ratio(cur: F.Column, prev: F.Column) -> F.Column:
    """ln(cur/prev) when both exceed MIN_PRICE, else 0 (also when prev is
    missing)."""
    ok = prev.isNotNull() & (prev > C.MIN_PRICE) & (cur > C.MIN_PRICE)
    return F.when(ok, F.log(cur / prev)).otherwise(F.lit(0.0))


def log_returns(panel: DataFrame, horizons=C.LOG_RETURN_HORIZONS) -> DataFrame:
    """Adds ``log_return_{h}d`` for each horizon over each symbol's trading
    rows, narrowed to float32 as they are stored: statistics and ranks see the
    stored values. One window partition per symbol: at most one row per trading day."""
    w = Window.partitionBy("id").orderBy("localDate")
    c = close_f64()
    out = panel.withColumn("_c", c)
    return out.select("*", *[safe_log_ratio(F.col("_c"), F.lag("_c", h).over(w))
                             .cast("float").cast("double").alias(f"log_return_{h}d") for h in horizons]).drop("_c")


def cross_section_stats(returns: DataFrame, col: str = "log_return_1d") -> DataFrame:
    """Per date: mean and population std of the 1-day return, and the count.
    A grouped aggregate (partial per task), never a window over a date."""
    return returns.groupBy("localDate").agg(
        F.avg(col).alias("mean_1d"), F.stddev_pop(col).alias("std_1d"),
        F.count(F.lit(1)).alias("n_symbols"))


def add_cross_section(returns: DataFrame) -> DataFrame:
    """z-score, rank in [0,1] (ties broken by list position) and direction.

    The statistics are a grouped aggregate (one row a day) joined back, and the
    rank is range-partitioned, so a date may hold any number of symbols."""
    r1 = F.col("log_return_1d")
    j = returns.join(cross_section_stats(returns), "localDate")
    j = j.withColumn("zscore_1d", F.when(F.col("std_1d") > 0,
                                         (r1 - F.col("mean_1d")) / F.col("std_1d"))
                     .otherwise(F.lit(0.0)))
    ranked = row_number_within(j, ["log_return_1d", "pos"], ["localDate"], out="_rn")
    return (ranked.withColumn("rank_1d", F.col("_rn").cast("double") /
                              F.greatest(F.col("n_symbols") - 1, F.lit(1)).cast("double"))
                  .withColumn("direction_1d", (r1 > 0).cast("int"))
                  .drop("_rn", "mean_1d", "std_1d", "n_symbols"))


TARGET_COLS = ("log_return_1d", "log_return_3d", "log_return_5d",
               "zscore_1d", "rank_1d", "direction_1d")


def daily_targets(panel: DataFrame) -> DataFrame:
    """The daily target table in long form (localDate, id, pos, six targets)."""
    t = add_cross_section(log_returns(panel))
    return t.select("localDate", "id", "pos", *TARGET_COLS)


def seed_history(panel_before: DataFrame, depth: int = C.MAX_LOG_RETURN_HORIZON) -> DataFrame:
    """Last ``depth`` trading rows per symbol at or before the cut: the seed an
    incremental run needs so lags cross the run border."""
    w = Window.partitionBy("id").orderBy(F.col("localDate").desc())
    return (panel_before.withColumn("_r", F.row_number().over(w))
                        .filter(F.col("_r") <= depth).drop("_r"))


def incremental_targets(panel: DataFrame, last_processed) -> DataFrame:
    """Targets for dates after ``last_processed`` computed only from the new
    slice plus the seeded history; equals the full computation."""
    cut = F.lit(last_processed).cast("date")
    old = panel.filter(F.col("localDate") <= cut)
    new = panel.filter(F.col("localDate") > cut)
    seeded = seed_history(old).unionByName(new)
    r = log_returns(seeded).filter(F.col("localDate") > cut)
    return add_cross_section(r).select("localDate", "id", "pos", *TARGET_COLS)
