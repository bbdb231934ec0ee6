"""Trading calendar and the dense (date x symbol) bar panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BAR_FIELDS = ("close", "high", "low", "open", "volume")


def first_symbol(symbols: DataFrame) -> DataFrame:
    """The first listed symbol (lowest ``pos``), one row."""
    return symbols.agg(F.min_by("id", "pos").alias("id"))


def trading_dates(bars: DataFrame, symbols: DataFrame, gate: str = "first_symbol") -> DataFrame:
    """Dates that exist as trading days.

    ``first_symbol`` (the reference's rule): a date exists only when the first
    listed symbol has a bar that day. ``any``: any symbol has a bar.
    """
    if gate == "first_symbol":
        gated = bars.join(first_symbol(symbols), "id", "left_semi")
    elif gate == "any":
        gated = bars
    else:
        raise ValueError(f"unknown gate {gate!r}")
    return gated.select("localDate").distinct()


def dense_panel(bars: DataFrame, symbols: DataFrame, dates: DataFrame) -> DataFrame:
    """Every (trading date, symbol); absent bars are zero in all five fields.

    The date list is one row per calendar day at most, so it is gathered by a
    scalar subquery and exploded per symbol: the grid is generated, not
    joined, and the only join is the keyed left join with the bars.
    """
    date_list = dates.select(F.sort_array(F.collect_list("localDate"))).scalar()
    grid = symbols.select("id", "pos", F.explode(date_list).alias("localDate"))
    joined = grid.join(bars.select("localDate", "id", *BAR_FIELDS), ["localDate", "id"], "left")
    return joined.select(
        "localDate", "id", "pos",
        *[F.coalesce(F.col(c), F.lit(0.0)).cast("double").alias(c) for c in BAR_FIELDS[:4]],
        F.coalesce(F.col("volume"), F.lit(0)).cast("long").alias("volume"))


def calendar_spine(min_date, max_date) -> F.Column:
    """All calendar days between two date expressions, inclusive."""
    return F.explode(F.sequence(min_date, max_date, F.expr("interval 1 day")))


def symbols_after(symbols: DataFrame, cursor: str | None) -> DataFrame:
    """Members after ``cursor`` in list order; all of them when the cursor is
    blank or not a member."""
    if cursor is None or not cursor.strip():
        return symbols
    cur = symbols.filter(F.col("id") == cursor).select(F.col("pos").alias("_cpos"))
    cpos = cur.select(F.coalesce(F.max("_cpos"), F.lit(-1))).scalar()
    return symbols.filter(F.col("pos") > cpos)


def last_symbol(symbols: DataFrame) -> DataFrame:
    return symbols.agg(F.max_by("id", "pos").alias("id"))


def watched_symbols(symbols: DataFrame, watch_list: str) -> DataFrame:
    """Restrict to a comma-separated, trimmed list; ``wpos`` keeps list order."""
    spark = symbols.sparkSession
    wl = (spark.range(1)
          .select(F.posexplode(F.split(F.lit(watch_list), ",")).alias("wpos", "raw"))
          .select("wpos", F.trim("raw").alias("id"))
          .filter(F.col("id") != ""))
    first = wl.groupBy("id").agg(F.min("wpos").alias("wpos"))
    return symbols.join(first, "id")