"""Prediction reports: latest prediction dates, top gainers, predicted vs
actual, directional accuracy, hit rate and the fixed-width report body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators.rank import row_number_within

HEADS = C.INFERENCE_METRICS


def latest_two_dates(preds: DataFrame) -> DataFrame:
    """Newest (rank 1) and previous (rank 2) prediction dates; one row per
    day, so the ordering is bounded. Fails with fewer than two."""
    d = preds.select("localDate").distinct()
    r = d.withColumn("date_rank", F.dense_rank().over(Window.orderBy(F.col("localDate").desc())))
    top = r.filter(F.col("date_rank") <= 2)
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return top.withColumn("date_rank", F.when(n >= 2, F.col("date_rank")).otherwise(
        F.raise_error(F.lit("fewer than two prediction dates"))))


def top_gainers(preds: DataFrame, k: int = C.TOP_GAINERS_COUNT, value: str = "log_return_1d") -> DataFrame:
    """The k largest predictions of one day (ties by symbol): a distributed
    take-ordered (partial top-k per task, then one merge of k rows each)."""
    return preds.orderBy(F.col(value).desc(), F.col("symbol")).limit(k)


def top_gainers_per_date(preds: DataFrame, k: int = C.TOP_GAINERS_COUNT,
                         value: str = "log_return_1d") -> DataFrame:
    """Top k per date, exact: the range-partitioned rank keeps a large date
    off a single task."""
    r = row_number_within(preds, [F.col(value).desc(), F.col("symbol")], ["localDate"], out="_r")
    return r.filter(F.col("_r") < k).withColumn("rank", F.col("_r") + 1).drop("_r")


def predicted_vs_actual(preds: DataFrame, actual: DataFrame) -> DataFrame:
    """Inner join on (date, symbol): symbols missing on either side drop."""
    a = actual.select("localDate", F.col("id").alias("symbol"),
                      *[F.col(h).cast("double").alias(f"{h}_a") for h in HEADS])
    p = preds.select("localDate", "symbol", *[F.col(h).cast("double").alias(f"{h}_p") for h in HEADS])
    return p.join(a, ["localDate", "symbol"])


def directional_accuracy(pva: DataFrame, head: str = "log_return_1d") -> DataFrame:
    """Per date: total = symbols on both sides, correct = pred * actual > 0."""
    return pva.groupBy("localDate").agg(
        F.count_if(F.col(f"{head}_p") * F.col(f"{head}_a") > 0).alias("correct"),
        F.count(F.lit(1)).alias("total"))


def top_gainers_hit_rate(preds: DataFrame, actual: DataFrame, k: int = C.TOP_GAINERS_COUNT,
                         head: str = "log_return_1d") -> DataFrame:
    """Per date: how many of the top-k predicted have an actual > 0."""
    top = top_gainers_per_date(preds, k, head).select("localDate", "symbol")
    a = actual.select("localDate", F.col("id").alias("symbol"), F.col(head).alias("_a"))
    j = top.join(a, ["localDate", "symbol"], "left")
    return j.groupBy("localDate").agg(F.count_if(F.col("_a") > 0).alias("hits"))


def actual_row(stored: DataFrame, day) -> DataFrame:
    """The stored target row of one date (after keep-last); fails when the
    date has no actuals."""
    row = stored.filter(F.col("localDate") == F.lit(day))
    if row.isEmpty():
        raise ValueError(f"{day} has no stored targets")
    return row


def center(s: Column, width: int) -> Column:
    """Centre text in ``width`` (extra space on the right, as Python's '^')."""
    n = F.length(s)
    pad = F.greatest(F.lit(width) - n, F.lit(0))
    left = F.floor(pad / 2).cast("int")
    return F.concat(F.lpad(s, (n + left).cast("int"), " "),
                    F.repeat(F.lit(" "), (pad - left).cast("int")))


def prediction_line(symbol: Column, p: dict[str, Column]) -> Column:
    """``{sym:<6} {z:+.3f} {r:+.3f} {d:.2f} {lr1:+.5f} {lr3:+.5f} {lr5:+.5f}``."""
    return F.format_string("%-6s %+.3f %+.3f %.2f %+.5f %+.5f %+.5f", symbol,
                           p["zscore_1d"], p["rank_1d"], p["direction_1d"],
                           p["log_return_1d"], p["log_return_3d"], p["log_return_5d"])


def comparison_line(symbol: Column, p: dict[str, Column], a: dict[str, Column]) -> Column:
    """Predicted vs actual for one symbol; predicted direction shown as 1
    when >= 0.5."""
    pd_ = center((p["direction_1d"] >= 0.5).cast("int").cast("string"), 3)
    ad_ = center(a["direction_1d"].cast("int").cast("string"), 3)
    return F.concat(
        F.format_string("%-6s %+.3f %+.3f %+.3f %+.3f ", symbol, p["zscore_1d"], a["zscore_1d"],
                        p["rank_1d"], a["rank_1d"]),
        pd_, F.lit(" "), ad_, F.lit(" "),
        F.format_string("%+.5f %+.5f %+.5f %+.5f %+.5f %+.5f",
                        p["log_return_1d"], a["log_return_1d"], p["log_return_3d"],
                        a["log_return_3d"], p["log_return_5d"], a["log_return_5d"]))


COMPARISON_HEADER = C.COMPARISON_HEADER


def report_dates(preds: DataFrame) -> tuple:
    """(latest, previous) prediction dates: a take-ordered of the distinct
    dates (two rows reach the driver). Fails with fewer than two."""
    top = [r.localDate for r in preds.select("localDate").distinct()
           .orderBy(F.col("localDate").desc()).limit(2).collect()]
    if len(top) < 2:
        raise ValueError(f"a report compares two prediction dates; {len(top)} stored")
    return top[0], top[1]


def report_body(preds: DataFrame, actual: DataFrame, watched: DataFrame) -> DataFrame:
    """One row with the report text: the latest date's watched predictions,
    then the previous date's predicted vs actual; lines in watch-list order.

    The two dates become literal filters (partition pruning on stored
    predictions); only the watched rows of those dates are kept."""
    latest, previous = report_dates(preds)
    w = watched.select(F.col("id").alias("symbol"), "wpos")
    lp = preds.filter(F.col("localDate") == F.lit(latest)).join(w, "symbol")
    l1 = lp.select("wpos", prediction_line(F.col("symbol"), {h: F.col(h) for h in HEADS}).alias("line"))
    pva = predicted_vs_actual(preds.filter(F.col("localDate") == F.lit(previous)),
                              actual.filter(F.col("localDate") == F.lit(previous))).join(w, "symbol")
    l2 = pva.select("wpos", comparison_line(F.col("symbol"), {h: F.col(f"{h}_p") for h in HEADS},
                                            {h: F.col(f"{h}_a") for h in HEADS}).alias("line"))
    tagged = (l1.withColumn("part", F.lit(1)).unionByName(l2.withColumn("part", F.lit(2))))
    parts = tagged.groupBy().agg(
        F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(
            F.when(F.col("part") == 1, F.struct("wpos", "line")))), lambda s: s["line"])).alias("b1"),
        F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(
            F.when(F.col("part") == 2, F.struct("wpos", "line")))), lambda s: s["line"])).alias("b2"))
    body = F.concat_ws("\n",
                       F.lit(f"{latest.isoformat()} prediction"),
                       F.lit("Watched symbols"), F.col("b1"), F.lit(""),
                       F.lit(f"{previous.isoformat()} predicted vs actual"),
                       F.lit("Watched symbols"), F.lit(COMPARISON_HEADER), F.col("b2"), F.lit(""))
    return parts.select(F.lit(latest).alias("latest"), F.lit(previous).alias("previous"),
                        body.alias("body"))
