"""Daily news roll-up (16 metrics) and calendar-day lagged features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators.panel import calendar_spine
from tidemark.operators.rank import exact_median
from tidemark.session import cut_lineage


def _as_date(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("date")


def float32_threshold(x: float) -> Column:
    """Thresholds compare as float32, like the float32 scores."""
    return F.lit(x).cast("float").cast("double")


def metric_columns(s: Column, L: Column) -> dict[str, Column]:
    """Partial-aggregatable metric expressions over score ``s`` and length
    ``L`` (both double); median is computed separately (exact, distributed)."""
    a = F.abs(s)
    share = lambda cond: F.avg(cond.cast("double"))
    n = F.count(F.lit(1))
    return {
        "count_articles": n,
        "mean_sentiment": F.avg(s),
        "pct_positive": share(s > 0),
        "pct_negative": share(s < 0),
        "weighted_mean_sentiment": F.sum(s * L) / (F.sum(L) + C.PREVENT_DIV_BY_ZERO),
        "extreme_sentiment_share": share(a > float32_threshold(C.EXTREME_THRESHOLD)),
        "sentiment_skewness": F.when(n < 3, 0.0).otherwise(F.coalesce(F.skewness(s), F.lit(0.0))),
        "sentiment_kurtosis": F.when(n < 4, 0.0).otherwise(F.coalesce(F.kurtosis(s), F.lit(0.0))),
        "neutral_share": share(a < float32_threshold(C.NEUTRAL_THRESHOLD)),
        "max_sentiment": F.max(s),
        "min_sentiment": F.min(s),
        "article_length_variance": F.var_pop(L),
        "conflict_share": share((a >= float32_threshold(C.CONFLICT_THRESHOLD_LOW)) &
                                (a <= float32_threshold(C.CONFLICT_THRESHOLD_HIGH))),
    }


def daily_rollup(sentiment: DataFrame, with_median: bool = True) -> DataFrame:
    """One row per date with articles, the 16 metrics in schema order.

    Every metric except the median is a grouped aggregate with map-side
    partial aggregation, so a day holding a third of all articles is merged
    from per-task partials. The median is an exact order statistic from
    counts by magnitude and value, so no article row is sorted and no task holds a day."""
    s = F.col("sentiment_score").cast("float").cast("double")
    L = F.col("text_length").cast("double")
    mc = metric_columns(s, L)
    agg = sentiment.groupBy("localDate").agg(*[c.alias(k) for k, c in mc.items()])
    agg = (agg.withColumn("polarity_ratio", F.col("pct_positive") - F.col("pct_negative"))
              .withColumn("ratio_pos_neg", F.col("pct_positive") /
                          (F.col("pct_negative") + C.PREVENT_DIV_BY_ZERO)))
    if with_median:
        med = exact_median(sentiment.select("localDate", s.alias("score")), "score",
                           ["localDate"], out="median_sentiment")
        agg = agg.join(med, "localDate")
    else:
        agg = agg.withColumn("median_sentiment", F.lit(None).cast("double"))
    return agg.select("localDate", *C.AGGREGATED_METRICS)


def spine_zero_fill(daily: DataFrame, start=None, end=None) -> DataFrame:
    """Every calendar day from the first (or ``start``) to the last (or
    ``end``) day; a day with no news gets an all-zero metric row."""
    lo = _as_date(start) if start is not None else daily.select(F.min("localDate")).scalar()
    hi = _as_date(end) if end is not None else daily.select(F.max("localDate")).scalar()
    spine = daily.sparkSession.range(1).select(calendar_spine(lo, hi).alias("localDate"))
    j = spine.join(daily, "localDate", "left")
    return j.select("localDate", *[F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m)
                                   for m in C.AGGREGATED_METRICS])


def lagged_columns(lag_days: int = C.LAG_DAYS) -> list[str]:
    """Lag-major column names ``{metric}-{lag}``."""
    return [f"{m}-{k}" for k in range(1, lag_days + 1) for m in C.AGGREGATED_METRICS]


def lagged_features(daily: DataFrame, lag_days: int = C.LAG_DAYS, start=None,
                    end=None) -> DataFrame:
    """For each calendar day D from ``start`` (default: first day with news)
    to ``end`` (default: last day + 1): the metrics of D-1 ... D-lag as
    ``{metric}-{lag}``, zero where a day has no news.

    Each lag is an equi-join of the generated spine with the date-shifted
    daily table (one row per day), not a window over one
    global ordering."""
    # the roll-up is one row per day; materialise it once so the lag joins
    # and the bounds do not each re-derive it from the articles
    daily = cut_lineage(daily)
    lo = _as_date(start) if start is not None else daily.select(F.min("localDate")).scalar()
    hi = _as_date(end) if end is not None else \
        daily.select(F.date_add(F.max("localDate"), 1)).scalar()
    out = daily.sparkSession.range(1).select(calendar_spine(lo, hi).alias("localDate"))
    cols = []
    for k in range(1, lag_days + 1):
        shifted = daily.select(F.date_add("localDate", k).alias("localDate"),
                               *[F.col(m).cast("double").alias(f"{m}-{k}")
                                 for m in C.AGGREGATED_METRICS])
        out = out.join(shifted, "localDate", "left")
        cols += [f"{m}-{k}" for m in C.AGGREGATED_METRICS]
    return out.select("localDate", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c)
                                     for c in cols])
