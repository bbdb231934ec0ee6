"""Mergeable daily states of the news roll-up.

A day's state is one row: counts, sums, extremes, and the first four central moments of
its scores (n, mean, M2, M3, M4), so that the states of two sets of articles merge to that of
their union without the articles. Beside it, how many articles have each score gives the exact
median. Every metric of the roll-up follows from the two.

``fold`` keeps such states in date partitions: a batch reads the partitions of its own days
only and replaces them. A partition remembers the batch it was last merged with, so a batch
that is replayed changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C
from tidemark.operators.rank import exact_median
from tidemark.operators.rollup import float32_threshold
from tidemark.session import cut_lineage

SUMS = ("n", "positive", "negative", "extreme", "neutral", "conflict", "weighted", "length")
MOMENTS = ("mean", "m2", "m3", "m4", "length_m2")
STATE = T.StructType([T.StructField("localDate", T.DateType())] + [
    T.StructField(c, T.LongType() if c in SUMS[:6] else T.DoubleType())
    for c in (*SUMS, "high", "low", *MOMENTS)])
COUNTS = T.StructType([T.StructField("localDate", T.DateType()),
                       T.StructField("score", T.DoubleType()), T.StructField("n", T.LongType())])


def score_and_length() -> tuple[Column, Column]:
    return (F.col("sentiment_score").cast("float").cast("double"),
            F.col("text_length").cast("double"))


def sum_columns() -> dict[str, Column]:
    """The parts of a state that add up, and the extremes."""
    s, length = score_and_length()
    a = F.abs(s)
    at = float32_threshold
    return {"n": F.count(F.lit(1)), "positive": F.count_if(s > 0), "negative": F.count_if(s < 0),
            "extreme": F.count_if(a > at(C.EXTREME_THRESHOLD)),
            "neutral": F.count_if(a < at(C.NEUTRAL_THRESHOLD)),
            "conflict": F.count_if((a >= at(C.CONFLICT_THRESHOLD_LOW))
                                   & (a <= at(C.CONFLICT_THRESHOLD_HIGH))),
            "weighted": F.sum(s * length), "length": F.sum(length), "high": F.max(s), "low": F.min(s)}


def daily_states(sentiment: DataFrame) -> DataFrame:
    """One state a day, from partial aggregates."""
    s, length = score_and_length()
    n = F.col("n")
    g = sentiment.groupBy("localDate").agg(
        *[c.alias(k) for k, c in sum_columns().items()], F.avg(s).alias("mean"),
        F.var_pop(s).alias("_v"), F.skewness(s).alias("_s"), F.kurtosis(s).alias("_k"),
        F.var_pop(length).alias("_l"))
    m2 = F.col("_v") * n
    return g.select(*STATE.fieldNames()[:-5], "mean", m2.alias("m2"),
                    (F.coalesce("_s", F.lit(0.0)) * F.pow(m2, F.lit(1.5)) / F.sqrt(n)).alias("m3"),
                    (F.coalesce(F.col("_k") + 3, F.lit(0.0)) * m2 * m2 / n).alias("m4"),
                    (F.col("_l") * n).alias("length_m2"))


def score_counts(sentiment: DataFrame) -> DataFrame:
    """(localDate, score, n): how many articles of a day have each score."""
    return sentiment.groupBy("localDate", score_and_length()[0].alias("score")).agg(
        F.count(F.lit(1)).alias("n"))


def merged_state(a: str, b: str) -> dict[str, Column]:
    """The state of the union of two disjoint sets, pairwise (``a`` and ``b``: aliases)."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    na, nb = x("n").cast("double"), y("n").cast("double")
    n, d = na + nb, y("mean") - x("mean")
    dn = d / n
    dl = y("length") / nb - x("length") / na
    out = {c: x(c) + y(c) for c in SUMS}
    out |= {"high": F.greatest(x("high"), y("high")), "low": F.least(x("low"), y("low")),
            "mean": x("mean") + dn * nb,
            "m2": x("m2") + y("m2") + d * dn * na * nb,
            "m3": (x("m3") + y("m3") + d * dn * dn * na * nb * (na - nb)
                   + 3 * dn * (na * y("m2") - nb * x("m2"))),
            "m4": (x("m4") + y("m4") + d * dn * dn * dn * na * nb * (na * na - na * nb + nb * nb)
                   + 6 * dn * dn * (na * na * y("m2") + nb * nb * x("m2"))
                   + 4 * dn * (na * y("m3") - nb * x("m3"))),
            "length_m2": x("length_m2") + y("length_m2") + dl * dl * na * nb / n}
    return out


def sum_metrics() -> dict[str, Column]:
    """The metrics that follow from the parts that add up."""
    n = F.col("n")
    share = lambda c: F.col(c) / n
    return {"count_articles": n, "pct_positive": share("positive"), "pct_negative": share("negative"),
            "polarity_ratio": share("positive") - share("negative"),
            "weighted_mean_sentiment": F.col("weighted") / (F.col("length") + C.PREVENT_DIV_BY_ZERO),
            "extreme_sentiment_share": share("extreme"), "neutral_share": share("neutral"),
            "max_sentiment": F.col("high"), "min_sentiment": F.col("low"),
            "ratio_pos_neg": share("positive") / (share("negative") + C.PREVENT_DIV_BY_ZERO),
            "conflict_share": share("conflict")}


def metrics(states: DataFrame, counts: DataFrame) -> DataFrame:
    """The roll-up of the days of ``states``; ``counts`` gives the medians."""
    n, m2 = F.col("n"), F.col("m2")
    flat = (F.col("high") == F.col("low")) | (m2 <= 0)
    out = sum_metrics() | {
        "mean_sentiment": F.col("mean"),
        "sentiment_skewness": F.when((n < 3) | flat, 0.0).otherwise(
            F.sqrt(n) * F.col("m3") / F.pow(m2, F.lit(1.5))),
        "sentiment_kurtosis": F.when((n < 4) | flat, 0.0).otherwise(
            n * F.col("m4") / (m2 * m2) - 3),
        "article_length_variance": F.col("length_m2") / n}
    middle = exact_median(counts, "score", ["localDate"], out="median_sentiment", weight="n")
    return states.join(middle, "localDate").select("localDate", *[
        F.col(m) if m == "median_sentiment" else out[m].alias(m) for m in C.AGGREGATED_METRICS])


# --- stored states ----------------------------------------------------------


def read_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A store as rows with ``batch``; empty where nothing is stored yet."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    from tidemark.sources.parquet import exists
    return (spark.read.schema(whole).parquet(path) if exists(spark, path)
            else spark.createDataFrame([], whole))


def _replace(df: DataFrame, path: str) -> None:
    (df.hint("rebalance", "localDate").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("localDate").parquet(path))


def fold_states(part: DataFrame, path: str, batch: int) -> list:
    """Merge the states of a batch into the store; the days it holds, in order."""
    spark = part.sparkSession
    part = cut_lineage(part)                                  # one row a day
    days = sorted(r["localDate"] for r in part.select("localDate").collect())
    stored = read_store(spark, path, STATE).where(F.col("localDate").isin(days))
    both = part.alias("b").join(stored.alias("a"), "localDate", "left")
    merged = merged_state("a", "b")
    rows = both.select("localDate", *[
        F.when(F.col("a.n").isNull(), F.col(f"b.{c}"))
        .when(F.col("a.batch") >= batch, F.col(f"a.{c}")).otherwise(merged[c]).alias(c)
        for c in STATE.fieldNames()[1:]],
        F.greatest(F.coalesce("a.batch", F.lit(batch)), F.lit(batch)).cast("long").alias("batch"))
    _replace(rows, path)
    return days


def fold_counts(part: DataFrame, path: str, batch: int, days: list) -> None:
    """Add the score counts of a batch, whose days are ``days``, to the store.

    All rows of a day have the number of the batch that wrote them, and hold the scores of
    every batch so far; so a replayed batch meets its number on each of its rows."""
    stored = read_store(part.sparkSession, path, COUNTS).where(F.col("localDate").isin(days))
    both = stored.unionByName(part.withColumn("batch", F.lit(None).cast("long")))
    old, new = (F.sum(F.when(c, F.col("n")).otherwise(0)) for c in (
        F.col("batch").isNotNull(), F.col("batch").isNull()))
    rows = both.groupBy("localDate", "score").agg(F.when(
        F.coalesce(F.max("batch") >= batch, F.lit(False)), old).otherwise(old + new).alias("n"))
    _replace(rows.withColumn("batch", F.lit(batch).cast("long")), path)


def stored_metrics(spark: SparkSession, states: str, counts: str, days: list | None = None) -> DataFrame:
    """The roll-up of the stored days, or of ``days``: only their partitions are read."""
    tables = [read_store(spark, p, s).drop("batch") for p, s in ((states, STATE), (counts, COUNTS))]
    if days is not None:
        tables = [t.where(F.col("localDate").isin(days)) for t in tables]
    return metrics(*tables)
