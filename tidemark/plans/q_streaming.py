"""Registered streaming queries: each lands derived files, runs the stream
to completion (availableNow) and returns the sink read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.q_ingest import q_ingest_stock_json  # noqa: F401  (registers its oracle)
from tidemark.plans.q_news import ALL_METRICS, NEWS
from tidemark.plans.registry import ORACLE, register, rounded
from tidemark.schemas import SENTIMENT
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources import fixtures as FX
from tidemark.streaming import jobs as SJ


@register("stream_ingest", ORACLE["ingest_stock_json"])
def q_stream_ingest(spark, sf_dir):
    """Two landings, two catch-up runs on one checkpoint: the second run only
    reads the new files; the sink holds every bar once."""
    landing, out, ck = (scratch_path(spark, n) for n in ("landing", "raw-stock", "ckpt"))
    p = FX.price_payloads(spark, sf_dir)
    even = F.substring("id", 2, 64).cast("long") % 2 == 0
    p.filter(even).write.mode("append").json(landing)
    SJ.stream_ingest_prices(spark, landing, out, ck)
    p.write.mode("append").json(landing)                      # the even ones land again
    SJ.stream_ingest_prices(spark, landing, out, ck)
    SJ.stream_ingest_prices(spark, landing, out, ck)          # nothing new: no-op
    back = SJ.stored_bars(spark, out)
    return rounded(back.select("localDate", "id", "close", "high", "low", "open", "volume"))


def _land_sentiment(spark, sf_dir, landing, spread_days=1):
    """Eight files by day; ``spread_days`` stretches the month over that many
    times its days, and the files are written newest first, so days arrive out of order."""
    s = FX.sentiment_fixed(spark, sf_dir).select(*SENTIMENT.fieldNames())
    first = F.lit("2024-01-01").cast("date")
    s = s.withColumn("localDate", F.date_add(first, F.datediff("localDate", first) * spread_days))
    # sampling for the ranges reads a table, not the texts once more
    cut_lineage(s).repartitionByRange(8, F.desc("localDate")).write.parquet(landing)


@register("stream_daily_rollup", NEWS + "SELECT CAST(DATE '2024-01-01' + CAST("
          "datediff('day', DATE '2024-01-01', localDate) * 9 AS INTEGER) AS DATE) AS localDate, " + ", ".join(
    ["count_articles"] + [f"round({m}, 6) AS {m}" for m in SJ.STREAMABLE[1:]]) + " FROM daily")
def q_stream_daily_rollup(spark, sf_dir):
    landing, out, ck = (scratch_path(spark, n) for n in ("sentiment", "agg", "ckpt"))
    _land_sentiment(spark, sf_dir, landing, spread_days=9)      # 30 days over nine months
    SJ.stream_daily_subset(spark, landing, out, ck)
    return rounded(spark.read.parquet(out).select("localDate", *SJ.STREAMABLE))


@register("stream_upsert_partitions", NEWS + f"SELECT localDate, {ALL_METRICS} FROM daily")
def q_stream_upsert_partitions(spark, sf_dir):
    landing, store, out, ck = (scratch_path(spark, n) for n in ("sentiment", "store", "agg", "ckpt"))
    _land_sentiment(spark, sf_dir, landing)
    SJ.stream_upsert_rollup(spark, landing, store, out, ck)
    from tidemark.config import AGGREGATED_METRICS
    return rounded(spark.read.parquet(out).select("localDate", *AGGREGATED_METRICS))
