"""Incremental batch jobs over one storage root: the reference's daily
lifecycle as set-based plans.

Layout under ``root`` (all Parquet):

    symbols/                     id, sector, pos
    raw/stock/localDate=D/       landed bars          (RAW_STOCK)
    raw/news/localDate=D/        landed articles      (RAW_NEWS)
    stock/panel/localDate=D/     long dense panel     (localDate, id, pos, 5 x float)
    stock/target/localDate=D/    long targets
    news/sentiment/localDate=D/  scored articles      (SENTIMENT)
    news/aggregated/localDate=D/ daily roll-up
    news/lagged/run=T/           calendar-day lag table
    model/score=S/{head}/        Spark ML heads; meta.json next to them
    inference/localDate=D/       predictions          (INFERENCE)
    metadata/control/            high-water marks (pipeline, key, value)

Each job reads its marks, processes only pending partitions (range filters
on the partition column prune the scan), writes its output, and only then
advances its mark. Rerunning a job with nothing pending is a no-op.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark import schemas as SC
from tidemark.functions import dates as D
from tidemark.operators import dataset as DS
from tidemark.operators import heads as H
from tidemark.operators import models as MD
from tidemark.operators import panel as P
from tidemark.operators import report as RP
from tidemark.operators import rollup as RU
from tidemark.operators import sentiment as SN
from tidemark.operators import targets as TG
from tidemark.sources import parquet as PQ
from tidemark.sources import state as ST
from tidemark.sources.symbols import load_symbols

START = dt.date.fromisoformat(C.START_DATE)


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _mark(spark: SparkSession, root: str, pipeline: str, key: str, default=None):
    return ST.read_mark(spark, _p(root, "metadata", "control"), pipeline, key, default).first().value


def _set_mark(spark: SparkSession, root: str, pipeline: str, key: str, value) -> None:
    rows = spark.createDataFrame([(pipeline, key, value)], "pipeline string, key string, value date")
    ST.write_marks(rows, _p(root, "metadata", "control"))


def _run_ts() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def _latest(spark: SparkSession, path: str) -> DataFrame:
    """Keep-last view of a run-appended table with one row a date."""
    return DS.dedupe_keep_last(PQ.read_runs(spark, path), "localDate")


def _max_date(df: DataFrame):
    return df.agg(F.max("localDate")).first()[0]


def seed_panel(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    """The stored panel rows of ``days``, through a literal partition filter."""
    return spark.read.parquet(path).filter(
        F.col("localDate").isin(*[dt.date.fromisoformat(d) for d in days]))


# --- E1: price features ---------------------------------------------------

def price_features_job(spark: SparkSession, root: str, gate: str = "first_symbol") -> str:
    """Dense panel and targets for raw dates in (lastProcessed, lastAdded]."""
    raw_path = _p(root, "raw", "stock")
    if not PQ.exists(spark, raw_path):
        return "nothing landed"
    raw = PQ.read_checked(spark, raw_path, SC.RAW_STOCK)
    last_added = _mark(spark, root, "stock_collector", "lastAdded") or _max_date(raw)
    last_done = _mark(spark, root, "stock_preproc", "lastProcessed", START - dt.timedelta(days=1))
    if last_done >= last_added:
        return "nothing new"
    new_raw = raw.filter((F.col("localDate") > F.lit(last_done)) &
                         (F.col("localDate") <= F.lit(last_added)))
    symbols = load_symbols(spark, _p(root, "symbols"))
    dates = P.trading_dates(new_raw, symbols, gate)
    panel_new = P.dense_panel(new_raw, symbols, dates)
    panel_path = _p(root, "stock", "panel")
    seeded = panel_new
    days = PQ.newest_dates(spark, panel_path, C.MAX_LOG_RETURN_HORIZON, last_done)
    if days:
        # the returns reach back at most that many trading rows: only these
        # date partitions of the history are read
        old = seed_panel(spark, panel_path, days)
        seeded = old.select(*[F.col(f.name).cast(f.dataType) for f in panel_new.schema.fields]
                            ).unionByName(panel_new)
    targets = TG.incremental_targets(seeded, last_done)
    PQ.write_partitions(panel_new.select("localDate", "id", "pos",
                                         *[F.col(c).cast("float").alias(c) for c in P.BAR_FIELDS]),
                        panel_path)
    done = ST.write_observed(
        targets.select("localDate", "id", "pos",
                       *[F.col(c).cast("float").alias(c) for c in TG.TARGET_COLS[:5]],
                       F.col("direction_1d").cast("tinyint")),
        lambda df: PQ.write_partitions(df, _p(root, "stock", "target")))
    if done["newest"] is not None:
        _set_mark(spark, root, "stock_preproc", "lastProcessed", done["newest"])
    return "processed"


# --- E2: news features ----------------------------------------------------

def news_features_job(spark: SparkSession, root: str, logits_fn=SN.lexical_logits,
                      lag_days: int = C.LAG_DAYS) -> str:
    """Score articles of days without stored sentiment, roll up days without
    stored aggregates, and emit lag rows for (lastProcessed, lastAdded + 1]."""
    raw_path = _p(root, "raw", "news")
    if not PQ.exists(spark, raw_path):
        return "nothing landed"
    raw = PQ.read_checked(spark, raw_path, SC.RAW_NEWS)
    last_added = _mark(spark, root, "news_collector", "lastAdded") or _max_date(raw)
    last_done = _mark(spark, root, "news_preproc", "lastProcessed", START - dt.timedelta(days=1))
    if last_done > last_added:
        return "nothing new"
    first = last_done + dt.timedelta(days=1)
    lo = first - dt.timedelta(days=lag_days)
    window = (F.col("localDate") >= F.lit(lo)) & (F.col("localDate") <= F.lit(last_added))
    sent_path, agg_path = _p(root, "news", "sentiment"), _p(root, "news", "aggregated")
    # sentiment tier: only days with raw news and no stored sentiment
    raw_days = raw.filter(window)
    if PQ.exists(spark, sent_path):
        raw_days = raw_days.join(spark.read.parquet(sent_path).select("localDate").distinct(),
                                 "localDate", "left_anti")
    scored = SN.score_articles(raw_days, logits_fn)
    PQ.write_partitions(scored.select(*SC.SENTIMENT.fieldNames()), sent_path, SC.SENTIMENT)
    sent = spark.read.parquet(sent_path).filter(window) if PQ.exists(spark, sent_path) else None
    # aggregated tier: days with sentiment and no stored aggregate
    if sent is not None:
        todo = sent
        if PQ.exists(spark, agg_path):
            todo = sent.join(spark.read.parquet(agg_path).select("localDate").distinct(),
                             "localDate", "left_anti")
        daily = RU.daily_rollup(todo)
        PQ.write_partitions(daily.select("localDate", F.col("count_articles").cast("int"),
                                         *[F.col(m).cast("float") for m in C.AGGREGATED_METRICS[1:]]),
                            agg_path, SC.AGGREGATED)
    agg = (spark.read.parquet(agg_path).filter(window) if PQ.exists(spark, agg_path)
           else spark.createDataFrame([], SC.AGGREGATED))
    lagged = RU.lagged_features(agg, lag_days, start=first, end=last_added + dt.timedelta(days=1))
    PQ.append_run(lagged.select("localDate", *[F.col(f"`{c}`").cast("float").alias(c)
                                                for c in RU.lagged_columns(lag_days)]),
                  _p(root, "news", "lagged"), _run_ts())
    _set_mark(spark, root, "news_preproc", "lastProcessed", last_added + dt.timedelta(days=1))
    return "processed"


# --- E3: train, infer, notify ---------------------------------------------

def stored_tables(spark: SparkSession, root: str):
    """(panel, targets, lagged): the date-partitioned tables as stored, and the
    keep-last view of the run-appended lag table. Reads only."""
    return (spark.read.parquet(_p(root, "stock", "panel")),
            spark.read.parquet(_p(root, "stock", "target")),
            _latest(spark, _p(root, "news", "lagged")))


def compact_job(spark: SparkSession, root: str) -> str:
    """Merge the runs of the lag table into one (its own job: nothing else may
    delete what a reader might hold)."""
    done = PQ.compact_runs(spark, _p(root, "news", "lagged"), "localDate", _run_ts())
    return "compacted" if done else "one run"


def train_job(spark: SparkSession, root: str, window: int = C.WINDOW_SIZE) -> str:
    """Align the stored tables, split, fit and score the heads, register the
    models under ``model/score=<score>/`` with their metadata."""
    panel, targets, lagged = stored_tables(spark, root)
    aligned = DS.common_dates(panel, lagged, targets)
    DS.check_alignment(panel, lagged, targets)
    samples = H.samples(panel, targets, lagged, aligned, window)
    heads, losses, score_text = MD.fit_and_score(samples)
    model_dir = _p(root, "model", f"score={score_text}")
    H.save(heads, spark, model_dir)
    n_sym = panel.select(F.count_distinct("id")).first()[0]
    meta = losses.groupBy().pivot("head", [*MD.HEADS, "normalized"]).agg(F.first("loss"))
    meta = meta.select(F.to_json(F.struct(
        F.struct(F.lit("linear_heads").alias("name"), F.lit(score_text).alias("score")).alias("model"),
        F.struct(F.date_format(F.current_date(), "yyyy-MM-dd").alias("date"),
                 F.lit(n_sym).alias("symbol_count"), F.lit(samples.n_validation).alias("validation_size"),
                 F.struct(F.lit(window).alias("window_size"), F.lit(C.BATCH_SIZE).alias("batch_size"))
                 .alias("config"),
                 F.struct(F.col("normalized").alias("normalized_val_loss"),
                          F.struct(*[F.col(h) for h in MD.HEADS]).alias("val_losses"))
                 .alias("result_analysis")).alias("training"))).alias("value"))
    meta.coalesce(1).write.mode("overwrite").text(f"{model_dir}/meta.json")
    return score_text


def infer_job(spark: SparkSession, root: str, first_date=None, window: int = C.WINDOW_SIZE) -> str:
    """Predict every pending weekday, from the day after lastInferred (or
    ``first_date``) to the weekday after the joint watermark, in one plan."""
    panel, targets, lagged = stored_tables(spark, root)
    trading = panel.select("localDate").distinct()
    marks = ST.read_marks(spark, _p(root, "metadata", "control"))
    wm = ST.joint_watermark(marks, "lastProcessed", ["stock_preproc", "news_preproc"]).first()[0]
    last = _mark(spark, root, "inference", "lastInferred")
    start = D.next_weekday(F.lit(last)) if last else F.lit(first_date or wm).cast("date")
    days = D.calendar_days(start, D.next_weekday(F.lit(wm)))
    pending = spark.range(1).select(F.explode(days).alias("query_date")).filter(
        D.is_weekday(F.col("query_date")))
    if pending.isEmpty():
        return "nothing pending"
    heads = H.load(spark, MD.best_model_dir(spark, _p(root, "model")))
    out = MD.predict_for_dates(heads, pending, panel, lagged, trading, window)
    # the mark follows what was written, not what was asked for
    done = ST.write_observed(out.select(*SC.INFERENCE.fieldNames()), lambda df: PQ.write_partitions(
        df, _p(root, "inference"), SC.INFERENCE))
    _set_mark(spark, root, "inference", "lastInferred", done["newest"])
    return "predicted"


def notify_job(spark: SparkSession, root: str, watch_list: str = C.WATCHED_SYMBOLS) -> DataFrame:
    """The report body from the two newest stored prediction partitions and
    the stored targets of the previous one."""
    preds = spark.read.parquet(_p(root, "inference"))
    panel, targets, _ = stored_tables(spark, root)
    symbols = load_symbols(spark, _p(root, "symbols"))
    return RP.report_body(preds, targets, P.watched_symbols(symbols, watch_list))
