"""Streaming versions of the collectors' catch-up loops and of the daily
news roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import states as ST
from tidemark.schemas import SENTIMENT
from tidemark.session import cut_lineage
from tidemark.sources import parquet as PQ
from tidemark.sources import payloads as PL

LANDED_PRICE = T.StructType([T.StructField("id", T.StringType()),
                             T.StructField("payload", T.StringType())])


def run_available(writer, path: str | None = None) -> None:
    """Start a writer with ``availableNow`` and wait for it to finish."""
    q = writer.trigger(availableNow=True).start(path) if path else \
        writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace the partitions present in ``df``; few files for each."""
    (df.hint("rebalance", *partitions).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def stream_ingest_prices(spark: SparkSession, landing: str, out: str, checkpoint: str,
                         max_files: int = 4, quarantine: str | None = None) -> None:
    """Decode every newly landed quote payload file into bars, and what cannot be
    decoded into ``quarantine`` (default: ``<out>-quarantine``), payload included.

    Files already processed are remembered by the checkpoint, so a rerun only
    picks up new landings. A micro-batch is stored under (localDate, batch) and a
    replay overwrites its own partitions; a payload that lands again lands in a
    newer batch, and :func:`stored_bars` reads each bar's newest. A sink belongs to one
    checkpoint. A value that does not parse quarantines its payload and never
    stops the stream."""
    raw = (spark.readStream.schema(LANDED_PRICE).option("maxFilesPerTrigger", max_files)
           .json(landing))

    def store(batch: DataFrame, batch_id: int) -> None:
        routed = PL.routed_prices(batch, strict=False).persist()
        try:            # one scan and one parse; bars and quarantine are read from its result
            _overwrite(PL.bars_of(routed).withColumn("batch", F.lit(batch_id)), out,
                       "localDate", "batch")
            _overwrite(PL.quarantine_of(routed).withColumn("batch", F.lit(batch_id)),
                       quarantine or f"{out.rstrip('/')}-quarantine", "batch")
        finally:
            routed.unpersist()

    run_available(raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store))


def stored_bars(spark: SparkSession, out: str) -> DataFrame:
    """Streamed bars, each (localDate, id) from the newest batch that holds it."""
    df = spark.read.parquet(out)
    rest = [c for c in df.columns if c not in ("localDate", "id", "batch")]
    best = df.groupBy("localDate", "id").agg(F.max_by(F.struct(*rest), "batch").alias("v"))
    return best.select("localDate", "id", "v.*")


STREAMABLE = ("count_articles", "mean_sentiment", "pct_positive", "pct_negative",
              "weighted_mean_sentiment", "extreme_sentiment_share", "neutral_share",
              "max_sentiment", "min_sentiment", "conflict_share")
#: What a day's row of the stateful roll-up holds: parts that add up, and extremes.
PARTS = (*ST.SUMS, "total", "high", "low")
PART_ROWS = T.StructType([T.StructField("localDate", T.DateType())] + [
    T.StructField(c, T.LongType() if c in ST.SUMS[:6] else T.DoubleType()) for c in PARTS])
FOLDED = T.StructType([*PART_ROWS.fields, T.StructField("batch", T.LongType())])
EPOCH = "1970-01-01"
#: A day stays in the stream's state until days this much newer have come.
DELAY_DAYS = 7


def _parts() -> list:
    score, _ = ST.score_and_length()
    cols = ST.sum_columns() | {"total": F.sum(score)}
    return [cols[c].cast(PART_ROWS[c].dataType).alias(c) for c in PARTS]


def _added(parts: DataFrame) -> DataFrame:
    """The parts of each day added up; extremes kept."""
    how = {"high": F.max, "low": F.min}
    return parts.groupBy("localDate").agg(*[how.get(c, F.sum)(c).alias(c) for c in PARTS])


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table read by its schema; empty where no file was written yet."""
    return (spark.read.schema(schema).parquet(path) if PQ.exists(spark, path)
            else spark.createDataFrame([], schema))


def _route(spark: SparkSession, source: str, root: str, checkpoint: str, max_files: int,
           delay_days: int) -> None:
    """Deal the rows of each micro-batch to ``root/open`` or ``root/late``.

    The border of a batch is the newest day of all batches before it less the delay, kept
    as one row a batch in ``root/border``: a replayed batch has the border it had. Days at or
    after the border cannot have left the state of the stream that reads ``open``."""
    src = (spark.readStream.schema(SENTIMENT).option("maxFilesPerTrigger", max_files)
           .parquet(source))
    mark = T.StructType([T.StructField("batch", T.LongType()), T.StructField("newest", T.DateType())])

    def deal(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        newest = (_stored(own, f"{root}/border", mark).where(F.col("batch") < batch_id)
                  .agg(F.max("newest")).first()[0])
        border = F.lit(newest).cast("date")
        late = F.coalesce(F.col("localDate") < F.date_sub(border, delay_days), F.lit(False))
        here = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        # on-time rows go to one file a task: the next stream takes them in order of batches
        _overwrite(here.where(~late), f"{root}/open", "batch")
        _overwrite(here.where(late), f"{root}/late", "batch")
        _overwrite(batch.agg(F.max("localDate").alias("newest")).where("newest IS NOT NULL")
                   .withColumn("batch", F.lit(batch_id).cast("long")), f"{root}/border", "batch")

    run_available(src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(deal))


def stream_daily_subset(spark: SparkSession, source: str, out: str, checkpoint: str,
                        max_files: int = 2, state: str | None = None,
                        delay_days: int = DELAY_DAYS) -> None:
    """Per-day metrics that follow from sums, kept by a stateful stream; days in any order.

    1. A router deals rows into those whose day may still be in the state and late ones.
    2. The rows of open days go through a watermarked aggregate by day: its state store holds
       the days of the last ``delay_days`` and no others. A day's row in ``<state>/days`` is
       replaced whenever the state's day changes.
    3. Late rows of a batch are folded into ``<state>/folded``, one row a day: the day's state is
       gone, its stored row is not.

    A day's metrics are made of its two rows, so what is stored is bounded by the days.
    Batches that are replayed replace or skip what they wrote. ``state`` defaults to
    ``<out>-state`` and belongs to one checkpoint."""
    root = state or f"{out.rstrip('/')}-state"
    _route(spark, source, root, f"{checkpoint}/route", max_files, delay_days)
    touched_path = f"{root}/days"
    day = T.StructType([*SENTIMENT.fields, T.StructField("batch", T.LongType())])

    def refresh(days: DataFrame) -> None:
        own = days.sparkSession
        parts = _stored(own, touched_path, PART_ROWS).unionByName(
            _stored(own, f"{root}/folded", FOLDED).select(*PART_ROWS.fieldNames()))
        rows = _added(parts.join(days, "localDate", "left_semi"))
        each = ST.sum_metrics() | {"mean_sentiment": F.col("total") / F.col("n")}
        _overwrite(rows.select("localDate", *[each[m].alias(m) for m in STREAMABLE]), out, "localDate")

    def keep(batch: DataFrame, batch_id: int) -> None:
        rows = cut_lineage(batch.select(F.date_add(F.lit(EPOCH).cast("date"), (
            F.unix_seconds("day.start") / 86_400).cast("int")).alias("localDate"), *PARTS))
        _overwrite(rows, touched_path, "localDate")
        refresh(rows.select("localDate"))

    def fold(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy("localDate").agg(*_parts())
        before = _stored(batch.sparkSession, f"{root}/folded", FOLDED)
        both = part.alias("b").join(before.alias("a"), "localDate", "left")
        again, how = F.col("a.batch") >= batch_id, {"high": F.greatest, "low": F.least}
        rows = cut_lineage(both.select("localDate", *[
            F.when(F.col("a.n").isNull(), F.col(f"b.{c}")).when(again, F.col(f"a.{c}"))
            .otherwise(how[c](F.col(f"a.{c}"), F.col(f"b.{c}")) if c in how
                       else F.col(f"a.{c}") + F.col(f"b.{c}")).alias(c) for c in PARTS],
            F.lit(batch_id).cast("long").alias("batch")))
        _overwrite(rows, f"{root}/folded", "localDate")
        refresh(rows.select("localDate"))

    if PQ.exists(spark, f"{root}/open"):
        # the instant at which the date begins in UTC, whatever the session's zone
        ts = F.timestamp_seconds(F.datediff("localDate", F.lit(EPOCH).cast("date")).cast("long") * 86_400)
        events = (spark.readStream.schema(day).parquet(f"{root}/open").withColumn("ts", ts)
                  .withWatermark("ts", f"{delay_days} days")
                  .groupBy(F.window("ts", "1 day").alias("day")).agg(*_parts()))
        run_available(events.writeStream.outputMode("update")
                      .option("checkpointLocation", f"{checkpoint}/days").foreachBatch(keep))
    if PQ.exists(spark, f"{root}/late"):
        late = spark.readStream.schema(day).parquet(f"{root}/late")
        run_available(late.writeStream.option("checkpointLocation", f"{checkpoint}/late")
                      .foreachBatch(fold))


def stream_upsert_rollup(spark: SparkSession, source: str, store: str, out: str,
                         checkpoint: str, max_files: int = 4) -> None:
    """Full 16-metric roll-up kept current from a stream of sentiment rows.

    A micro-batch is reduced to mergeable states of its days (moments, and counts by score for the
    median), which are merged into the stored states of these days; only their partitions are
    read and replaced, in ``store`` and in ``out``. No article is read twice. A replayed batch
    finds its number in the store and merges nothing."""
    src = (spark.readStream.schema(SENTIMENT).option("maxFilesPerTrigger", max_files)
           .parquet(source))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        states, counts = f"{store}/states", f"{store}/counts"
        days = ST.fold_states(ST.daily_states(batch), states, batch_id)
        if days:
            ST.fold_counts(ST.score_counts(batch), counts, batch_id, days)
            _overwrite(ST.stored_metrics(batch.sparkSession, states, counts, days), out, "localDate")

    run_available(src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert))
