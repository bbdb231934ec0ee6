"""Registered report queries: latest dates, as-of lookups, trailing
windows, top gainers, predicted vs actual, accuracy and the report body."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators import asof as AO
from tidemark.operators import dataset as DS
from tidemark.operators import panel as P
from tidemark.operators import report as RP
from tidemark.operators import reshape as RS
from tidemark.operators import targets as TG
from tidemark.plans import oracle as O
from tidemark.plans.q_stock import panel_inputs
from tidemark.plans.registry import register, rounded
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources import parquet as PQ

EV = O.with_(*O.target_chain(O.BARS_EVENTS), O.PREDS_FIXED)
EVP = O.with_(*O.target_chain(O.BARS_EVENTS), O.PREDS_FIXED, O.PVA)
HEADS = C.INFERENCE_METRICS


def event_preds(spark, sf_dir):
    """(predictions, actual targets, symbols) on the events panel."""
    b, s, d = panel_inputs(spark, sf_dir, "events")
    # predictions and actuals both derive from the targets, which the report
    # reads several times: they are materialised once
    t = cut_lineage(TG.daily_targets(P.dense_panel(b, s, d)))
    return RS.previous_day_predictions(t), t, s, d


@register("latest_two_partitions", EV + """
SELECT localDate, CAST(r AS INTEGER) AS date_rank FROM (
  SELECT localDate, dense_rank() OVER (ORDER BY localDate DESC) AS r
  FROM (SELECT DISTINCT localDate FROM preds)) WHERE r <= 2""")
def q_latest_two(spark, sf_dir):
    p, *_ = event_preds(spark, sf_dir)
    return RP.latest_two_dates(p)


@register("top_gainers", EV + """
SELECT symbol, round(log_return_1d, 6) AS log_return_1d FROM preds
WHERE localDate = (SELECT max(localDate) FROM preds)
ORDER BY log_return_1d DESC, symbol LIMIT 10""")
def q_top_gainers(spark, sf_dir):
    p, *_ = event_preds(spark, sf_dir)
    latest = p.select(F.max("localDate")).scalar()
    return rounded(RP.top_gainers(p.filter(F.col("localDate") == latest))
                   .select("symbol", "log_return_1d"))


QDATES = """qd AS (
  SELECT CAST(d AS DATE) AS query_date FROM (
    SELECT unnest(generate_series((SELECT min(localDate) FROM tdates) + 14,
                                  (SELECT max(localDate) FROM tdates) + 3, INTERVAL 1 DAY)) AS d)
  WHERE isodow(d) < 6)"""


def query_dates(spark, trading, skip: int = 14):
    """Weekdays from ``skip`` days after the first trading date to three days
    after the last one (the span grows with the data)."""
    b = trading.agg(F.date_add(F.min("localDate"), skip).alias("lo"),
                    F.date_add(F.max("localDate"), 3).alias("hi"))
    return (b.select(F.explode(F.sequence("lo", "hi")).alias("query_date"))
             .filter(F.weekday("query_date") < 5))


@register("latest_k_dates", O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES, QDATES) + """
SELECT query_date, CAST(k AS INTEGER) AS k, localDate FROM (
  SELECT q.query_date, t.localDate,
         row_number() OVER (PARTITION BY q.query_date ORDER BY t.localDate DESC) - 1 AS k
  FROM qd q JOIN tdates t ON t.localDate < q.query_date) WHERE k < 5""")
def q_latest_k_dates(spark, sf_dir):
    _, _, d = panel_inputs(spark, sf_dir, "events")
    return AO.latest_before(query_dates(spark, d), d, count=5)


@register("asof_latest_before", O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES, QDATES) + """
SELECT q.query_date, max(t.localDate) AS localDate
FROM qd q JOIN tdates t ON t.localDate < q.query_date GROUP BY q.query_date""")
def q_asof_latest_before(spark, sf_dir):
    _, _, d = panel_inputs(spark, sf_dir, "events")
    return AO.latest_before(query_dates(spark, d), d, count=1).select("query_date", "localDate")


@register("trailing_window", O.with_(O.BARS_ORDERS, O.TDATES_ANY, QDATES) + """,
ends AS (SELECT end_date FROM (
           SELECT DISTINCT (SELECT max(localDate) FROM tdates t WHERE t.localDate < q.query_date) AS end_date
           FROM qd q)
         WHERE (SELECT count(*) FROM tdates t WHERE t.localDate <= end_date) >= 30)
SELECT end_date, CAST(29 - k AS INTEGER) AS step, localDate FROM (
  SELECT e.end_date, t.localDate,
         row_number() OVER (PARTITION BY e.end_date ORDER BY t.localDate DESC) - 1 AS k
  FROM ends e JOIN tdates t ON t.localDate <= e.end_date) WHERE k < 30""")
def q_trailing_window(spark, sf_dir):
    _, _, d = panel_inputs(spark, sf_dir, "orders")
    ends = AO.latest_before(query_dates(spark, d), d, count=1).select("localDate").distinct()
    # every end date with a full window, however early
    full = AO.index_dates(d).where(F.col("t") >= C.WINDOW_SIZE - 1)
    ends = ends.join(full, "localDate", "left_semi").withColumnRenamed("localDate", "end_date")
    return AO.trailing_window(ends, d, C.WINDOW_SIZE)


@register("sorted_listing", EV + """
SELECT 'localDate=' || strftime(localDate, '%Y-%m-%d') AS key,
       CAST(row_number() OVER (ORDER BY localDate DESC) AS INTEGER) AS position
FROM (SELECT DISTINCT localDate FROM preds)""")
def q_sorted_listing(spark, sf_dir):
    """Partition keys under a prefix, newest first, from a file listing."""
    from pyspark.sql import Window
    p, *_ = event_preds(spark, sf_dir)
    path = scratch_path(spark, "inference")
    PQ.write_partitions(p.select("localDate", "symbol", *[F.col(h).cast("float") for h in HEADS]), path)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path).select("path"))
    keys = files.select(F.regexp_extract("path", r"(localDate=[^/]+)/", 1).alias("key")).distinct()
    return keys.withColumn("position", F.row_number().over(Window.orderBy(F.col("key").desc())))


@register("predicted_vs_actual", EVP + """
SELECT localDate, symbol, round(zscore_1d_p, 6) AS zscore_1d_p, round(zscore_1d_a, 6) AS zscore_1d_a,
       round(log_return_1d_p, 6) AS log_return_1d_p, round(log_return_1d_a, 6) AS log_return_1d_a
FROM pva""")
def q_predicted_vs_actual(spark, sf_dir):
    p, t, *_ = event_preds(spark, sf_dir)
    return rounded(RP.predicted_vs_actual(p, t).select(
        "localDate", "symbol", "zscore_1d_p", "zscore_1d_a", "log_return_1d_p", "log_return_1d_a"))


@register("directional_accuracy", EVP + """
SELECT localDate, count(*) FILTER (WHERE log_return_1d_p * log_return_1d_a > 0) AS correct,
       count(*) AS total FROM pva GROUP BY localDate""")
def q_directional_accuracy(spark, sf_dir):
    p, t, *_ = event_preds(spark, sf_dir)
    return RP.directional_accuracy(RP.predicted_vs_actual(p, t))


@register("top_gainers_hit_rate", EV + """
SELECT localDate, count(*) FILTER (WHERE a > 0) AS hits FROM (
  SELECT p.localDate, p.symbol, t.log_return_1d AS a,
         row_number() OVER (PARTITION BY p.localDate ORDER BY p.log_return_1d DESC, p.symbol) AS r
  FROM preds p LEFT JOIN targets t ON t.localDate = p.localDate AND t.id = p.symbol)
WHERE r <= 10 GROUP BY localDate""")
def q_top_gainers_hit_rate(spark, sf_dir):
    p, t, s, _ = event_preds(spark, sf_dir)
    return RP.top_gainers_hit_rate(p, t, C.TOP_GAINERS_COUNT)


TARGET_METRICS = ("log_return_1d", "log_return_3d", "log_return_5d",
                  "zscore_1d", "rank_1d", "direction_1d")


@register("actual_lookup", O.with_(*O.target_chain(O.BARS_ORDERS)) + """,
d2 AS (SELECT localDate FROM (SELECT localDate, dense_rank() OVER (ORDER BY localDate DESC) AS r
       FROM (SELECT DISTINCT localDate FROM targets)) WHERE r = 2)
""" + " UNION ALL ".join(
    f"SELECT id AS symbol, '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value FROM targets "
    f"WHERE localDate = (SELECT localDate FROM d2)" for m in TARGET_METRICS))
def q_actual_lookup(spark, sf_dir):
    """Target row of one date from stored wide parts (newest part wins);
    fails when the date is absent."""
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    t = TG.daily_targets(P.dense_panel(b, s, d))
    wide = RS.wide_table(t, s, TARGET_METRICS)
    path = scratch_path(spark, "target")
    PQ.append_run(wide, path, "20240101T000000")
    newest = wide.select(F.max("localDate")).scalar()
    recent = wide.filter(F.col("localDate") > F.date_sub(newest, 20))     # a newer, overlapping part
    PQ.append_run(recent, path, "20240102T000000")
    stored = DS.dedupe_keep_last(PQ.read_runs(spark, path), "localDate")
    day = RP.report_dates(stored)[1]
    return rounded(RS.unpivot_wide(RP.actual_row(stored, day)).select("symbol", "metric", "value"))


WATCH = " u1 , u2,u3,u10, nosuch"

WATCH_SQL = """w AS (SELECT trim(x) AS symbol, i - 1 AS wpos
  FROM unnest(string_split(' u1 , u2,u3,u10, nosuch', ',')) WITH ORDINALITY AS t(x, i)
  WHERE trim(x) <> '')"""

D1 = "(SELECT max(localDate) FROM preds)"
D2 = "(SELECT max(localDate) FROM preds WHERE localDate < (SELECT max(localDate) FROM preds))"

PRED_LINE = ("printf('%-6s %+.3f %+.3f %.2f %+.5f %+.5f %+.5f', p.symbol, p.zscore_1d, p.rank_1d, "
             "p.direction_1d, p.log_return_1d, p.log_return_3d, p.log_return_5d)")
CMP_LINE = ("printf('%-6s %+.3f %+.3f %+.3f %+.3f ', x.symbol, zscore_1d_p, zscore_1d_a, rank_1d_p, "
            "rank_1d_a) || ' ' || CAST(CAST(direction_1d_p >= 0.5 AS INTEGER) AS VARCHAR) || ' ' || ' ' || "
            "' ' || CAST(CAST(direction_1d_a AS INTEGER) AS VARCHAR) || ' ' || ' ' || "
            "printf('%+.5f %+.5f %+.5f %+.5f %+.5f %+.5f', log_return_1d_p, log_return_1d_a, "
            "log_return_3d_p, log_return_3d_a, log_return_5d_p, log_return_5d_a)")

LINES_SQL = EVP + ", " + WATCH_SQL + f""",
l1 AS (SELECT w.wpos, {PRED_LINE} AS line FROM preds p JOIN (SELECT symbol, min(wpos) AS wpos FROM w GROUP BY symbol) w
       ON w.symbol = p.symbol WHERE p.localDate = {D1}),
l2 AS (SELECT w.wpos, {CMP_LINE} AS line FROM pva x JOIN (SELECT symbol, min(wpos) AS wpos FROM w GROUP BY symbol) w
       ON w.symbol = x.symbol WHERE x.localDate = {D2})"""


@register("report_lines", LINES_SQL + """
SELECT 'prediction' AS kind, CAST(wpos AS INTEGER) AS wpos, line FROM l1
UNION ALL SELECT 'comparison', CAST(wpos AS INTEGER), line FROM l2""")
def q_report_lines(spark, sf_dir):
    p, t, s, _ = event_preds(spark, sf_dir)
    w = P.watched_symbols(s, WATCH).select(F.col("id").alias("symbol"), "wpos")
    L, Pd = (F.lit(x) for x in RP.report_dates(p))
    l1 = (p.filter(F.col("localDate") == L).join(w, "symbol")
           .select(F.lit("prediction").alias("kind"), "wpos",
                   RP.prediction_line(F.col("symbol"), {h: F.col(h) for h in HEADS}).alias("line")))
    pva = RP.predicted_vs_actual(p.filter(F.col("localDate") == Pd), t.filter(F.col("localDate") == Pd))
    l2 = (pva.join(w, "symbol")
             .select(F.lit("comparison").alias("kind"), "wpos",
                     RP.comparison_line(F.col("symbol"), {h: F.col(f"{h}_p") for h in HEADS},
                                        {h: F.col(f"{h}_a") for h in HEADS}).alias("line")))
    return l1.unionByName(l2)


@register("notification_report", LINES_SQL + f"""
SELECT {D1} AS latest, {D2} AS previous,
  strftime({D1}, '%Y-%m-%d') || ' prediction' || chr(10) || 'Watched symbols' || chr(10) ||
  coalesce((SELECT string_agg(line, chr(10) ORDER BY wpos) FROM l1), '') || chr(10) || '' || chr(10) ||
  strftime({D2}, '%Y-%m-%d') || ' predicted vs actual' || chr(10) || 'Watched symbols' || chr(10) ||
  '{RP.COMPARISON_HEADER}' || chr(10) ||
  coalesce((SELECT string_agg(line, chr(10) ORDER BY wpos) FROM l2), '') || chr(10) || '' AS body""")
def q_notification_report(spark, sf_dir):
    p, t, s, _ = event_preds(spark, sf_dir)
    return RP.report_body(p, t, P.watched_symbols(s, WATCH))
