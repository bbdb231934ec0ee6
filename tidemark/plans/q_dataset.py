"""Registered dataset and reshape queries (alignment, windows, split,
batches, set operations, pivots)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators import dataset as DS
from tidemark.operators import panel as P
from tidemark.operators import reshape as RS
from tidemark.operators import rollup as RU
from tidemark.operators import targets as TG
from tidemark.plans import oracle as O
from tidemark.plans.q_news import daily
from tidemark.plans.q_stock import panel_inputs
from tidemark.plans.registry import register, rounded
from tidemark.session import store
from tidemark.sources import fixtures as FX

TARGET_METRICS = ("log_return_1d", "log_return_3d", "log_return_5d",
                  "zscore_1d", "rank_1d", "direction_1d")


def dataset(spark, sf_dir, source="orders"):
    """(panel, targets, lagged, aligned dates, symbols) for a bar source; the
    lag table spans the panel's dates. Targets and lag table are stored once, and what only
    asks for dates scans their date columns."""
    b, s, d = panel_inputs(spark, sf_dir, source)
    panel = P.dense_panel(b, s, d)
    lo = d.select(F.min("localDate")).scalar()
    hi = d.select(F.date_add(F.max("localDate"), 1)).scalar()
    targets = store(TG.daily_targets(panel), "targets")
    lagged = store(RU.lagged_features(daily(spark, sf_dir, source=source), start=lo, end=hi), "lagged")
    aligned = DS.common_dates(panel, lagged, targets)
    return panel, targets, lagged, aligned, s


def events_tables(spark, sf_dir):
    """(panel, targets, lagged) of the events, as stored tables; the lag table spans the
    articles' own days and the one after."""
    b, s, d = panel_inputs(spark, sf_dir, "events")
    panel = P.dense_panel(b, s, d)
    lagged = RU.lagged_features(daily(spark, sf_dir))
    return panel, store(TG.daily_targets(panel), "targets"), store(lagged, "lagged")


EVENTS_NEWS = (O.target_chain(O.BARS_EVENTS) + O.NEWS_CHAIN[:] +
               [O.spine_sql(extra_days=1)])


@register("align_dates", O.with_(*EVENTS_NEWS) + """
SELECT localDate FROM tdates WHERE localDate IN (SELECT localDate FROM spine)
  AND localDate IN (SELECT localDate FROM targets)""")
def q_align_dates(spark, sf_dir):
    panel, targets, lagged = events_tables(spark, sf_dir)
    return DS.common_dates(panel, lagged, targets)


@register("intersect_dates", O.with_(*EVENTS_NEWS) + """
SELECT localDate FROM tdates INTERSECT SELECT localDate FROM spine
INTERSECT SELECT localDate FROM targets""")
def q_intersect_dates(spark, sf_dir):
    panel, targets, lagged = events_tables(spark, sf_dir)
    return DS.intersect_dates(panel, lagged, targets)


@register("alignment_check", O.with_(*EVENTS_NEWS) + """
SELECT count(*) FILTER (WHERE a AND b AND c) AS aligned_dates,
       count(*) FILTER (WHERE NOT (a AND b AND c)) AS unaligned_dates
FROM (SELECT localDate, bool_or(k = 0) AS a, bool_or(k = 1) AS b, bool_or(k = 2) AS c
      FROM (SELECT localDate, 0 AS k FROM panel UNION ALL SELECT localDate, 1 FROM spine
            UNION ALL SELECT localDate, 2 FROM targets) GROUP BY localDate)""")
def q_alignment_check(spark, sf_dir):
    panel, targets, lagged = events_tables(spark, sf_dir)
    return DS.alignment_report(panel, lagged, targets, check=True)


ORD = O.with_(*O.orders_dataset_chain())


@register("chrono_split", ORD + """
SELECT localDate, 'train' AS split FROM idx WHERE t < n - CAST(floor(n * 0.2) AS BIGINT)
UNION ALL
SELECT localDate, 'validation' AS split FROM idx WHERE t >= n - CAST(floor(n * 0.2) AS BIGINT) - 30""")
def q_chrono_split(spark, sf_dir):
    *_, aligned, _ = dataset(spark, sf_dir)
    return DS.chrono_split(DS.date_index(aligned), C.WINDOW_SIZE).select("localDate", "split")


@register("sliding_windows", ORD + """, pl AS (
  SELECT p.*, i.t FROM panel p JOIN idx i USING (localDate))
SELECT a.localDate, a.id, CAST(f.t - a.t + 30 AS INTEGER) AS k, f.localDate AS date,
       round(f.close, 6) AS close, round(f.high, 6) AS high, round(f.low, 6) AS low,
       round(f.open, 6) AS open, f.volume
FROM pl a JOIN pl f ON f.id = a.id AND f.t >= a.t - 30 AND f.t < a.t
WHERE a.t >= 30""")
def q_sliding_windows(spark, sf_dir):
    panel, _, _, aligned, _ = dataset(spark, sf_dir)
    (p,) = DS.align(aligned, panel)
    w = DS.sliding_windows(p, C.WINDOW_SIZE, index=DS.date_index(aligned))
    e = w.select("localDate", "id", F.posexplode("window").alias("k", "r"))
    return rounded(e.select("localDate", "id", "k", F.col("r.date").alias("date"),
                            *[F.col(f"r.{f}").alias(f) for f in DS.FEATURES]))


@register("news_windows", O.with_(*O.samples_chain()) + """
, news AS (SELECT i.t, i.localDate, k, coalesce(d.n, 0) AS articles, coalesce(d.m, 0.0) AS mean
           FROM idx i CROSS JOIN range(1, 6) r(k)
           LEFT JOIN days d ON d.localDate + CAST(k AS INTEGER) = i.localDate)
SELECT a.localDate, CAST(f.t - a.t + 30 AS INTEGER) AS step, f.localDate AS date,
       CAST(f.k AS INTEGER) AS lag, CAST(f.articles AS DOUBLE) AS count_articles,
       round(f.mean, 6) AS mean_sentiment
FROM idx a JOIN news f ON f.t >= a.t - 30 AND f.t < a.t WHERE a.t >= 30""")
def q_news_windows(spark, sf_dir):
    """The news half of a sample: 30 rows of 5 lags x 16 metrics, of which two
    metrics are shown."""
    _, _, lagged, aligned, _ = dataset(spark, sf_dir)
    w = DS.news_windows(lagged, DS.date_index(aligned), C.WINDOW_SIZE)
    e = w.select("localDate", F.posexplode("news_window").alias("step", "r"))
    each = e.select("localDate", "step", F.col("r.date").alias("date"), F.explode(
        F.transform(F.sequence(F.lit(1), F.lit(C.LAG_DAYS)), lambda k: F.struct(
            k.alias("lag"), F.get(F.col("r.values"), (k - 1) * 16).alias("count_articles"),
            F.get(F.col("r.values"), (k - 1) * 16 + 1).alias("mean_sentiment")))).alias("v"))
    return rounded(each.select("localDate", "step", "date", "v.*"))


@register("window_tensor", ORD + """, pl AS (
  SELECT p.*, i.t FROM panel p JOIN idx i USING (localDate))
SELECT a.localDate, CAST(f.t - a.t + 30 AS INTEGER) AS step, a.pos AS sym,
       round(f.close, 6) AS close, round(f.high, 6) AS high, round(f.low, 6) AS low,
       round(f.open, 6) AS open, round(CAST(f.volume AS DOUBLE), 6) AS volume
FROM pl a JOIN pl f ON f.id = a.id AND f.t >= a.t - 30 AND f.t < a.t
WHERE a.t >= 30""")
def q_window_tensor(spark, sf_dir):
    panel, _, _, aligned, symbols = dataset(spark, sf_dir)
    (p,) = DS.align(aligned, panel)
    tens = RS.window_tensor(p, DS.date_index(aligned), C.WINDOW_SIZE)
    steps = tens.select("localDate", "block", F.posexplode("tensor").alias("step", "syms"))
    cells = steps.select("localDate", "block", "step", F.posexplode("syms").alias("sym", "v"))
    return rounded(cells.select("localDate", "step", (F.col("sym") + F.col("block") * C.SYMBOL_BLOCK).cast("int").alias("sym"),
                                *[F.col("v")[i].alias(f) for i, f in enumerate(DS.FEATURES)]))


@register("batch_assign_drop_remainder", ORD + """, s AS (
  SELECT localDate, row_number() OVER (ORDER BY localDate) - 1 AS r FROM idx
  WHERE t >= 30 AND t < n - CAST(floor(n * 0.2) AS BIGINT))
SELECT localDate, CAST(floor(r / 32) AS BIGINT) AS batch FROM s
WHERE floor(r / 32) < (SELECT count(*) FROM s) // 32""")
def q_batches(spark, sf_dir):
    *_, aligned, _ = dataset(spark, sf_dir)
    idx = DS.date_index(aligned)
    split = DS.chrono_split(idx, C.WINDOW_SIZE)
    train = split.filter((F.col("split") == "train") & (F.col("t") >= C.WINDOW_SIZE))
    return DS.assign_batches(train.select("localDate"), C.BATCH_SIZE).select("localDate", "batch")


@register("pivot_features", O.with_(*O.target_chain(O.BARS_ORDERS)) +
          "SELECT * FROM (" + O.pivot_sql("panel", ("close", "high", "low", "open", "volume")) + ")")
def q_pivot_features(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    return rounded(RS.wide_table(P.dense_panel(b, s, d), s, DS.FEATURES))


@register("pivot_targets", O.with_(*O.target_chain(O.BARS_ORDERS)) + "SELECT localDate, " + ", ".join(
    (f'round("{s}_{m}", 6) AS "{s}_{m}"' if m != "direction_1d" else f'"{s}_{m}"')
    for s in O.ORDER_SYMBOLS for m in TARGET_METRICS) +
    " FROM (" + O.pivot_sql("targets", TARGET_METRICS) + ")")
def q_pivot_targets(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    t = TG.daily_targets(P.dense_panel(b, s, d))
    return rounded(RS.wide_table(t, s, TARGET_METRICS))


@register("unpivot_targets", O.with_(*O.target_chain(O.BARS_ORDERS)) + " UNION ALL ".join(
    f"SELECT localDate, id AS symbol, '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value FROM targets"
    for m in TARGET_METRICS))
def q_unpivot_targets(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    t = TG.daily_targets(P.dense_panel(b, s, d))
    return rounded(RS.unpivot_wide(RS.wide_table(t, s, TARGET_METRICS)))


PRED_FIXED = """preds AS (
  SELECT * FROM (
    SELECT localDate, id AS symbol, pos,
      lag(CAST(zscore_1d AS DOUBLE)) OVER w AS zscore_1d, lag(CAST(rank_1d AS DOUBLE)) OVER w AS rank_1d,
      lag(CAST(direction_1d AS DOUBLE)) OVER w AS direction_1d,
      lag(CAST(log_return_1d AS DOUBLE)) OVER w AS log_return_1d,
      lag(CAST(log_return_3d AS DOUBLE)) OVER w AS log_return_3d,
      lag(CAST(log_return_5d AS DOUBLE)) OVER w AS log_return_5d
    FROM targets WINDOW w AS (PARTITION BY id ORDER BY localDate))
  WHERE zscore_1d IS NOT NULL)"""


@register("unpack_predictions", O.with_(*O.target_chain(O.BARS_ORDERS), PRED_FIXED) + """
SELECT localDate, symbol, round(zscore_1d, 6) AS zscore_1d, round(rank_1d, 6) AS rank_1d,
       round(direction_1d, 6) AS direction_1d, round(log_return_1d, 6) AS log_return_1d,
       round(log_return_3d, 6) AS log_return_3d, round(log_return_5d, 6) AS log_return_5d
FROM preds""")
def q_unpack_predictions(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    preds = RS.previous_day_predictions(TG.daily_targets(P.dense_panel(b, s, d)))
    return rounded(RS.unpack_predictions(RS.pack_predictions(preds)))


@register("wide_schema_builder", O.with_(O.BARS_ORDERS, O.SYMBOLS) + """
SELECT 0 AS col_index, 'localDate' AS name
UNION ALL
SELECT CAST(s.pos * 5 + f.i AS BIGINT) AS col_index, s.id || '_' || f.name AS name
FROM symbols s CROSS JOIN (VALUES (1, 'close'), (2, 'high'), (3, 'low'), (4, 'open'),
                                  (5, 'volume')) f(i, name)""")
def q_wide_schema_builder(spark, sf_dir):
    """Generated column list of the wide feature table, from the symbol
    dimension (computed as a DataFrame, not on the driver)."""
    s = FX.symbols_from_bars(FX.bars_orders(spark, sf_dir))
    feats = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(f).alias("f"))
                      for i, f in enumerate(DS.FEATURES)])
    cols = s.select("pos", "id", F.explode(feats).alias("x")).select(
        (F.col("pos") * len(DS.FEATURES) + F.col("x.i")).cast("long").alias("col_index"),
        F.concat("id", F.lit("_"), "x.f").alias("name"))
    head = spark.range(1).select(F.lit(0).cast("long").alias("col_index"),
                                 F.lit("localDate").alias("name"))
    return head.unionByName(cols)


@register("mean_over_symbols", O.with_(*O.target_chain(O.BARS_ORDERS)) + """
SELECT localDate, round(avg(close), 6) AS mean_close, round(avg(high), 6) AS mean_high,
       round(avg(low), 6) AS mean_low, round(avg(open), 6) AS mean_open,
       round(avg(CAST(volume AS DOUBLE)), 6) AS mean_volume
FROM panel GROUP BY localDate""")
def q_mean_over_symbols(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    return rounded(RS.mean_over_symbols(P.dense_panel(b, s, d)))


@register("union_strict", O.with_(*O.target_chain(O.BARS_ORDERS)) + """
SELECT localDate, id, round(log_return_1d, 6) AS log_return_1d, direction_1d FROM targets""")
def q_union_strict(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir, "orders")
    t = TG.daily_targets(P.dense_panel(b, s, d)).select("localDate", "id", "log_return_1d",
                                                        "direction_1d")
    cut = F.lit("1998-01-01").cast("date")
    return rounded(DS.union_strict(t.filter(F.col("localDate") < cut),
                                   t.filter(F.col("localDate") >= cut)))


@register("unprocessed_dates", O.with_(O.ARTICLES) + """
SELECT DISTINCT localDate FROM articles EXCEPT
SELECT DISTINCT localDate FROM articles WHERE localDate <= DATE '2024-01-20'""")
def q_unprocessed_dates(spark, sf_dir):
    raw = FX.articles(spark, sf_dir).select("localDate")
    processed = raw.filter(F.col("localDate") <= F.lit("2024-01-20").cast("date"))
    return DS.unprocessed_dates(raw, processed)
