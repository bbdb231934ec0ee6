"""Registered ingest, predicate and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import numeric as N
from tidemark.operators import panel as P
from tidemark.operators import rollup as RU
from tidemark.operators import targets as TG
from tidemark.plans import oracle as O
from tidemark.plans.registry import register, rounded
from tidemark.plans.q_news import daily
from tidemark.plans.q_stock import panel_inputs, target_table
from tidemark.sources import fixtures as FX
from tidemark.sources import payloads as PL

USER_NO = "CAST(substr(id, 2) AS BIGINT)"


@register("ingest_stock_json", O.with_(O.BARS_EVENTS) + f"""
SELECT localDate, id, round(close, 6) AS close, round(high, 6) AS high,
       round(low, 6) AS low, round(open, 6) AS open,
       CASE WHEN ({USER_NO} + day(localDate)) % 13 = 0 THEN 0 ELSE volume END AS volume
FROM bars
WHERE NOT ({USER_NO} % 7 = 3 OR {USER_NO} % 19 = 7 OR {USER_NO} % 11 = 5
           OR {USER_NO} % 17 IN (2, 4, 9))""")
def q_ingest_stock_json(spark, sf_dir):
    bars, _ = PL.decode_price_payloads(FX.price_payloads(spark, sf_dir))
    return rounded(bars)


@register("ingest_stock_quarantine", O.with_(O.BARS_EVENTS) + f"""
SELECT id,
       CASE WHEN n % 17 IN (2, 9) THEN NULL WHEN n % 17 = 4 THEN 200
            WHEN n % 7 = 3 THEN 400 ELSE 500 END AS rcode,
       CASE WHEN n % 17 IN (2, 4, 9) THEN NULL WHEN n % 7 = 3 THEN 1001 ELSE 9999 END AS code,
       CASE WHEN n % 17 IN (2, 4, 9) THEN 'undecodable' WHEN n % 7 = 3 THEN 'symbol_not_found'
            ELSE 'failure' END AS reason,
       CASE WHEN n % 17 = 2 THEN '{FX.ERROR_PAGE}' WHEN n % 17 = 4 THEN '{FX.NO_DATA}' END AS payload
FROM (SELECT DISTINCT id, {USER_NO} AS n FROM bars)
WHERE n % 17 IN (2, 4, 9) OR n % 7 = 3 OR n % 19 = 7""")
def q_ingest_stock_quarantine(spark, sf_dir):
    """The payload is shown where SQL can tell it (it is kept for every row)."""
    _, q = PL.decode_price_payloads(FX.price_payloads(spark, sf_dir))
    shown = F.col("payload").isin(FX.ERROR_PAGE, FX.NO_DATA)
    return q.withColumn("payload", F.when(shown, F.col("payload")))


KEPT_ARTICLES = O.with_(O.ARTICLES) + r"""
SELECT localDate, id, title, body FROM articles
WHERE lang IN ('en', 'de') AND doc_id % 17 <> 0 AND doc_id % 23 <> 0 AND doc_id % 29 <> 0
  AND regexp_matches(body, '\S')"""


@register("ingest_news_json", KEPT_ARTICLES)
def q_ingest_news_json(spark, sf_dir):
    return PL.decode_news_payloads(FX.news_payloads(spark, sf_dir))


@register("ingest_news_quarantine", O.with_(O.ARTICLES) + f"""
, landed AS (SELECT DISTINCT localDate, doc_id // 1500 + 1 AS page FROM articles),
days AS (SELECT localDate, max(page) AS n FROM landed GROUP BY localDate),
due AS (SELECT localDate, unnest(range(1, n + CASE WHEN day(localDate) % 10 = 7 THEN 3 ELSE 1 END)) AS page
        FROM days)
SELECT localDate, CAST(n + 1 AS BIGINT) AS page, 'undecodable' AS reason, '{FX.CUT_PAGE}' AS payload
FROM days WHERE day(localDate) % 10 = 3
UNION ALL
SELECT localDate, CAST(page AS BIGINT), 'missing_page', NULL FROM due
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.localDate = due.localDate AND l.page = due.page)""")
def q_ingest_news_quarantine(spark, sf_dir):
    return PL.news_quarantine(FX.news_payloads(spark, sf_dir))


@register("article_filter", "SELECT localDate, id FROM (" + KEPT_ARTICLES + ")")
def q_article_filter(spark, sf_dir):
    return PL.decode_news_payloads(FX.news_payloads(spark, sf_dir)).select("localDate", "id")


@register("clean_numeric", """
SELECT o_orderkey, round(o_totalprice, 6) AS price,
       CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_custkey END AS volume
FROM orders""")
def q_clean_numeric(spark, sf_dir):
    o = FX.table(spark, sf_dir, "orders")
    raw = o.select("o_orderkey",
                   F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("p"),
                   F.when(F.col("o_orderkey") % 10 == 0, F.lit("N/A"))
                    .otherwise(F.format_number("o_custkey", 0)).alias("v"))
    return rounded(raw.select("o_orderkey", N.parse_price(F.col("p")).alias("price"),
                              N.parse_volume(F.col("v")).alias("volume")))


@register("parse_us_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS localDate FROM orders")
def q_parse_us_date(spark, sf_dir):
    o = FX.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", D.parse_us_date(D.format_us_date(F.col("o_orderdate")))
                    .alias("localDate"))


TICKER_SQL = ("CASE WHEN p_partkey % 50 = 7 THEN 'FI' WHEN p_partkey % 50 = 9 THEN 'fi' ELSE upper(substr(split_part(p_name, ' ', 2), 1, 3) || substr(p_name, 1, 1)) || "
              "CASE WHEN p_partkey % 4 = 0 THEN '.B' ELSE '' END END")


@register("symbol_alias", f"""
SELECT p_partkey, symbol,
       CASE WHEN upper(symbol) = 'FI' THEN 'FISV' ELSE replace(symbol, '.', '%25sl%25') END AS api_symbol
FROM (SELECT p_partkey, {TICKER_SQL} AS symbol FROM part)""")
def q_symbol_alias(spark, sf_dir):
    t = FX.tickers(spark, sf_dir)
    return t.select("p_partkey", "symbol", PL.symbol_alias(F.col("symbol")).alias("api_symbol"))


@register("downcast_features", O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES, O.PANEL) + """
SELECT localDate, id, CAST(close AS FLOAT) AS close, CAST(high AS FLOAT) AS high,
       CAST(low AS FLOAT) AS low, CAST(open AS FLOAT) AS open, CAST(volume AS FLOAT) AS volume
FROM panel""")
def q_downcast_features(spark, sf_dir):
    b, s, d = panel_inputs(spark, sf_dir)
    p = P.dense_panel(b, s, d)
    return p.select("localDate", "id", *[N.to_f32(F.col(c)).alias(c) for c in P.BAR_FIELDS])


@register("select_exclude_columns", O.with_(*O.NEWS_CHAIN) + ", " + O.spine_sql(extra_days=1) +
          " SELECT localDate, " + ", ".join(f'"{m}-1" AS {m}_1' for m in O.METRICS) +
          " FROM (" + O.lagged_sql(1) + ")")
def q_select_exclude_columns(spark, sf_dir):
    """Keep the lag-1 block of the lagged table, dropping the other lags, and
    rename '-' / '.' in names to '_'."""
    lagged = RU.lagged_features(daily(spark, sf_dir))
    keep = [c for c in lagged.columns if c == "localDate" or c.endswith("-1")]
    sel = lagged.select(*[F.col(f"`{c}`") for c in keep])
    return rounded(sel.withColumnsRenamed({c: c.replace("-", "_").replace(".", "_")
                                           for c in keep if c != "localDate"}))


@register("symbols_dimension", O.with_(O.BARS_EVENTS, O.SYMBOLS) + "SELECT id, sector, pos FROM symbols")
def q_symbols_dimension(spark, sf_dir):
    """The dimension derived from the bars, replaced as an ordered list and
    loaded back with positions from file order."""
    from tidemark.session import scratch_path
    from tidemark.sources.symbols import load_symbols, replace_symbols
    path = scratch_path(spark, "symbols")
    replace_symbols(FX.symbols_from_bars(FX.bars_events(spark, sf_dir)), path)
    return load_symbols(spark, path)


@register("symbols_after", O.with_(O.BARS_EVENTS, O.SYMBOLS) + """
SELECT id, pos, id = (SELECT arg_max(id, pos) FROM symbols) AS is_last FROM symbols
WHERE pos > coalesce((SELECT max(pos) FROM symbols WHERE id = 'u5'), -1)""")
def q_symbols_after(spark, sf_dir):
    s = FX.symbols_from_bars(FX.bars_events(spark, sf_dir))
    after = P.symbols_after(s, "u5")
    last = P.last_symbol(s).select(F.col("id").alias("_last")).scalar()
    return after.select("id", "pos", (F.col("id") == last).alias("is_last"))


WATCH = " u3, u10 ,,u7,unknown,u3"


@register("watched_symbols", O.with_(O.BARS_EVENTS, O.SYMBOLS) + """
SELECT s.id, CAST(min(w.wpos) AS INTEGER) AS wpos
FROM symbols s JOIN (SELECT trim(x) AS id, i - 1 AS wpos
                     FROM unnest(string_split(' u3, u10 ,,u7,unknown,u3', ',')) WITH ORDINALITY AS t(x, i)) w
  ON s.id = w.id GROUP BY s.id""")
def q_watched_symbols(spark, sf_dir):
    s = FX.symbols_from_bars(FX.bars_events(spark, sf_dir))
    return P.watched_symbols(s, WATCH).select("id", "wpos")


ORDER_DATES = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


@register("pending_dates", f"""
SELECT d AS localDate FROM {ORDER_DATES}
WHERE d > (SELECT max(d) - 60 FROM {ORDER_DATES}) AND d <= (SELECT max(d) - 10 FROM {ORDER_DATES})""")
def q_pending_dates(spark, sf_dir):
    from tidemark.operators.incremental import pending_dates
    raw = FX.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("localDate")).distinct()
    hi = raw.select(F.max("localDate")).scalar()
    return pending_dates(raw, F.date_sub(hi, 60), F.date_sub(hi, 10))


@register("bounded_backfill", f"""
SELECT localDate FROM (
  SELECT d AS localDate, dense_rank() OVER (ORDER BY d) AS r FROM {ORDER_DATES}
  WHERE d > (SELECT max(d) - 60 FROM {ORDER_DATES}) AND d < (SELECT max(d) - 5 FROM {ORDER_DATES}))
WHERE r <= 10""")
def q_bounded_backfill(spark, sf_dir):
    from tidemark.operators.incremental import bounded_backfill, pending_dates
    raw = FX.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("localDate")).distinct()
    hi = raw.select(F.max("localDate")).scalar()
    pend = pending_dates(raw, F.date_sub(hi, 60), hi)
    return bounded_backfill(pend, 10, F.date_sub(hi, 5))


@register("next_weekday", f"""
SELECT d AS localDate, CAST(d + CASE isodow(d) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS next_weekday
FROM {ORDER_DATES}""")
def q_next_weekday(spark, sf_dir):
    o = FX.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("localDate")).distinct()
    return o.select("localDate", D.next_weekday(F.col("localDate")).alias("next_weekday"))


def _nwd_sql(x):
    return f"({x} + CASE isodow({x}) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END)"


@register("inference_dates", f"""
SELECT CAST(d AS DATE) AS localDate FROM (
  SELECT unnest(generate_series({_nwd_sql(f'(SELECT max(d) - 30 FROM {ORDER_DATES})')},
                                {_nwd_sql(f'(SELECT max(d) FROM {ORDER_DATES})')}, INTERVAL 1 DAY)) AS d)
WHERE isodow(d) < 6""")
def q_inference_dates(spark, sf_dir):
    o = FX.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("localDate"))
    hi = o.select(F.max("localDate")).scalar()
    days = D.calendar_days(D.next_weekday(F.date_sub(hi, 30)), D.next_weekday(hi))
    return (spark.range(1).select(F.explode(days).alias("localDate"))
                 .filter(D.is_weekday(F.col("localDate"))))


@register("iso_date_and_paths", f"""
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS iso,
  'inference/localDate=' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '/data.parquet' AS path,
  'model/score=' || printf('%.4f', (o_orderkey % 10000) / 10000.0::DOUBLE) || '/model.keras' AS model_key
FROM orders""")
def q_iso_date_and_paths(spark, sf_dir):
    o = FX.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", D.iso_date(d).alias("iso"),
                    D.partition_path("inference/", d).alias("path"),
                    D.score_key((F.col("o_orderkey") % 10000) / F.lit(10000.0)).alias("model_key"))


ORDER_TARGETS = O.with_(*O.target_chain(O.BARS_ORDERS))


@register("scale_clip_targets", ORDER_TARGETS + """
SELECT localDate, id,
  round(greatest(-10000.0, least(10000.0, log_return_1d * 1000.0)), 6) AS log_return_1d,
  round(greatest(-10000.0, least(10000.0, log_return_3d * 1000.0)), 6) AS log_return_3d,
  round(greatest(-10000.0, least(10000.0, log_return_5d * 1000.0)), 6) AS log_return_5d
FROM targets""")
def q_scale_clip_targets(spark, sf_dir):
    t = target_table(spark, sf_dir, "orders")
    return rounded(t.select("localDate", "id", *[N.scale_clip(F.col(c)).alias(c) for c in
                                                 ("log_return_1d", "log_return_3d", "log_return_5d")]))


@register("unscale_predictions", ORDER_TARGETS + """
SELECT localDate, id,
  round(greatest(-10000.0, least(10000.0, log_return_5d * 1000.0)) * (1.0 / 1000.0), 6) AS log_return_5d
FROM targets""")
def q_unscale_predictions(spark, sf_dir):
    t = target_table(spark, sf_dir, "orders")
    return rounded(t.select("localDate", "id",
                            N.unscale(N.scale_clip(F.col("log_return_5d"))).alias("log_return_5d")))


@register("sign", ORDER_TARGETS + "SELECT localDate, id, CAST(sign(log_return_3d) AS INTEGER) AS sign_3d FROM targets")
def q_sign(spark, sf_dir):
    t = target_table(spark, sf_dir, "orders")
    return t.select("localDate", "id", N.sign(F.col("log_return_3d")).alias("sign_3d"))


@register("safe_log_ratio", O.with_(O.BARS_ORDERS) + """
SELECT localDate, id, round(CASE WHEN open > 0.001 AND close > 0.001 THEN ln(close / open) ELSE 0.0 END, 6) AS lr
FROM bars""")
def q_safe_log_ratio(spark, sf_dir):
    b = FX.bars_orders(spark, sf_dir)
    return rounded(b.select("localDate", "id",
                            TG.safe_log_ratio(F.col("close"), F.col("open")).alias("lr")))
