"""DuckDB SQL building blocks mirroring ``tidemark.sources.fixtures`` and the
operators; composed into one oracle statement per registered query."""

from __future__ import annotations


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BARS_EVENTS = """bars AS (
  SELECT CAST(ts AS DATE) AS localDate, 'u' || CAST(user_id AS VARCHAR) AS id,
         arg_max(value, (ts, event_id)) AS close, max(value) AS high,
         min(value) AS low, arg_min(value, (ts, event_id)) AS open,
         count(*) AS volume
  FROM events GROUP BY ALL)"""

BARS_ORDERS = """bars AS (
  SELECT CAST(o_orderdate AS DATE) AS localDate, 'P' || left(o_orderpriority, 1) AS id,
         arg_max(o_totalprice, o_orderkey) AS close, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_min(o_totalprice, o_orderkey) AS open,
         count(*) AS volume
  FROM orders GROUP BY ALL)"""

SYMBOLS = """symbols AS (
  SELECT id, left(id, 1) AS sector,
         CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS pos
  FROM (SELECT DISTINCT id FROM bars))"""

TDATES = """tdates AS (
  SELECT DISTINCT b.localDate FROM bars b JOIN symbols s ON b.id = s.id WHERE s.pos = 0)"""

# The orders fixture treats every order date as a trading day (gate "any").
TDATES_ANY = """tdates AS (SELECT DISTINCT localDate FROM bars)"""

PANEL = """panel AS (
  SELECT d.localDate, s.id, s.pos,
         coalesce(b.close, 0.0) AS close, coalesce(b.high, 0.0) AS high,
         coalesce(b.low, 0.0) AS low, coalesce(b.open, 0.0) AS open,
         CAST(coalesce(b.volume, 0) AS BIGINT) AS volume
  FROM tdates d CROSS JOIN symbols s
  LEFT JOIN bars b ON b.localDate = d.localDate AND b.id = s.id)"""

RETURNS = """lr AS (
  SELECT *,
    CAST(CAST(CASE WHEN p1 > 0.001 AND c > 0.001 THEN ln(c / p1) ELSE 0.0 END AS FLOAT) AS DOUBLE)
      AS log_return_1d,
    CAST(CAST(CASE WHEN p3 > 0.001 AND c > 0.001 THEN ln(c / p3) ELSE 0.0 END AS FLOAT) AS DOUBLE)
      AS log_return_3d,
    CAST(CAST(CASE WHEN p5 > 0.001 AND c > 0.001 THEN ln(c / p5) ELSE 0.0 END AS FLOAT) AS DOUBLE)
      AS log_return_5d
  FROM (SELECT *, CAST(CAST(close AS FLOAT) AS DOUBLE) AS c,
          lag(CAST(CAST(close AS FLOAT) AS DOUBLE), 1) OVER w AS p1,
          lag(CAST(CAST(close AS FLOAT) AS DOUBLE), 3) OVER w AS p3,
          lag(CAST(CAST(close AS FLOAT) AS DOUBLE), 5) OVER w AS p5
        FROM panel WINDOW w AS (PARTITION BY id ORDER BY localDate)))"""

XSTATS = """xstats AS (
  SELECT localDate, avg(log_return_1d) AS mean_1d, stddev_pop(log_return_1d) AS std_1d,
         count(*) AS n_symbols
  FROM lr GROUP BY localDate)"""

TARGETS = """targets AS (
  SELECT lr.localDate, lr.id, lr.pos, log_return_1d, log_return_3d, log_return_5d,
    CASE WHEN std_1d > 0 THEN (log_return_1d - mean_1d) / std_1d ELSE 0.0 END AS zscore_1d,
    (row_number() OVER (PARTITION BY lr.localDate ORDER BY log_return_1d, pos) - 1)
      / greatest(n_symbols - 1, 1) AS rank_1d,
    CAST(log_return_1d > 0 AS INTEGER) AS direction_1d
  FROM lr JOIN xstats USING (localDate))"""


def target_chain(bars: str = BARS_EVENTS) -> list[str]:
    gate = TDATES_ANY if bars is BARS_ORDERS else TDATES
    return [bars, SYMBOLS, gate, PANEL, RETURNS, XSTATS, TARGETS]


ARTICLES = """articles AS (
  SELECT CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS localDate,
         CAST(doc_id AS VARCHAR) AS id,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1)
              ELSE text END AS title,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1)
              ELSE '' END AS body,
         doc_id, lang
  FROM documents WHERE doc_id % 30 NOT IN (6, 13))"""

ARTICLES_ORDERS = """articles AS (
  SELECT CAST(DATE '1995-01-01' + CAST(doc_id % 2400 AS INTEGER) AS DATE) AS localDate,
         CAST(doc_id AS VARCHAR) AS id,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1)
              ELSE text END AS title,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1)
              ELSE '' END AS body,
         doc_id, lang
  FROM documents)"""

CLEANED = r"""cleaned AS (
  SELECT localDate, id, doc_id,
         trim(regexp_replace(regexp_replace(coalesce(title, '') || coalesce(body, ''),
              '[^A-Za-z0-9\p{P}\p{Sc}\s]', '', 'g'), '\s+', ' ', 'g')) AS t
  FROM articles)"""

SENTIMENT_FIXED = r"""sentiment AS (
  SELECT localDate, id,
         CAST(CAST(((doc_id * 7919) % 2001 - 1000) / CAST(1000.0 AS DOUBLE) AS FLOAT) AS DOUBLE) AS s,
         CAST(length(t) AS DOUBLE) AS L,
         least(len(regexp_extract_all(t, '\w+|[^\w\s]')) + 2, 512) AS token_count
  FROM cleaned)"""


def f32(x: float) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


DAILY = f"""mom AS (
  SELECT localDate, avg(s) AS m, var_pop(s) AS v FROM sentiment GROUP BY localDate),
daily AS (
  SELECT x.localDate,
    count(*) AS count_articles,
    avg(s) AS mean_sentiment,
    median(s) AS median_sentiment,
    avg(CAST(s > 0 AS DOUBLE)) AS pct_positive,
    avg(CAST(s < 0 AS DOUBLE)) AS pct_negative,
    avg(CAST(s > 0 AS DOUBLE)) - avg(CAST(s < 0 AS DOUBLE)) AS polarity_ratio,
    sum(s * L) / (sum(L) + 1e-9) AS weighted_mean_sentiment,
    avg(CAST(abs(s) > {f32(0.5)} AS DOUBLE)) AS extreme_sentiment_share,
    CASE WHEN count(*) < 3 OR v = 0 THEN 0.0
         ELSE avg(pow(s - m, 3)) / pow(v, 1.5) END AS sentiment_skewness,
    CASE WHEN count(*) < 4 OR v = 0 THEN 0.0
         ELSE avg(pow(s - m, 4)) / pow(v, 2) - 3 END AS sentiment_kurtosis,
    avg(CAST(abs(s) < {f32(0.1)} AS DOUBLE)) AS neutral_share,
    max(s) AS max_sentiment,
    min(s) AS min_sentiment,
    var_pop(L) AS article_length_variance,
    avg(CAST(s > 0 AS DOUBLE)) / (avg(CAST(s < 0 AS DOUBLE)) + 1e-9) AS ratio_pos_neg,
    avg(CAST(abs(s) >= {f32(0.05)} AND abs(s) <= {f32(0.15)} AS DOUBLE)) AS conflict_share
  FROM sentiment x JOIN mom USING (localDate)
  GROUP BY x.localDate, m, v)"""

NEWS_CHAIN = [ARTICLES, CLEANED, SENTIMENT_FIXED, DAILY]

METRICS = ("count_articles", "mean_sentiment", "median_sentiment", "pct_positive",
           "pct_negative", "polarity_ratio", "weighted_mean_sentiment",
           "extreme_sentiment_share", "sentiment_skewness", "sentiment_kurtosis",
           "neutral_share", "max_sentiment", "min_sentiment",
           "article_length_variance", "ratio_pos_neg", "conflict_share")


def spine_sql(src: str = "daily", extra_days: int = 0) -> str:
    return f"""spine AS (
  SELECT CAST(d AS DATE) AS localDate FROM (
    SELECT unnest(generate_series((SELECT min(localDate) FROM {src}),
                                  (SELECT max(localDate) FROM {src}) + {extra_days},
                                  INTERVAL 1 DAY)) AS d))"""


def lagged_sql(lag_days: int = 5) -> str:
    cols, joins = [], []
    for k in range(1, lag_days + 1):
        joins.append(f"LEFT JOIN daily d{k} ON d{k}.localDate + {k} = spine.localDate")
        cols += [f'round(coalesce(CAST(d{k}.{m} AS DOUBLE), 0.0), 6) AS "{m}-{k}"' for m in METRICS]
    return ("SELECT spine.localDate, " + ", ".join(cols) + " FROM spine " + " ".join(joins))


ORDER_SYMBOLS = ("P1", "P2", "P3", "P4", "P5")   # from o_orderpriority's first digit

ALIGNED = """aligned AS (
  SELECT localDate FROM tdates
  WHERE localDate IN (SELECT localDate FROM spine)
    AND localDate IN (SELECT localDate FROM targets))"""

IDX = """idx AS (
  SELECT localDate, row_number() OVER (ORDER BY localDate) - 1 AS t,
         count(*) OVER () AS n FROM aligned)"""


def orders_dataset_chain() -> list[str]:
    """Orders panel/targets plus the news lag table spanning the panel's
    dates (zero metrics where there is no news), aligned and indexed."""
    spine = """spine AS (
  SELECT CAST(d AS DATE) AS localDate FROM (
    SELECT unnest(generate_series((SELECT min(localDate) FROM tdates),
                                  (SELECT max(localDate) FROM tdates) + 1,
                                  INTERVAL 1 DAY)) AS d))"""
    return target_chain(BARS_ORDERS) + [spine, ALIGNED, IDX]


SAMPLES = """days AS (SELECT localDate, count_articles AS n, mean_sentiment AS m FROM daily),
lags AS (
  SELECT i.t, i.n AS total, sum(coalesce(d.n, 0)) AS articles, sum(coalesce(d.m, 0.0)) AS mean
  FROM idx i CROSS JOIN range(1, 6) r(k)
  LEFT JOIN days d ON d.localDate + CAST(k AS INTEGER) = i.localDate GROUP BY ALL),
rows AS (
  SELECT i.t, p.id, p.close + p.high + p.low + p.open + p.volume AS v
  FROM panel p JOIN idx i USING (localDate)),
samples AS (
  SELECT y.localDate, y.id,
    CASE WHEN i.t < i.n - CAST(floor(i.n * 0.2) AS BIGINT) THEN 'train' ELSE 'validation' END AS split,
    (SELECT sum(v) FROM rows r WHERE r.id = y.id AND r.t >= i.t - 30 AND r.t < i.t) AS stock_sum,
    (SELECT sum(articles) FROM lags l WHERE l.t >= i.t - 30 AND l.t < i.t) AS news_articles,
    (SELECT sum(mean) FROM lags l WHERE l.t >= i.t - 30 AND l.t < i.t) AS news_mean,
    zscore_1d, rank_1d, CAST(direction_1d AS DOUBLE) AS direction_1d,
    greatest(-10000.0::DOUBLE, least(10000.0::DOUBLE, log_return_1d * 1000.0)) AS log_return_1d,
    greatest(-10000.0::DOUBLE, least(10000.0::DOUBLE, log_return_3d * 1000.0)) AS log_return_3d,
    greatest(-10000.0::DOUBLE, least(10000.0::DOUBLE, log_return_5d * 1000.0)) AS log_return_5d
  FROM targets y JOIN idx i USING (localDate) WHERE i.t >= 30)"""


def samples_chain() -> list[str]:
    """The orders dataset with its news, as labelled training samples."""
    return orders_dataset_chain() + [ARTICLES_ORDERS, CLEANED, SENTIMENT_FIXED, DAILY, SAMPLES]


#: Heads that weigh each feature by its own covariance, in the order of the loss weights.
#: ``cells`` are the features that a position's window holds, by the position of their row.
MARGINAL = """cut AS (SELECT max(n) - CAST(floor(max(n) * 0.2) AS BIGINT) AS first, max(n) AS n FROM idx),
samp AS (
  SELECT i.t, y.id, [zscore_1d, rank_1d, CAST(direction_1d AS DOUBLE),
    greatest(-10000.0::DOUBLE, least(10000.0::DOUBLE, log_return_1d * 1000.0)),
    greatest(-10000.0::DOUBLE, least(10000.0::DOUBLE, log_return_3d * 1000.0)),
    greatest(-10000.0::DOUBLE, least(10000.0::DOUBLE, log_return_5d * 1000.0))]::DOUBLE[] AS y
  FROM targets y JOIN idx i USING (localDate)),
means AS (
  SELECT t, count(*) AS m, [{sums}] AS y FROM samp
  WHERE t >= 30 AND t < (SELECT first FROM cut) GROUP BY t),
stock AS (
  SELECT i.t, p.id, unnest([0, 1, 2, 3, 4]) AS feature,
         unnest([close, high, low, open, CAST(volume AS DOUBLE)]::DOUBLE[]) AS x
  FROM panel p JOIN idx i USING (localDate)),
news AS (
  SELECT i.t, CAST((k - 1) * 16 + f.i AS INTEGER) AS feature, coalesce(d.v[f.i + 1], 0.0) AS x
  FROM idx i CROSS JOIN range(1, 6) r(k) CROSS JOIN range(0, 16) f(i)
  LEFT JOIN (SELECT localDate, [{metrics}]::DOUBLE[] AS v FROM daily) d
    ON d.localDate + CAST(k AS INTEGER) = i.localDate),
feats AS (
  SELECT 'stock' AS part, CAST(s.step AS INTEGER) AS step, x.feature, avg(x.x) AS mean,
         var_pop(x.x) AS var, min(x.x) < max(x.x) AS varies,
         coalesce(nullif(max(abs(x.x)), 0.0), 1.0) AS top, [{covs}] AS cov
  FROM samp y CROSS JOIN range(0, 30) s(step)
  JOIN stock x ON x.id = y.id AND x.t = y.t - 30 + s.step
  WHERE y.t >= 30 AND y.t < (SELECT first FROM cut) GROUP BY s.step, x.feature
  UNION ALL
  SELECT 'news' AS part, step, feature, mean,
         sum(m * (x - mean) * (x - mean)) / sum(m) AS var, min(x) < max(x) AS varies,
         coalesce(nullif(max(abs(x)), 0.0), 1.0) AS top, [{ncovs}] AS cov
  FROM (SELECT CAST(s.step AS INTEGER) AS step, x.feature, x.x, d.m, d.y,
               sum(d.m * x.x) OVER w / sum(d.m) OVER w AS mean
        FROM means d CROSS JOIN range(0, 30) s(step) JOIN news x ON x.t = d.t - 30 + s.step
        WINDOW w AS (PARTITION BY s.step, x.feature))
  GROUP BY step, feature, mean),
label AS (SELECT [{labels}] AS mean FROM samp WHERE t >= 30 AND t < (SELECT first FROM cut)),
used AS (SELECT part, step, feature, mean, list_transform(cov, lambda c: c / var) AS beta
         FROM feats WHERE varies AND var > 0),
size AS (SELECT count(*) AS p FROM used),
places AS (SELECT t FROM idx WHERE t >= 30 UNION SELECT max(n) FROM idx),
day AS (
  SELECT a.t, [{scores}] AS z
  FROM places a JOIN used u ON u.part = 'news' JOIN news x ON x.feature = u.feature
   AND x.t = a.t - 30 + u.step GROUP BY a.t),
own AS (
  SELECT a.t, x.id, [{scores}] AS z
  FROM places a JOIN used u ON u.part = 'stock' JOIN stock x ON x.feature = u.feature
   AND x.t = a.t - 30 + u.step GROUP BY a.t, x.id),
outs AS (
  SELECT own.t, own.id, {outs}
  FROM own JOIN day USING (t) CROSS JOIN label CROSS JOIN size)"""


def marginal_chain() -> list[str]:
    """The orders dataset, the marginal heads' moments and their outputs per position."""
    six = range(1, 7)
    raw = lambda k: f"(label.mean[{k}] + (own.z[{k}] + day.z[{k}]) / size.p)"
    heads = [f"{raw(1)} AS zscore_1d", f"{raw(2)} AS rank_1d",
             f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {raw(3)})) AS direction_1d",
             *[f"{raw(4 + k)} / 1000.0::DOUBLE AS log_return_{h}d" for k, h in enumerate((1, 3, 5))]]
    each = lambda text: ", ".join(text.format(k=k) for k in six)
    sql = MARGINAL.format(
        sums=each("sum(y[{k}])"), covs=each("covar_pop(x.x, y.y[{k}])"),
        ncovs=each("sum((x - mean) * y[{k}]) / sum(m)"), labels=each("avg(y[{k}])"),
        scores=each("sum(u.beta[{k}] * (x.x - u.mean))"), outs=", ".join(heads),
        metrics=", ".join(METRICS))
    return samples_chain()[:-1] + [sql]


def weekdays_sql(first: str, last: str) -> str:
    """Weekdays from the one after ``first`` to the one after ``last``."""
    after = ("({d} + CAST(CASE isodow({d}) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS INTEGER))")
    return (f"SELECT CAST(d AS DATE) AS localDate FROM (SELECT unnest(generate_series("
            f"{after.format(d=first)}, {after.format(d=last)}, INTERVAL 1 DAY)) AS d) "
            "WHERE isodow(d) < 6")


def pivot_sql(src: str, metrics, symbols=ORDER_SYMBOLS) -> str:
    cols = [f"max(CASE WHEN id = '{s}' THEN {m} END) AS \"{s}_{m}\""
            for s in symbols for m in metrics]
    return f"SELECT localDate, {', '.join(cols)} FROM {src} GROUP BY localDate"


PREDS_FIXED = """preds AS (
  SELECT * FROM (
    SELECT localDate, id AS symbol, pos,
      lag(CAST(zscore_1d AS DOUBLE)) OVER w AS zscore_1d, lag(CAST(rank_1d AS DOUBLE)) OVER w AS rank_1d,
      lag(CAST(direction_1d AS DOUBLE)) OVER w AS direction_1d,
      lag(CAST(log_return_1d AS DOUBLE)) OVER w AS log_return_1d,
      lag(CAST(log_return_3d AS DOUBLE)) OVER w AS log_return_3d,
      lag(CAST(log_return_5d AS DOUBLE)) OVER w AS log_return_5d
    FROM targets WINDOW w AS (PARTITION BY id ORDER BY localDate))
  WHERE zscore_1d IS NOT NULL)"""

PVA = """pva AS (
  SELECT p.localDate, p.symbol,
    p.zscore_1d AS zscore_1d_p, CAST(t.zscore_1d AS DOUBLE) AS zscore_1d_a,
    p.rank_1d AS rank_1d_p, CAST(t.rank_1d AS DOUBLE) AS rank_1d_a,
    p.direction_1d AS direction_1d_p, CAST(t.direction_1d AS DOUBLE) AS direction_1d_a,
    p.log_return_1d AS log_return_1d_p, CAST(t.log_return_1d AS DOUBLE) AS log_return_1d_a,
    p.log_return_3d AS log_return_3d_p, CAST(t.log_return_3d AS DOUBLE) AS log_return_3d_a,
    p.log_return_5d AS log_return_5d_p, CAST(t.log_return_5d AS DOUBLE) AS log_return_5d_a
  FROM preds p JOIN targets t ON t.localDate = p.localDate AND t.id = p.symbol)"""


def sc(x: str) -> str:
    return f"greatest(-10000.0, least(10000.0, {x} * 1000.0))"


def loss_terms() -> dict[str, str]:
    t = {}
    for h in ("zscore_1d",):
        t[h] = f"pow({h}_p - {h}_a, 2)"
    t["rank_1d"] = ("CASE WHEN abs(rank_1d_p - rank_1d_a) <= 0.1 THEN 0.5 * pow(rank_1d_p - rank_1d_a, 2) "
                    "ELSE 0.1 * (abs(rank_1d_p - rank_1d_a) - 0.05) END")
    q = "greatest(1e-7, least(1 - 1e-7, direction_1d_p))"
    t["direction_1d"] = f"-(direction_1d_a * ln({q}) + (1 - direction_1d_a) * ln(1 - {q}))"
    for h in ("log_return_1d", "log_return_3d", "log_return_5d"):
        t[h] = f"pow({sc(h + '_p')} - {sc(h + '_a')}, 2)"
    return t


WEIGHTS = {"zscore_1d": 1.0, "rank_1d": 0.3, "direction_1d": 0.3,
           "log_return_1d": 0.05, "log_return_3d": 0.05, "log_return_5d": 0.05}


def normalized_sql(loss: str = "{h}") -> str:
    parts = []
    for h, w in WEIGHTS.items():
        v = loss.format(h=h)
        if h.startswith("log_return"):
            v = f"({v} / 1000.0)"
        parts.append(f"{v} * {w}")
    return f"(({' + '.join(parts)}) / {sum(WEIGHTS.values())})"


def total_sql(loss: str = "{h}") -> str:
    return "(" + " + ".join(f"{loss.format(h=h)} * {w}" for h, w in WEIGHTS.items()) + ")"
