"""Registered news queries: cleaning, scoring, the daily roll-up and lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import text as TX
from tidemark.operators import classifier as CL
from tidemark.operators import rollup as RU
from tidemark.operators import sentiment as SN
from tidemark.plans import oracle as O
from tidemark.plans.registry import register, rounded
from tidemark.sources import fixtures as FX

NEWS = O.with_(*O.NEWS_CHAIN)


def daily(spark, sf_dir, with_median=True, source="events"):
    return RU.daily_rollup(FX.sentiment_fixed(spark, sf_dir, source=source),
                           with_median=with_median)


@register("clean_text", O.with_(O.ARTICLES, O.CLEANED) + "SELECT id, t AS cleaned FROM cleaned")
def q_clean_text(spark, sf_dir):
    a = FX.articles(spark, sf_dir)
    return a.select("id", TX.clean_text(F.col("title"), F.col("body")).alias("cleaned"))


@register("text_length", O.with_(O.ARTICLES, O.CLEANED) +
          "SELECT id, CAST(length(t) AS INTEGER) AS text_length FROM cleaned")
def q_text_length(spark, sf_dir):
    return FX.sentiment_fixed(spark, sf_dir).select("id", "text_length")


@register("token_count", O.with_(O.ARTICLES, O.CLEANED, O.SENTIMENT_FIXED) +
          "SELECT id, CAST(token_count AS INTEGER) AS token_count FROM sentiment")
def q_token_count(spark, sf_dir):
    return FX.sentiment_fixed(spark, sf_dir).select("id", "token_count")


@register("nfkc", """
SELECT doc_id, replace(replace(text, 'er', 'fi'), 'th', chr(233)) || ' A12' || chr(12460)
       AS normalized FROM documents""")
def q_nfkc(spark, sf_dir):
    """NFKC over whole documents into which compatible characters (a ligature, a
    letter with a combining accent, wide and circled ones) are put."""
    d = FX.table(spark, sf_dir, "documents")
    raw = F.concat(F.replace(F.replace("text", F.lit("er"), F.lit("\ufb01")),
                             F.lit("th"), F.lit("e\u0301")),
                   F.lit(" \uff21\u2460\u00b2\uff76\uff9e"))
    return d.select("doc_id", TX.nfkc(raw).alias("normalized"))


FOLD = ("list_sum(list_transform(list_filter(embedding, lambda x, i: i % 3 = {}), "
        "lambda x: CAST(x AS DOUBLE)))")


@register("softmax_polarity",
          "SELECT vec_id, round((exp(l0 - mx) - exp(l1 - mx)) / "
          "(exp(l0 - mx) + exp(l1 - mx) + exp(l2 - mx)), 6) AS polarity FROM ("
          "SELECT *, greatest(l0, l1, l2) AS mx FROM (SELECT vec_id, "
          f"{FOLD.format(1)} AS l0, {FOLD.format(2)} AS l1, {FOLD.format(0)} AS l2 FROM embeddings))")
def q_softmax_polarity(spark, sf_dir):
    """Three logits from the whole vector: every third component is added up."""
    e = FX.table(spark, sf_dir, "embeddings")
    add = lambda acc, x: acc + x.cast("double")
    third = lambda k: F.filter("embedding", lambda x, i: i % 3 == k)
    fold = [F.aggregate(third(k), F.lit(0.0), add) for k in range(3)]
    return rounded(e.select("vec_id", TX.softmax_polarity(F.array(*fold)).alias("polarity")))


LEXICAL = r"""scored AS (
  SELECT localDate, id, t, len(w) AS nw,
         len(list_filter(w, lambda x: length(x) % 3 = 0)) / sqrt(len(w) + 1.0) AS l0,
         len(list_filter(w, lambda x: length(x) % 3 = 1)) / sqrt(len(w) + 1.0) AS l1,
         len(list_filter(w, lambda x: length(x) % 3 = 2)) / sqrt(len(w) + 1.0) AS l2
  FROM (SELECT *, regexp_extract_all(lower(t), '[a-z]+') AS w FROM cleaned))"""


@register("score_sentiment", O.with_(O.ARTICLES, O.CLEANED, LEXICAL) + r"""
SELECT localDate, id,
  round(CAST(CAST((exp(l0 - greatest(l0, l1, l2)) - exp(l1 - greatest(l0, l1, l2))) /
     (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2)))
     AS FLOAT) AS DOUBLE), 6) AS sentiment_score,
  CAST(length(t) AS INTEGER) AS text_length,
  CAST(least(len(regexp_extract_all(t, '\w+|[^\w\s]')) + 2, 512) AS INTEGER) AS token_count
FROM scored""")
def q_score_sentiment(spark, sf_dir):
    return rounded(SN.score_articles(FX.articles(spark, sf_dir)))


#: The fitted log-odds of ``tidemark.operators.classifier`` (labelled articles outside the held-out quarter).
LOG_ODDS = r"""bags AS (
  SELECT localDate, id, doc_id, t, list_distinct(regexp_extract_all(lower(t), '\w+|[^\w\s]')) AS w
  FROM cleaned),
fit AS (
  SELECT b.w, CASE WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 0 WHEN quality = 0 THEN 2 END AS label
  FROM bags b JOIN labels USING (doc_id) WHERE doc_id % 4 <> 2),
classes AS (
  SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1,
         count(*) FILTER (label = 2) AS n2, count(label) AS n FROM fit),
counts AS (
  SELECT word, count(*) FILTER (label = 0) AS c0, count(*) FILTER (label = 1) AS c1,
         count(*) FILTER (label = 2) AS c2
  FROM (SELECT unnest(w) AS word, label FROM fit WHERE label IS NOT NULL) GROUP BY word),
odds AS (
  SELECT word, <ODDS>
  FROM counts CROSS JOIN classes),
model AS (
  SELECT word, CASE WHEN z0 >= 4 THEN o0 ELSE 0 END AS w0, CASE WHEN z1 >= 4 THEN o1 ELSE 0 END AS w1,
         CASE WHEN z2 >= 4 THEN o2 ELSE 0 END AS w2
  FROM (SELECT *, <Z> FROM odds) WHERE greatest(z0, z1, z2) >= 4
  ORDER BY greatest(z0, z1, z2) DESC, word LIMIT 16384),
told AS (
  SELECT id, sum(w0) AS s0, sum(w1) AS s1, sum(w2) AS s2
  FROM (SELECT id, unnest(w) AS word FROM bags) JOIN model USING (word) GROUP BY id),
logits AS (
  SELECT b.localDate, b.id, b.t, <L>
  FROM bags b CROSS JOIN classes LEFT JOIN told USING (id))"""
for _tag, _each in (
        ("<ODDS>", "ln((c{0} + 0.5::DOUBLE) / (n{0} + 1 - (c{0} + 0.5::DOUBLE))) - ln((c{1} + c{2} + 0.5::DOUBLE)"
                   " / (n - n{0} + 1 - (c{1} + c{2} + 0.5::DOUBLE))) AS o{0}, "
                   "sqrt(1 / (c{0} + 0.5::DOUBLE) + 1 / (c{1} + c{2} + 0.5::DOUBLE)) AS e{0}"),
        ("<Z>", "abs(o{0} / e{0}) AS z{0}"),
        ("<L>", "coalesce(s{0}, 0) + ln((n{0} + 1.0::DOUBLE) / (n + 3)) AS l{0}")):
    LOG_ODDS = LOG_ODDS.replace(_tag, ", ".join(
        _each.format(k, (k + 1) % 3, (k + 2) % 3) for k in range(3)))


def polarity_model(spark, sf_dir):
    """The classifier fitted on the labelled articles, a quarter of them held out."""
    a = FX.articles(spark, sf_dir).where(F.col("doc_id") % 4 != 2)
    known = FX.table(spark, sf_dir, "labels").select(
        "doc_id", CL.polarity_class(F.col("quality"), F.col("toxic")).alias("label"))
    return CL.learn(a.join(known, "doc_id").select(
        "label", TX.clean_text(F.col("title"), F.col("body")).alias("t")))


@register("score_sentiment_fitted", O.with_(O.ARTICLES, O.CLEANED, LOG_ODDS) + r"""
SELECT localDate, id,
  round(CAST(CAST((exp(l0 - greatest(l0, l1, l2)) - exp(l1 - greatest(l0, l1, l2))) /
     (exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2)))
     AS FLOAT) AS DOUBLE), 6) AS sentiment_score,
  CAST(length(t) AS INTEGER) AS text_length,
  CAST(least(len(regexp_extract_all(t, '\w+|[^\w\s]')) + 2, 512) AS INTEGER) AS token_count
FROM logits""")
def q_score_sentiment_fitted(spark, sf_dir):
    """K1 with a classifier that is fitted, in batches of a token budget."""
    model = polarity_model(spark, sf_dir)
    return rounded(SN.score_articles(FX.articles(spark, sf_dir), CL.budget_scorer(model.load)))


def _metric_query(key, metric, median=False):
    sql = NEWS + (f"SELECT localDate, {metric} FROM daily" if metric == "count_articles"
                  else f"SELECT localDate, round({metric}, 6) AS {metric} FROM daily")

    @register(key, sql)
    def q(spark, sf_dir):
        return rounded(daily(spark, sf_dir, with_median=median).select("localDate", metric))
    return q


for _key, _metric in (("agg_count_articles", "count_articles"),
                      ("agg_mean_sentiment", "mean_sentiment"),
                      ("agg_pct_positive", "pct_positive"),
                      ("agg_pct_negative", "pct_negative"),
                      ("agg_polarity_ratio", "polarity_ratio"),
                      ("agg_weighted_mean_sentiment", "weighted_mean_sentiment"),
                      ("agg_extreme_share", "extreme_sentiment_share"),
                      ("agg_neutral_share", "neutral_share"),
                      ("agg_skewness", "sentiment_skewness"),
                      ("agg_kurtosis", "sentiment_kurtosis"),
                      ("agg_max_sentiment", "max_sentiment"),
                      ("agg_min_sentiment", "min_sentiment"),
                      ("agg_length_variance", "article_length_variance"),
                      ("agg_ratio_pos_neg", "ratio_pos_neg"),
                      ("agg_conflict_share", "conflict_share")):
    _metric_query(_key, _metric)
_metric_query("agg_median_sentiment", "median_sentiment", median=True)

ALL_METRICS = ", ".join(["count_articles"] + [f"round({m}, 6) AS {m}" for m in O.METRICS[1:]])


@register("news_daily_rollup", NEWS + f"SELECT localDate, {ALL_METRICS} FROM daily")
def q_news_daily_rollup(spark, sf_dir):
    return rounded(daily(spark, sf_dir))


@register("calendar_spine_zero_fill", NEWS + ", " + O.spine_sql() + " SELECT spine.localDate, " +
          ", ".join(f"round(coalesce(CAST({m} AS DOUBLE), 0.0), 6) AS {m}" for m in O.METRICS) +
          " FROM spine LEFT JOIN daily USING (localDate)")
def q_calendar_spine(spark, sf_dir):
    return rounded(RU.spine_zero_fill(daily(spark, sf_dir)))


@register("lagged_features", NEWS + ", " + O.spine_sql(extra_days=1) + " " + O.lagged_sql(C.LAG_DAYS))
def q_lagged_features(spark, sf_dir):
    return rounded(RU.lagged_features(daily(spark, sf_dir)))


@register("agg_min_max", NEWS + "SELECT localDate, round(max_sentiment, 6) AS max_sentiment, "
          "round(min_sentiment, 6) AS min_sentiment FROM daily")
def q_agg_min_max(spark, sf_dir):
    return rounded(daily(spark, sf_dir, with_median=False)
                   .select("localDate", "max_sentiment", "min_sentiment"))
