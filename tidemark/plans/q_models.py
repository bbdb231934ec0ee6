"""Registered evaluation, model-selection and model queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C
from tidemark.functions import dates as D
from tidemark.operators import heads as H
from tidemark.operators import models as MD
from tidemark.operators import report as RP
from tidemark.plans import oracle as O
from tidemark.plans.q_dataset import dataset
from tidemark.plans.q_report import EVP, event_preds
from tidemark.plans.registry import register, rounded
from tidemark.session import scratch_path
from tidemark.sources import parquet as PQ

HEADS = MD.HEADS
TERMS = O.loss_terms()
AGG = ("agg AS (SELECT " + ", ".join(f"avg({TERMS[h]}) AS {h}" for h in HEADS) + " FROM pva)")


def pva_events(spark, sf_dir):
    p, t, *_ = event_preds(spark, sf_dir)
    return RP.predicted_vs_actual(p, t)


@register("head_losses", EVP + ", " + AGG + " " + " UNION ALL ".join(
    [f"SELECT '{h}' AS head, round({h}, 6) AS loss FROM agg" for h in HEADS] +
    [f"SELECT 'normalized', round({O.normalized_sql()}, 6) FROM agg"]))
def q_head_losses(spark, sf_dir):
    return rounded(MD.head_losses(pva_events(spark, sf_dir)))


HIST = EVP + """, ep AS (
  SELECT localDate, dense_rank() OVER (ORDER BY localDate) AS epoch FROM (SELECT DISTINCT localDate FROM pva)),
hist AS (SELECT epoch, """ + ", ".join(f"avg({TERMS[h]}) AS {h}" for h in HEADS) + """
         FROM pva JOIN ep USING (localDate) GROUP BY epoch),
hs AS (SELECT *, """ + O.total_sql() + " AS val_loss, " + O.normalized_sql() + """ AS score FROM hist),
best AS (SELECT * FROM hs ORDER BY val_loss, epoch LIMIT 1)"""


def history(spark, sf_dir):
    pva = pva_events(spark, sf_dir)
    ep = pva.select("localDate").distinct().withColumn(
        "epoch", F.dense_rank().over(Window.orderBy("localDate")))   # one row per day
    return MD.epoch_history(pva.join(ep, "localDate"), F.col("epoch"))


@register("best_epoch", HIST + " SELECT CAST(epoch AS INTEGER) AS epoch, round(val_loss, 6) AS val_loss FROM best")
def q_best_epoch(spark, sf_dir):
    return rounded(MD.best_epoch(history(spark, sf_dir)).select("epoch", "val_loss"))


@register("normalized_score", HIST + """
SELECT CAST(epoch AS INTEGER) AS epoch, round(score, 6) AS score, printf('%.4f', score) AS score_text FROM best""")
def q_normalized_score(spark, sf_dir):
    return rounded(MD.best_epoch(history(spark, sf_dir)).select("epoch", "score", "score_text"))


JUNK_KEYS = ("model/score=abc/model.keras", "model/score=0.0000/meta.json", "other/model.keras")


@register("best_model", HIST + """, reg AS (
  SELECT 'model/score=' || printf('%.4f', score) || '/model.keras' AS key FROM hs
  UNION ALL SELECT unnest(['model/score=abc/model.keras', 'model/score=0.0000/meta.json',
                           'other/model.keras']))
SELECT key, CAST(split_part(split_part(key, 'model/score=', 2), '/', 1) AS DOUBLE) AS score
FROM reg WHERE key LIKE 'model/score=%/model.keras'
  AND TRY_CAST(split_part(split_part(key, 'model/score=', 2), '/', 1) AS DOUBLE) IS NOT NULL
ORDER BY score, key LIMIT 1""")
def q_best_model(spark, sf_dir):
    h = history(spark, sf_dir)
    keys = h.select(D.score_key(MD.normalized({x: F.col(f"val_{x}_loss") for x in HEADS})).alias("key"))
    junk = spark.createDataFrame([(k,) for k in JUNK_KEYS], "key string")
    return MD.best_model(MD.parse_registry(keys.unionByName(junk)))


META = T.StructType([
    T.StructField("model", T.StructType([T.StructField("name", T.StringType()),
                                         T.StructField("score", T.StringType())])),
    T.StructField("training", T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("symbol_count", T.LongType()),
        T.StructField("validation_size", T.LongType()),
        T.StructField("config", T.StructType([T.StructField("window_size", T.IntegerType()),
                                              T.StructField("batch_size", T.IntegerType()),
                                              T.StructField("epochs", T.IntegerType())])),
        T.StructField("result_analysis", T.StructType([
            T.StructField("normalized_val_loss", T.DoubleType()),
            T.StructField("val_losses", T.MapType(T.StringType(), T.DoubleType()))]))]))])


def meta_struct(best, symbol_count, validation_size, training_date):
    return F.struct(
        F.struct(F.lit("linear_heads").alias("name"), F.col("score_text").alias("score")).alias("model"),
        F.struct(F.date_format(training_date, "yyyy-MM-dd").alias("date"),
                 F.lit(symbol_count).cast("long").alias("symbol_count"),
                 F.lit(validation_size).cast("long").alias("validation_size"),
                 F.struct(F.lit(C.WINDOW_SIZE).alias("window_size"),
                          F.lit(C.BATCH_SIZE).alias("batch_size"),
                          F.lit(C.EPOCHS).alias("epochs")).alias("config"),
                 F.struct(F.col("score").alias("normalized_val_loss"),
                          F.create_map(*[x for h in HEADS for x in (F.lit(h), F.col(f"val_{h}_loss"))])
                          .alias("val_losses")).alias("result_analysis")).alias("training"))


def write_meta(meta_df, root: str, score_text: str) -> str:
    path = f"{root}/score={score_text}/meta.json"
    meta_df.select(F.to_json("meta").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path


def read_meta(spark, path: str):
    txt = spark.read.text(path, wholetext=True)
    return txt.select(F.from_json("value", META).alias("m"))


@register("registry_meta_json", HIST + """
SELECT printf('%.4f', score) AS score, 'linear_heads' AS name, CAST(30 AS INTEGER) AS window_size,
       CAST(32 AS INTEGER) AS batch_size, (SELECT count(DISTINCT symbol) FROM pva) AS symbol_count,
       round(score, 6) AS normalized_val_loss, round(zscore_1d, 6) AS zscore_loss FROM best""")
def q_registry_meta_json(spark, sf_dir):
    pva = pva_events(spark, sf_dir)
    best = MD.best_epoch(history(spark, sf_dir))
    n_sym = pva.select(F.count_distinct("symbol")).scalar()
    m = best.select(meta_struct(best, 0, 0, F.current_date()).alias("meta"))
    m = m.withColumn("meta", F.col("meta").withField("training.symbol_count", n_sym.cast("long")))
    root = scratch_path(spark, "model")
    text = best.first()["score_text"]
    back = read_meta(spark, write_meta(m, root, text))
    return rounded(back.select(
        F.col("m.model.score").alias("score"), F.col("m.model.name").alias("name"),
        F.col("m.training.config.window_size").alias("window_size"),
        F.col("m.training.config.batch_size").alias("batch_size"),
        F.col("m.training.symbol_count").alias("symbol_count"),
        F.col("m.training.result_analysis.normalized_val_loss").alias("normalized_val_loss"),
        F.col("m.training.result_analysis.val_losses")["zscore_1d"].alias("zscore_loss")))


# --- train and predict ------------------------------------------------------

SAMPLES = O.with_(*O.samples_chain())


@register("training_samples", SAMPLES + """
SELECT localDate, id, split, 30 * 5 + 30 * 80 AS n_features, round(stock_sum, 2) AS stock_sum,
       CAST(news_articles AS DOUBLE) AS news_articles, round(news_mean, 6) AS news_mean, """ +
          ", ".join(f"round({h}, 6) AS {h}" for h in HEADS) + " FROM samples")
def q_training_samples(spark, sf_dir):
    """Labels, split and windows, shown by sums over their parts."""
    panel, targets, lagged, aligned, _ = dataset(spark, sf_dir)
    train, val, _ = MD.training_samples(panel, targets, lagged, aligned)
    both = train.withColumn("split", F.lit("train")).unionByName(
        val.withColumn("split", F.lit("validation")))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    each = lambda k: total(F.transform("news_window", lambda r: total(F.filter(
        r["values"], lambda x, i: i % 16 == k))))
    stock = F.transform("window", lambda r: sum(
        (r[f].cast("double") for f in C.PIVOTED_FEATURES[1:]), r[C.PIVOTED_FEATURES[0]].cast("double")))
    return rounded(both.select(
        "localDate", "id", "split",
        (F.size("window") * len(C.PIVOTED_FEATURES)
         + F.size("news_window") * F.size(F.col("news_window")[0]["values"])).alias("n_features"),
        F.round(total(stock), 2).alias("stock_sum"),
        each(0).alias("news_articles"), each(1).alias("news_mean"),
        *[F.col(f"y_{h}").alias(h) for h in HEADS]))


MARGINAL = O.with_(*O.marginal_chain())


def head_samples(spark, sf_dir, window=C.WINDOW_SIZE):
    """(samples in blocks, (panel, lagged, aligned dates))."""
    panel, targets, lagged, aligned, _ = dataset(spark, sf_dir)
    return H.samples(panel, targets, lagged, aligned, window), (panel, lagged, aligned)


@register("train_moments", MARGINAL + """
SELECT f.part, f.step, f.feature, y.head, round(f.mean / top, 6) + 0.0::DOUBLE AS mean,
       CASE WHEN varies AND var > 0 THEN round(sqrt(f.var) / top, 6) ELSE 0.0 END::DOUBLE AS std,
       CASE WHEN varies AND var > 0 THEN round(f.cov[y.k] / sqrt(var), 6) + 0.0 ELSE 0.0 END::DOUBLE
         AS effect
FROM feats f CROSS JOIN (SELECT unnest(range(1, 7)) AS k, unnest([""" +
          ", ".join(f"'{h}'" for h in HEADS) + """]) AS head) y""")
def q_train_moments(spark, sf_dir):
    """What a fit rests on: each feature's mean and deviation over the training samples (as
    shares of its greatest size), and what one deviation of it goes with in the labels of the
    six heads, from the blocked sums."""
    s, _ = head_samples(spark, sf_dir)
    m = H.moments(s, full=False)
    mean, std, varies = H.feature_scales(m)
    effect = (m.cross[1:] / m.n - mean[:, None] * (m.cross[0] / m.n)) / std[:, None]
    top = np.maximum(np.abs(m.low), np.abs(m.high))
    top[top == 0] = 1.0
    rows = []
    for j in range(len(mean)):            # a number of features that the configuration fixes
        part, at = ("stock", j) if j < s.window * s.n_stock else ("news", j - s.window * s.n_stock)
        step, feature = divmod(at, s.n_stock if part == "stock" else s.n_news)
        rows += [(part, step, feature, h, float(mean[j] / top[j]),
                  float(std[j] / top[j]) if varies[j] else 0.0,
                  float(effect[j, k]) if varies[j] else 0.0) for k, h in enumerate(HEADS)]
    out = rounded(spark.createDataFrame(rows, "part string, step int, feature int, head string, "
                                        "mean double, std double, effect double"))
    return out.withColumns({c: F.col(c) + 0.0 for c in ("mean", "effect")})       # no -0.0


@register("train_heads")
def q_train_heads(spark, sf_dir, root: str | None = None):
    """The job: six ridge heads on the windowed samples, saved under ``model/score=...``; the
    validation loss of each head and the normalised score, unrounded. (No SQL: the solve is
    not plain SQL; tested against numpy, coefficients included.)"""
    s, _ = head_samples(spark, sf_dir)
    heads, losses, score_text = MD.fit_and_score(s)
    H.save(heads, spark, f"{root or scratch_path(spark, 'model')}/score={score_text}")
    return losses


@register("train_heads_marginal", MARGINAL + ", pva AS (SELECT " + ", ".join(
    f"{'out.' + h} AS {h}_p, s.y[{k + 1}] / {1000.0 if h in MD.LOG_HEADS else 1.0}::DOUBLE AS {h}_a"
    for k, h in enumerate(HEADS)) + " FROM outs out JOIN samp s ON s.t = out.t AND s.id = out.id "
    "WHERE s.t >= (SELECT first FROM cut)), " + AGG + " " + " UNION ALL ".join(
    [f"SELECT '{h}' AS head, round({h}, 4) AS loss FROM agg" for h in HEADS] +
    [f"SELECT 'normalized', round({O.normalized_sql()}, 4) FROM agg"]))
def q_train_heads_marginal(spark, sf_dir):
    """``train_heads`` with the solver that plain SQL can follow: same samples, sums, scoring
    and losses."""
    s, _ = head_samples(spark, sf_dir)
    heads, losses, score_text = MD.fit_and_score(s, "marginal")
    H.save(heads, spark, f"{scratch_path(spark, 'model')}/score={score_text}")
    return losses.select("head", F.round("loss", 4).alias("loss"))


def pending_days(spark, after, last):
    """(query_date): weekdays from the one after ``after`` to the one after ``last``."""
    days = D.calendar_days(D.next_weekday(after), D.next_weekday(last))
    return spark.range(1).select(F.explode(days).alias("query_date")).filter(
        D.is_weekday(F.col("query_date")))


def predict_pending(spark, sf_dir, solver: str, root: str):
    """Fit, register, and predict every pending weekday with the best registered model: from
    the weekday after the last date trained on to the one after the watermark; written by
    date and read back."""
    s, (panel, lagged, aligned) = head_samples(spark, sf_dir)
    heads, _, score_text = MD.fit_and_score(s, solver)
    H.save(heads, spark, f"{root}/score={score_text}")
    trained, hi = s.index.agg(F.max(F.when(F.col("t") < s.first_validation, F.col("localDate"))),
                              F.max("localDate")).first()
    best = H.load(spark, MD.best_model_dir(spark, root))
    out = MD.predict_for_dates(best, pending_days(spark, F.lit(trained), F.lit(hi)),
                               panel, lagged, aligned)
    path = scratch_path(spark, "inference")
    PQ.write_partitions(out, path)
    return spark.read.parquet(path).select("localDate", "symbol", *C.INFERENCE_METRICS)


@register("predict_pending", MARGINAL + f""", ends AS (
  SELECT d.localDate, max(i.t) + 1 AS t
  FROM ({O.weekdays_sql("(SELECT max(localDate) FROM idx WHERE t < (SELECT first FROM cut))",
                        "(SELECT max(localDate) FROM idx)")}) d
  JOIN idx i ON i.localDate < d.localDate GROUP BY d.localDate)
SELECT a.localDate, o.id AS symbol, """ + ", ".join(
    f"round(CAST(CAST(o.{h} AS FLOAT) AS DOUBLE), 6) AS {h}" for h in C.INFERENCE_METRICS) + """
FROM ends a JOIN outs o ON o.t = a.t""")
def q_predict_pending(spark, sf_dir):
    """Six heads for every pending weekday, from the solver that plain SQL can follow."""
    return rounded(predict_pending(spark, sf_dir, "marginal", scratch_path(spark, "model")))


@register("predict_pending_heads")
def q_predict_pending_heads(spark, sf_dir, root: str | None = None):
    """The same job with the ridge heads. (No SQL, as ``train_heads``; tested by brute force.)"""
    return predict_pending(spark, sf_dir, "ridge", root or scratch_path(spark, "model"))
