"""Evaluation losses, model selection, and the heads' training and inference jobs.

Losses follow the reference's training setup: MSE for z-score and the three
log-return heads (on x1000-scaled, clipped values), Huber(delta=0.1) for the
rank head and binary cross-entropy for the direction head; the score
divides log-return losses by the scale once and takes the loss-weighted
mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.numeric import scale_clip, unscale
from tidemark.operators import asof as AO
from tidemark.operators import dataset as DS
from tidemark.operators import halo
from tidemark.operators import heads as H
from tidemark.operators.heads import HEADS, LOG_HEADS
from tidemark.schemas import INFERENCE
from tidemark.session import cut_lineage

WEIGHTS = dict(C.LOSS_WEIGHTS)
EPS = 1e-7


def head_error_terms(p: dict[str, Column], a: dict[str, Column]) -> dict[str, Column]:
    """Per-row loss term of each head (averaged by the caller)."""
    out = {}
    for h in HEADS:
        if h in LOG_HEADS:
            e = scale_clip(p[h]) - scale_clip(a[h])
            out[h] = e * e
        elif h == "rank_1d":
            e = F.abs(p[h] - a[h])
            d = C.HUBER_DELTA
            out[h] = F.when(e <= d, 0.5 * e * e).otherwise(d * (e - 0.5 * d))
        elif h == "direction_1d":
            q = F.greatest(F.lit(EPS), F.least(F.lit(1 - EPS), p[h]))
            y = a[h]
            out[h] = -(y * F.log(q) + (1 - y) * F.log(1 - q))
        else:
            e = p[h] - a[h]
            out[h] = e * e
    return out


def loss_columns(pva: DataFrame) -> dict[str, Column]:
    terms = head_error_terms({h: F.col(f"{h}_p") for h in HEADS},
                             {h: F.col(f"{h}_a") for h in HEADS})
    return {h: F.avg(t) for h, t in terms.items()}


def normalized(losses: dict[str, Column]) -> Column:
    """Loss-weighted mean with log-return losses divided by the scale."""
    num = None
    for h in HEADS:
        v = losses[h] / C.TARGET_SCALE if h in LOG_HEADS else losses[h]
        num = v * WEIGHTS[h] if num is None else num + v * WEIGHTS[h]
    return num / sum(WEIGHTS.values())


def weighted_total(losses: dict[str, Column]) -> Column:
    """The optimiser's total: sum of weight x loss (no normalisation)."""
    tot = None
    for h in HEADS:
        tot = losses[h] * WEIGHTS[h] if tot is None else tot + losses[h] * WEIGHTS[h]
    return tot


def head_losses(pva: DataFrame) -> DataFrame:
    """(head, loss) rows plus ('normalized', score) over all rows."""
    agg = pva.agg(*[c.alias(h) for h, c in loss_columns(pva).items()])
    agg = agg.withColumn("normalized", normalized({h: F.col(h) for h in HEADS}))
    return agg.unpivot([], [*HEADS, "normalized"], "head", "loss")


def epoch_history(pva: DataFrame, epoch: Column) -> DataFrame:
    """Per-epoch validation losses: ``val_loss`` (weighted total) and
    ``val_{head}_loss``. ``epoch`` groups the evaluation rows."""
    g = pva.groupBy(epoch.alias("epoch")).agg(*[c.alias(f"val_{h}_loss")
                                                for h, c in loss_columns(pva).items()])
    return g.withColumn("val_loss", weighted_total({h: F.col(f"val_{h}_loss") for h in HEADS}))


def best_epoch(history: DataFrame) -> DataFrame:
    """Epoch with the smallest val_loss (first epoch on ties), with its
    per-head losses and the normalised score (and its 4-decimal text)."""
    best = history.agg(F.min_by(F.struct(*history.columns), F.struct("val_loss", "epoch")).alias("b"))
    b = best.select("b.*")
    score = normalized({h: F.col(f"val_{h}_loss") for h in HEADS})
    return b.select("epoch", "val_loss", *[f"val_{h}_loss" for h in HEADS],
                    score.alias("score"), F.format_string("%.4f", score).alias("score_text"))


def parse_registry(keys: DataFrame, prefix: str = "model/score=",
                   model_file: str = "model.keras") -> DataFrame:
    """Registry listing (key) -> (key, score); keys that are not model files
    or whose score does not parse are dropped."""
    rest = F.substring_index(F.col("key"), prefix, -1)
    score = F.substring_index(rest, "/", 1).try_cast("double")
    ok = F.col("key").startswith(prefix) & F.col("key").endswith("/" + model_file)
    return keys.filter(ok).select("key", score.alias("score")).filter(F.col("score").isNotNull())


def best_model(registry: DataFrame) -> DataFrame:
    """Lowest score; first key on ties; fails when there is none."""
    b = registry.agg(F.min_by(F.struct("key", "score"), F.struct("score", "key")).alias("b"),
                     F.count(F.lit(1)).alias("n"))
    return b.select(F.when(F.col("n") > 0, F.col("b.key"))
                     .otherwise(F.raise_error(F.lit("the registry holds no scored model"))).alias("key"),
                    F.col("b.score").alias("score"))


# --- the heads --------------------------------------------------------------


def training_samples(panel: DataFrame, targets: DataFrame, lagged: DataFrame,
                     aligned: DataFrame, window: int = C.WINDOW_SIZE):
    """(train, validation, validation size): per (date, symbol) the window of the symbol's
    features and of the lagged news, both of the previous ``window`` aligned rows, and the scaled
    targets; split chronologically, with the validation windows reaching back into training rows.

    The samples as rows, for inspection: the heads are fitted from blocks, without them."""
    p, t, lg = DS.align(aligned, panel, targets, lagged)
    idx = cut_lineage(DS.date_index(aligned))
    n = idx.count()                                   # one row per day
    val_start, max_val = DS.split_point(n, window)
    win = DS.sliding_windows(p, window, index=idx)
    news = DS.news_windows(lg, idx, window)
    rows = (win.join(news, "localDate").join(H.scaled_targets(t), ["localDate", "id"])
            .join(idx, "localDate"))
    return rows.filter(F.col("t") < val_start), rows.filter(F.col("t") >= val_start), max_val


def fit_and_score(samples: H.Samples, solver: str = "ridge"):
    """Fit the heads and score them on the validation samples: (heads, losses, score text)."""
    heads = {"ridge": H.ridge, "marginal": H.marginal}[solver](samples)
    losses = cut_lineage(head_losses(H.evaluate(samples, heads)))
    score = losses.where(F.col("head") == "normalized").select(
        F.format_string("%.4f", "loss")).first()[0]
    return heads, losses, score


def best_model_dir(spark, root: str) -> str:
    """Folder of the lowest-scoring registered model under ``root``
    (``score=<s>/...`` folders, listed as files)."""
    keys = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select(F.regexp_extract("path", r"(score=[^/]+)/", 1).alias("k")).distinct()
            .select(F.concat(F.lit("model/"), "k", F.lit("/model.keras")).alias("key")))
    best = best_model(parse_registry(keys)).first()
    return f"{root}/score={best['key'].split('score=')[1].split('/')[0]}"


def predict_for_dates(heads: H.Heads, pending: DataFrame, panel: DataFrame, lagged: DataFrame,
                      trading: DataFrame, window: int = C.WINDOW_SIZE) -> DataFrame:
    """Predictions for every pending date in one plan: the latest trading date
    before it, and that date's trailing window per symbol and of the news; a short
    window of either fails. Log-return heads unscaled; float32 output.

    Only the rows that some window needs are read. Pending dates with one end date (a
    weekend apart, say) share its scores."""
    if heads.window != window:
        raise ValueError(f"the heads have windows of {heads.window} rows, not {window}")
    index = cut_lineage(DS.date_index(trading.select("localDate").distinct()))
    at = AO.asof_index(pending, index, strict=True)
    ends = cut_lineage(at.select("query_date", F.when(F.col("t") >= window - 1, F.col("t") + 1)
                       .otherwise(F.raise_error(F.concat(
                           F.lit(f"fewer than {window} trading dates before "),
                           F.col("query_date").cast("string")))).alias("t")))   # one row a day
    needed = index.join(ends.agg(F.min("t").alias("lo"), F.max("t").alias("hi")),
                        (F.col("t") >= F.col("lo") - window) & (F.col("t") < F.col("hi")))
    first, last = needed.agg(F.min("localDate"), F.max("localDate")).first()
    if first is None:
        return panel.sparkSession.createDataFrame([], INFERENCE)
    within = F.col("localDate").between(F.lit(first), F.lit(last))
    some = index.where(within)
    parts = halo.blocked(panel.where(within).select("localDate", "id", *C.PIVOTED_FEATURES), some,
                         window, C.PIVOTED_FEATURES, ["id"])
    blocks = halo.arrays(parts, x=lambda r: [r[f] for f in C.PIVOTED_FEATURES])
    scores = H.raw_scores(blocks, heads, past=True)
    days = H.day_scores(H.news_values(lagged.where(within), some), heads)
    each = (ends.join(scores, "t").join(days.withColumnRenamed("score", "day"), "t", "left")
            .withColumn("day", F.coalesce("day", F.raise_error(F.concat(
                F.lit("no full news window before "), F.col("query_date").cast("string"))))))
    made = each.select("query_date", "id", *H.outputs("score", "day", heads))
    return made.select(F.col("query_date").alias("localDate"), F.col("id").alias("symbol"),
                       *[(unscale(F.col(h)) if h in LOG_HEADS else F.col(h)).cast("float").alias(h)
                         for h in C.INFERENCE_METRICS])
