"""Loss definitions and model selection."""

import math

from pyspark.sql import functions as F

from tidemark.operators import models as MD


def test_head_losses_hand_case(spark):
    cols = {f"{h}_p": 0.0 for h in MD.HEADS} | {f"{h}_a": 0.0 for h in MD.HEADS}
    cols.update({"zscore_1d_p": 1.0, "rank_1d_p": 0.3, "direction_1d_p": 1.0,
                 "direction_1d_a": 1.0, "log_return_1d_p": 0.002, "log_return_3d_p": 20.0})
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} double" for k in cols))
    got = {r.head: r.loss for r in MD.head_losses(df).collect()}
    assert math.isclose(got["zscore_1d"], 1.0)
    assert math.isclose(got["rank_1d"], 0.1 * (0.3 - 0.05))       # Huber, linear branch
    assert math.isclose(got["direction_1d"], -math.log(1 - 1e-7), rel_tol=1e-6)
    assert math.isclose(got["log_return_1d"], 4.0)                 # (2 - 0)^2 after x1000
    assert math.isclose(got["log_return_3d"], 10000.0 ** 2)        # clipped at 10 x scale
    w = dict(MD.WEIGHTS)
    norm = (1.0 * w["zscore_1d"] + 0.025 * w["rank_1d"] + got["direction_1d"] * w["direction_1d"] +
            (4.0 / 1000) * w["log_return_1d"] + (1e8 / 1000) * w["log_return_3d"]) / sum(w.values())
    assert math.isclose(got["normalized"], norm, rel_tol=1e-9)


def test_best_epoch_first_on_ties_and_best_model(spark):
    h = spark.createDataFrame([(1, 2.0), (2, 1.0), (3, 1.0)], "epoch int, val_loss double")
    for x in MD.HEADS:
        h = h.withColumn(f"val_{x}_loss", F.lit(0.5))
    assert MD.best_epoch(h).first().epoch == 2
    keys = spark.createDataFrame([("model/score=0.5000/model.keras",), ("model/score=0.2000/model.keras",),
                                  ("model/score=x/model.keras",), ("model/score=0.1000/meta.json",)],
                                 "key string")
    b = MD.best_model(MD.parse_registry(keys)).first()
    assert (b.key, b.score) == ("model/score=0.2000/model.keras", 0.2)


def test_injected_pandas_scorer(spark):
    """A batch classifier plugged in through the iterator pandas UDF: the
    loader runs per task, batches are scored, polarity = p_pos - p_neg."""
    import datetime as dt

    import numpy as np

    from tidemark.operators import sentiment as SN

    def load():
        def model(texts):
            n = np.array([len(t) for t in texts], dtype=float)
            return np.stack([np.log1p(n), np.zeros_like(n), np.ones_like(n)], axis=1)
        return model

    arts = spark.createDataFrame([(dt.date(2024, 1, 1), "1", "Up", "big gains"),
                                  (dt.date(2024, 1, 1), "2", "", "")],
                                 "localDate date, id string, title string, body string")
    got = {r.id: r for r in SN.score_articles(arts, SN.pandas_scorer(load, batch_size=1)).collect()}
    for i, text in (("1", "Upbig gains"), ("2", "")):
        lg = np.array([np.log1p(len(text)), 0.0, 1.0])
        e = np.exp(lg - lg.max())
        assert math.isclose(got[i].sentiment_score, float(np.float32((e[0] - e[1]) / e.sum())),
                            rel_tol=1e-6)
        assert got[i].text_length == len(text)
