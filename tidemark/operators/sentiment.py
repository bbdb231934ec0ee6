"""Article scoring: cleaned text -> (sentiment_score, text_length, token_count).

The classifier is injected. ``lexical_logits`` is the deterministic JVM-side
stand-in used in tests (array functions on each row, no shuffle);
``pandas_scorer`` wraps a real model as an iterator pandas UDF that loads the
model once per task and scores Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as TX


# maximal runs of a-z whose length is 0, 1 or 2 modulo 3
_WORD_CLASS = (r"(?<![a-z])(?:[a-z]{3})+(?![a-z])",
               r"(?<![a-z])[a-z](?:[a-z]{3})*(?![a-z])",
               r"(?<![a-z])[a-z]{2}(?:[a-z]{3})*(?![a-z])")


def lexical_logits(cleaned: Column) -> Column:
    """Stand-in logits (positive, negative, neutral) from word classes:
    a lower-case word of length L counts as positive when L % 3 == 0,
    negative when L % 3 == 1, neutral otherwise; counts scaled by
    1/sqrt(1 + words). Regex counts in the JVM: no per-row arrays."""
    low = F.lower(cleaned)
    scale = F.sqrt(F.regexp_count(low, F.lit("[a-z]+")) + F.lit(1.0))
    return F.array(*[F.regexp_count(low, F.lit(p)) / scale for p in _WORD_CLASS])


def score_articles(articles: DataFrame, logits_fn: Callable[[Column], Column] = lexical_logits,
                   normalize: bool = True) -> DataFrame:
    """Sentiment rows for articles (localDate, id, title, body)."""
    cleaned = articles.select("localDate", "id",
                              TX.clean_text(F.col("title"), F.col("body"), normalize).alias("_t"))
    # logits are projected once; the softmax reads the three values
    scored = cleaned.select("localDate", "id", "_t", logits_fn(F.col("_t")).alias("_l"))
    return scored.select(
        "localDate", "id",
        TX.softmax3(F.col("_l")[0], F.col("_l")[1], F.col("_l")[2]).cast("float")
          .alias("sentiment_score"),
        TX.text_length(F.col("_t")).alias("text_length"),
        TX.token_count(F.col("_t")).alias("token_count"))


def pandas_scorer(load_model: Callable[[], Callable[[list[str]], np.ndarray]],
                  batch_size: int = 48):
    """Wrap a batch classifier as an iterator pandas UDF returning logits.

    ``load_model()`` runs once per task (not per batch); the returned callable
    maps a list of texts to an (n, 3) logits array. Use with
    ``score_articles(df, logits_fn=pandas_scorer(loader))``.
    """
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            out = []
            values = texts.fillna("").tolist()
            for i in range(0, len(values), batch_size):
                out.extend(np.asarray(model(values[i:i + batch_size]), dtype=float).tolist())
            yield pd.Series(out, dtype=object)
    return _logits
