"""A fitted text classifier, applied in batches of a token budget.

``learn`` fits three-way log-odds (positive, negative, neutral) from labelled texts with Spark
aggregates: for each word, how many texts of each class hold it. A word weighs its smoothed
log-odds for a class against the rest where they stand out from chance (``GATE`` standard
errors) and 0 elsewhere; the ``VOCABULARY`` words that stand out most are kept, so the model
has a bounded size however much was labelled.

``budget_scorer`` applies any padded-batch model to whole texts: the texts of an Arrow batch are sorted
by their number of tokens and cut where the padded size would pass ``BUDGET``, so short texts
are not padded to the longest text of the batch; the scores go back in the order of the rows.

Defined results: a null or empty text has no tokens and scores the prior; a null label
does not count; texts are read whole; rows that repeat count each time; without labelled
texts the three classes are equal; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as TX

CLASSES = ("positive", "negative", "neutral")
GATE = 4.0               # standard errors by which a word's log-odds must stand out
VOCABULARY = 16_384      # words of a model
BUDGET = 65_536          # padded tokens of a batch
_WORD = re.compile(TX.TOKEN, re.ASCII)


def polarity_class(quality: Column, toxic: Column) -> Column:
    """Class number of a labelled text: toxic ones are negative, junk is neutral."""
    return F.when(toxic == 1, 1).when(quality == 1, 0).when(quality == 0, 2)


@dataclass(frozen=True)
class LogOdds:
    """Row k + 1 of ``weights`` belongs to ``words[k]``; row 0 is padding."""

    words: tuple[str, ...]
    weights: np.ndarray
    prior: np.ndarray

    def encode(self, text: str, place: dict[str, int]) -> np.ndarray:
        """The rows of a lower-cased text's distinct known words."""
        return np.array(sorted({place[w] for w in _WORD.findall(text) if w in place}), np.int64)

    def load(self) -> tuple[Callable[[str], np.ndarray], Callable[[np.ndarray], np.ndarray]]:
        place = {w: k + 1 for k, w in enumerate(self.words)}
        return (lambda t: self.encode(t, place),
                lambda padded: self.weights[padded].sum(axis=1) + self.prior)


def learn(labelled: DataFrame, gate: float = GATE, vocabulary: int = VOCABULARY) -> LogOdds:
    """The model of ``labelled(t, label)``: cleaned texts and class numbers (see ``CLASSES``)."""
    known = labelled.where(F.col("label").isNotNull()).select("label", F.array_distinct(
        F.regexp_extract_all(F.lower("t"), F.lit(TX.TOKEN), F.lit(0))).alias("words"))
    classes = range(len(CLASSES))
    count = [F.coalesce(F.sum((F.col("label") == c).cast("long")), F.lit(0)).alias(f"c{c}")
             for c in classes]
    n = known.agg(*count).first()
    total = sum(n)
    words = known.select("label", F.explode("words").alias("word")).groupBy("word").agg(*count)
    odds, error = [], []
    for c in classes:
        a = F.col(f"c{c}") + 0.5
        b = F.col("c0") + F.col("c1") + F.col("c2") - F.col(f"c{c}") + 0.5
        own, rest = n[c] + 1, total - n[c] + 1
        odds.append(F.log(a / (own - a)) - F.log(b / (rest - b)))
        error.append(F.sqrt(1 / a + 1 / b))
    words = words.select("word", *[o.alias(f"o{c}") for c, o in enumerate(odds)],
                         *[F.abs(o / e).alias(f"z{c}") for c, (o, e) in enumerate(zip(odds, error))])
    strongest = F.greatest(*[F.col(f"z{c}") for c in classes])
    kept = (words.where(strongest >= gate).orderBy(strongest.desc(), "word").limit(vocabulary)
            .select("word", *[F.when(F.col(f"z{c}") >= gate, F.col(f"o{c}")).otherwise(0.0)
                              .alias(f"w{c}") for c in classes])
            .collect())                                     # at most ``vocabulary`` rows
    weights = np.zeros((len(kept) + 1, len(CLASSES)))
    for k, r in enumerate(kept):
        weights[k + 1] = r[1:]
    prior = np.log((np.array(n) + 1.0) / (total + len(CLASSES)))
    return LogOdds(tuple(r.word for r in kept), weights, prior)


def budget_batches(lengths: np.ndarray, budget: int = BUDGET) -> list[np.ndarray]:
    """Places of the texts of each batch, shortest texts first: the longest text of a batch
    times its texts stays within ``budget``; a text longer than that is a batch alone."""
    order = np.argsort(lengths, kind="stable")
    sizes = np.maximum(lengths[order], 1)
    cuts, start = [], 0
    for k, size in enumerate(sizes.tolist()):
        if k > start and size * (k + 1 - start) > budget:
            cuts.append(k)
            start = k
    return [b for b in np.split(order, cuts) if len(b)]


def padding_share(lengths: np.ndarray, batches: list[np.ndarray]) -> float:
    """The part of the padded tokens that is padding."""
    padded = sum(int(lengths[b].max(initial=0)) * len(b) for b in batches)
    return 1 - int(lengths.sum()) / padded if padded else 0.0


def score_batch(texts: list[str], encode: Callable, forward: Callable,
                budget: int = BUDGET) -> np.ndarray:
    """(texts, classes) scores in the order of the texts."""
    ids = [encode(t) for t in texts]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    out = np.zeros((len(texts), len(CLASSES)))
    for batch in budget_batches(lengths, budget):
        padded = np.zeros((len(batch), int(lengths[batch].max())), np.int64)
        real = np.arange(padded.shape[1]) < lengths[batch][:, None]
        padded[real] = np.concatenate([ids[k] for k in batch])
        out[batch] = forward(padded)
    return out


def budget_scorer(load: Callable[[], tuple[Callable, Callable]],
                  budget: int = BUDGET) -> Callable[[Column], Column]:
    """Column function for ``score_articles``: cleaned text -> logits.

    ``load()`` runs once a task and returns ``encode`` (lower-cased text -> token rows, never 0)
    and ``forward`` (padded rows, 0 for padding -> scores)."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, forward = load()
        for texts in batches:
            found = score_batch(texts.fillna("").tolist(), encode, forward, budget)
            yield pd.Series(list(found), dtype=object)

    return lambda cleaned: logits(F.lower(cleaned))
