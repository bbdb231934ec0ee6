"""Normalisation in pieces: bounded memory in Python workers, the same results."""

import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.functions import text as TX

ODD = ["ﬁne é", None, "", "Ａ①", "plain", "ｶﾞ " * 300_000, None, "x" * 3_000_000]


def _size(texts):
    return sum(len(t.encode()) for t in texts if t is not None)


def test_pieces_are_bounded_and_keep_every_row():
    rows = ["é" * (k % 900) if k % 7 else None for k in range(20_000)]
    other = ["b" * (k % 50) for k in range(20_000)]
    parts = list(TX.text_pieces(pa.array(rows), pa.array(other), limit=10_000))
    assert [t for a, _ in parts for t in a.to_pylist()] == rows
    assert [t for _, b in parts for t in b.to_pylist()] == other
    assert all(len(a) == len(b) and _size(a.to_pylist()) + _size(b.to_pylist()) <= 10_000 for a, b in parts)
    alone = list(TX.text_pieces(pa.array(["a" * 30, "b", None, "c" * 30, None]), limit=10))
    assert [a.to_pylist() for (a,) in alone] == [["a" * 30], ["b", None], ["c" * 30], [None]]
    assert list(TX.text_pieces(pa.array([], pa.string()))) == []


def test_a_whole_batch_is_never_normalised_at_once():
    texts = ["ﬁ" * 300] * 20_000                       # 18 MB in one Arrow batch
    made = list(TX.nfkc.func(iter([pa.array(texts)])))
    assert len(made) > 10 and all(p.nbytes <= 2 * TX.PIECE_BYTES for p in made)
    assert sum(map(len, made)) == len(texts) and made[-1][-1].as_py() == "fi" * 300
    made = list(TX.nfkc_concat.func(iter([(pa.array(texts), pa.array(texts))])))
    assert len(made) > 20 and all(p.nbytes <= 2 * TX.PIECE_BYTES for p in made)
    assert sum(map(len, made)) == len(texts) and made[0][0].as_py() == "fi" * 600


def test_nfkc_of_odd_rows(spark):
    nf = lambda t: unicodedata.normalize("NFKC", t)
    d = spark.createDataFrame([(k, t, ODD[-1 - k]) for k, t in enumerate(ODD)],
                              "k int, t string, b string").repartition(1)
    got = {r.k: r for r in d.select("k", TX.nfkc("t").alias("n"), TX.nfkc_concat("t", "b").alias("c"),
                                    TX.clean_text(F.col("t"), F.lit(None)).alias("alone")).collect()}
    for k, t in enumerate(ODD):
        assert got[k].n == (None if t is None else nf(t))
        assert got[k].c == nf(t or "") + nf(ODD[-1 - k] or "")
    assert [got[k].alone for k in (0, 1, 2, 4)] == ["fine", "", "", "plain"]
    assert d.limit(0).select(TX.nfkc("t")).collect() == []


def _sent_to_python(df):
    """Bytes that the query's Python steps were sent, and its rows."""
    rows = df.collect()

    def sent(plan):
        metric = plan.metrics().get("pythonDataSent")
        kids = plan.children()
        return ((metric.get().value() if metric.isDefined() else 0)
                + sum(sent(kids.apply(k)) for k in range(kids.size())))

    return sent(df._jdf.queryExecution().executedPlan()), rows


def test_ascii_rows_do_not_cross_into_python(spark):
    k = F.col("id")
    d = spark.range(0, 4000, 1, 2).select(
        "id", F.when(k % 100 == 1, "ﬁne").when(k % 7 != 3, "Fine").alias("title"),
        F.when(k % 11 != 5, F.concat(F.repeat(F.lit("word "), 400), k.cast("string"))).alias("body"))
    sent, rows = _sent_to_python(d.select("id", TX.clean_text(F.col("title"), F.col("body")).alias("t")))
    assert sent < 500_000                              # 8 MB of text, 40 rows of 2 kB to normalise
    for r in rows:
        title = "fine" if r.id % 100 == 1 else "Fine" if r.id % 7 != 3 else ""
        body = "word " * 400 + str(r.id) if r.id % 11 != 5 else ""
        assert r.t == title + body


def test_clean_text_is_the_same_by_either_way(spark):
    odd = [*ODD[:5], "é", "\U0001d400 b", "tab\there", "Ω", "\x7f\x00", " "]
    d = spark.createDataFrame([(a, b) for a in odd for b in odd], "t string, b string").repartition(3)
    both = d.select("t", "b", TX.normal_concat(F.col("t"), F.col("b")).alias("n"),
                    TX.nfkc_concat("t", "b").alias("c"))
    assert all(r.n == r.c for r in both.collect()) and both.count() == len(odd) ** 2
