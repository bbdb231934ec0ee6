"""The stages one after another against brute force over their own inputs."""

import importlib.util
from collections import Counter

import pytest

from .conftest import prose
from .test_packing import check
from .test_quality import brute as counts
from .test_simhash import brute_fingerprint, brute_roots

corpus_pipeline = pytest.importorskip("corpus_pipeline") if importlib.util.find_spec(
    "corpus_pipeline") else None
pytestmark = pytest.mark.skipif(corpus_pipeline is None, reason="no pipeline")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    texts = [prose(k, 60 + 5 * k) for k in range(30)]
    texts += [texts[3], texts[3], texts[4] + " tail", "short", None, "", "12 34 " * 60,
              "word again and " * 40]
    df = spark.createDataFrame([(k, t, "en", f"s{k % 2}", len(t or "")) for k, t in
                                enumerate(texts)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    path = str(tmp_path_factory.mktemp("corpus"))
    df.write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "near_dedup", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, corpus)
    assert good.columns == docs.columns
    want = {r["doc_id"] for r in docs.collect() if counts(r["text"])[0] >= 50
            and 100 * counts(r["text"])[4] <= 50 * counts(r["text"])[0]}
    assert {r["doc_id"] for r in good.collect()} == want
    known = stage["language_id"](spark, good, corpus)
    assert {r["doc_id"] for r in known.collect()} == {
        r["doc_id"] for r in good.collect() if any(c.isalpha() for c in r["text"])}
    rows = sorted(known.select("doc_id", "text").collect())
    roots = brute_roots([brute_fingerprint(r["text"]) for r in rows], 3)
    single = stage["near_dedup"](spark, known, corpus)
    assert single.columns == docs.columns
    assert {r["doc_id"] for r in single.collect()} == {rows[k]["doc_id"] for k in set(roots)}
    packed = stage["packing"](spark, single, corpus)
    check(packed.collect(), [r["text"] for r in single.collect()])
    whole = corpus_pipeline.run(spark, corpus)
    key = ("doc_id", "start", "length", "ids_crc32")
    assert Counter(map(tuple, whole.select(*key).collect())) == Counter(
        map(tuple, packed.select(*key).collect()))


def test_empty(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where("false")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
