import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.sql import QUALITY

from .conftest import prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    again = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(again))


def test_counts_match_brute_force(docs):
    got = quality.quality_rules(docs).collect()
    want = [(r["doc_id"], *brute(r["text"])) for r in docs.collect()]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((r["doc_id"], *(r[c] for c in quality.COUNTS)) for r in got), key=key) == \
        sorted(want, key=key)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or
                                    100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_boilerplate_depletes_but_copies_do_not(spark):
    banner = " ".join(f"banner{i}" for i in range(60))
    rows = [(i, f"{banner}\n{prose(100 + i, 14)}", "a") for i in range(40)]      # depleted
    rows += [(100 + i, f"{banner}\n{prose(200 + i, 90)}", "a") for i in range(40)]
    rows += [(200 + i, prose(7, 120), "a") for i in range(60)]                   # exact copies
    rows += [(300, f"{banner}\n{prose(300, 14)}", "b")]                          # another host
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality.quality_rules(df).where("kept").collect()}
    assert kept == set(range(100, 140)) | set(range(200, 260)) | {300}


def test_sql_counts_whole_sets(spark):
    """The registered SQL and the rows agree where different documents share several
    lines, which made the SQL of an earlier rule undercount."""
    rng = random.Random(5)
    shared = [f"shared line {chr(97 + i)} of the host" for i in range(18)]
    rows = [(i, "\n".join(rng.sample(shared, 9) + [prose(1000 + i, rng.choice([12, 60]))]),
             "h" if i % 4 else None) for i in range(400)]
    rows += [(400 + i, rows[0][1], "h") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    rel = con.sql(QUALITY)
    got = quality.quality_rules(df).select(*rel.columns).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())
    assert sum(r["removed_words"] > 0 for r in got) > 400


def test_keep_good_keeps_rows_whole(docs, empty):
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    kept = quality.quality_rules(docs).where("kept").count()
    assert out.count() == kept
    assert quality.keep_good(empty).count() == 0
    assert quality.quality_rules(empty).count() == 0


def test_native_plan(docs):
    plan = quality.base_counts(docs.select("text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_all_null_columns(spark):
    df = spark.range(3).select(*[F.lit(None).cast(t).alias(c) for c, t in
                                 (("doc_id", "long"), ("text", "string"), ("source", "string"))])
    rows = quality.quality_rules(df).collect()
    assert len(rows) == 3 and all(r["base_failed"] and not r["kept"] for r in rows)


def test_different_documents_sharing_many_lines(spark):
    """Removed words equal a brute-force count of different documents a line."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    line = lambda: " ".join(word() for _ in range(12))
    shared, head, foot = [line() for _ in range(18)], line(), line()
    texts = [rng.sample(shared, 9) for _ in range(200)]                        # menus
    texts += [[head, *[line() for _ in range(k % 3 + 4)], foot] for k in range(30)]
    texts += [texts[0]] * 40 + [[line(), *texts[200][1:]]] * 40                # exact copies
    rows = [(i, "\n".join(t), "a") for i, t in enumerate(texts)]
    holders = Counter(x for t in {frozenset(t) for t in texts} for x in t)
    often = {x for x, n in holders.items() if n > quality.LINE_DOCS}
    assert often == {*shared, head, foot}
    want = {i: sum(12 for x in t if x in often) for i, t in enumerate(texts)}
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    assert {i: r["removed_words"] for i, r in got.items()} == want
    assert {i for i, r in got.items() if r["kept"]} == \
        set(range(200, 230)) | set(range(270, 310))
