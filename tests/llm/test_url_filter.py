import re

import numpy as np
import pytest

from tidemark.llm import url_filter as U

URLS = [None, "", "no scheme", "http://a.org", "http://a.org/x", "HTTPS://Sub.Example.ORG/es/1?q",
        "http://example.org/en/12#f", "http://badexample.org/es/", "http://x.com/fr/1", "http://com/de/",
        "http://xcom/de/", "http://n.net/p?a=1", "http://N.net/p#b", "http://n.net/p/", "http://n.net",
        "ftp://n.net?x://y", "://h.net/a", "a b://c.net/é\nz", "http://user@x.com:80/fr/"]


def brute(rows):
    parts = []
    for _, url in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url) if url else None
        low = {i: i + 32 for i in range(65, 91)}
        parts.append((m[1].translate(low), m[2]) if m else ("", ""))
    out = []
    for (page, _), (host, path) in zip(rows, parts):
        fits = [(r, v) for r, v in U.RULES
                if f".{host}".endswith("." + r.partition("/")[0])
                and path.startswith("/" + r.partition("/")[2])]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
        if verdict is None:
            same = [p for (p, _), q in zip(rows, parts) if q == (host, path)]
            known = [p for p in same if p is not None]
            first = min(known, default=None)
            verdict = "block" if host and len(same) > 1 and page != first else "allow"
        out.append((page, host, path, rule, verdict))
    return out


def sort(rows):
    return sorted(map(tuple, rows), key=lambda t: tuple((x is None, x) for x in t))


def test_judge_matches_brute_force(spark):
    rows = [(k, u) for k, u in enumerate(URLS)] + [(None, "http://n.net/p"), (11, URLS[11])]
    rows += [(None, "http://nobody.net/"), (None, "http://nobody.net/")]      # only null ids
    rows += [(-1, "http://minus.net/"), (3, "http://minus.net/"), (-1, "http://nobody.net/x")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "page_id long, url string, host int, verdict int")
    assert sort(U.judge(df).collect()) == sort(brute(rows))
    assert U.judge(df.where("false")).count() == 0


def test_given_list(spark):
    df = spark.createDataFrame([(1, "http://n.net/a"), (2, "http://n.net/b"), (3, None)],
                               "page_id long, url string")
    listed = spark.createDataFrame([("n.net/a", None), ("n.net/c", None), (None, None)],
                                   "entry string, value long")
    got = {r["page_id"]: r["verdict"] for r in U.judge(df, listed).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


def test_collisions_never_count():
    array = U.DigestArray()
    array.append(np.array([5, 5, 9]), [b"one", b"two", b""], [1, 2, 3])
    array.append(np.array([12, 13]), [b"last", b"none"], [4, None])
    probes = [(5, b"two"), (5, b"three"), (5, b"one"), (9, b""), (7, b"one"), (12, b"last"), (13, b"none")]
    hits, found = array.probe(np.array([k for k, _ in probes]), [s for _, s in probes])
    assert (hits, found) == ([0, 2, 3, 5, 6], [2, 1, 3, 4, None])
    array.clear()
    assert array.probe(np.array([5]), [b"two"]) == ([], [])


@pytest.mark.parametrize("bits", [0, 3, 12])
def test_many_entries(spark, monkeypatch, bits):
    monkeypatch.setattr(U, "SHARD_BITS", max(bits, 1))
    entries = spark.range(4000).selectExpr("concat('h/', id % 3000) AS entry")
    listed = spark.range(0, 6000, 2).selectExpr("concat('h/', id) AS entry", "id AS value")
    got = {r["entry"]: r["value"] for r in U.listed_among(entries, listed).collect()}
    assert got == {f"h/{k}": k for k in range(0, 3000, 2)}
