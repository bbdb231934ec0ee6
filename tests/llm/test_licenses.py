import re
import time

import pytest

from tidemark.llm import licenses as L


def brute(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in L.BASE.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i:i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


TEXTS = ["MIT License", "mit\nlicense, the MIT-LICENSE!", "cc by cc by 4.0", "cc-by-sa", "submit license",
         "the GNU General Public License and Apache License", "gnu general public  licenses",
         "éMIT License mit license", "mit license" * 3, None, "",
         "SPDX-License-Identifier: MIT OR Apache-2.0 */\nmit license"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_places(text):
    assert L.scan((text or "").encode(), L.automaton())[:5] == brute(text)


@pytest.mark.parametrize("expression, ids, grade", [
    ("MIT", ["mit"], 1.0), ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only"], 1.0),
    ("MIT AND GPL-3.0-only", ["mit", "gpl-3.0-only"], 0.3),
    ("MIT or GPL-2.0+ and MPL-2.0", ["mit", "gpl-2.0+", "mpl-2.0"], 1.0),
    ("(MIT OR GPL-2.0) AND LGPL-2.1", ["mit", "gpl-2.0", "lgpl-2.1"], 0.6),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", ["gpl-2.0-or-later"], 0.6),
    ("LicenseRef-own AND MIT", ["licenseref-own", "mit"], 0.0),
    # prose after the expression, and what cannot go on with it
    ("MIT This file is free.", ["mit"], 1.0), ("MIT.", ["mit"], 1.0), ("MIT OR", ["mit"], 1.0),
    ("MIT OR ISC: see LICENSE", ["mit", "isc"], 1.0), ("MIT)", ["mit"], 1.0),
    ("MIT Apache-2.0", ["mit"], 1.0), ("MIT (ISC)", ["mit"], 1.0), ("MIT && ISC", ["mit"], 1.0),
    ("MIT AND (ISC", ["mit"], 1.0), ("(MIT OR GPL-2.0) WITH x", ["mit", "gpl-2.0"], 1.0),
    ("GPL-2.0 WITH a WITH b", ["gpl-2.0"], 0.6), ("GPL-2.0 WITH (a)", ["gpl-2.0"], 0.3)])
def test_expressions(expression, ids, grade):
    assert L.evaluate(expression) == (ids, grade)


@pytest.mark.parametrize("bad", ["", "AND MIT", "(MIT", "()", "&& ISC", "...", "(MIT OR ISC AND"])
def test_malformed(bad):
    assert L.evaluate(bad) is None


def test_tags_and_score():
    row = L.scan(b"// SPDX-License-Identifier: (MIT OR ISC)\n# spdx-license-identifier: (MIT OR\n",
                 L.automaton())
    assert row[5] == "spdx-malformed,spdx:isc,spdx:mit" and row[6:] == (1.0, 1.0)
    assert L.scan(b"mit license, mozilla public license", L.automaton())[5:] == (
        "mit,mpl", 0.75, None)
    assert L.scan(b"nothing", L.automaton())[1:] == (0, None, None, "", "", 0.0, None)


def test_a_long_notice_text_takes_time_in_proportion():
    notice = b"word the mit license and apache license, cc by gnu general public license "
    found, times = L.automaton(), []
    for n in (8_000, 64_000):                        # 0.6 and 4.8 MB
        start = time.process_time()
        row = L.scan(notice * n, found)
        times.append(time.process_time() - start)
        assert row[:5] == (13 * n, 4 * n, 2, 13 * n - 4, "apache,cc-by,gpl,mit")
    assert times[1] < 30 * times[0] and times[1] < 20


def test_awkward_documents(docs, empty):
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"],
            r["base_labels"]) for r in L.license_scan(docs).collect()]
    want = [(r["doc_id"], *brute(r["text"])) for r in docs.collect()]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert L.license_scan(empty).count() == 0
