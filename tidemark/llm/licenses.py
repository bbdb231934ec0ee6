"""License scans: notice phrases by Aho-Corasick, identifier tags by shunting-yard.

A text is lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``;
one automaton then finds, in one pass over the words joined by spaces, the base
phrases, further notice phrases and the words of an SPDX identifier tag. Where
the tag's words occur, the lines of the text that hold ``SPDX-License-Identifier:``
are read: the expression goes through a shunting-yard parser (``WITH`` binds
closer than ``AND``, ``AND`` closer than ``OR``; it reads the longest beginning of
the line that is an expression, so prose may follow) and is evaluated to a grade from 0
(unknown terms) to 1 (permissive): ``AND`` takes the lower grade, ``OR`` the
higher, ``WITH`` an exception lifts copyleft to the weak grade.

``labels`` holds the base labels, the labels of further phrases, ``spdx:<id>`` for
each id of a well-formed tag, and ``spdx-malformed``. ``score`` is the evidence
that the text names a licence: 1 with a well-formed tag, else ``1 - 0.5 ** places``
over all phrases found. ``grade`` is the lowest grade of the tags, else null.

Defined results: null text is empty; no places give null positions and empty
label strings; overlapping places all count; repeated rows and null ids are
carried; an empty table gives an empty result; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import pieces, utf8

# --- fixed values -----------------------------------------------------------
BASE = {"gnu general public license": "gpl", "apache license": "apache",
        "cc by": "cc-by", "mit license": "mit"}
NOTICES = {
    "gnu affero general public license": "agpl", "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd", "isc license": "isc",
    "boost software license": "bsl", "creative commons attribution": "creative-commons",
    "cc0": "cc0", "public domain": "public-domain", "unlicense": "unlicense",
    "all rights reserved": "reserved"}
TAG = "spdx license identifier"
PERMISSIVE = ("0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "bsl-1.0", "cc-by-4.0",
              "cc0-1.0", "isc", "mit", "unlicense", "zlib")
WEAK = ("cddl-1.0", "epl-2.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0")
STRONG = ("agpl-3.0", "cc-by-sa-4.0", "gpl-2.0", "gpl-3.0")
GRADE = {"permissive": 1.0, "weak": 0.6, "strong": 0.3, "unknown": 0.0}
BINDS = {"OR": 1, "AND": 2, "WITH": 3}
# ----------------------------------------------------------------------------

#: Every ASCII byte that belongs to no word becomes a space; A-Z become a-z.
FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
             else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
TAG_LINE = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
TERM = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+|[^\s]")
CLOSING = ("*/", "-->", "#}")
#: Kinds of terms that may come after each kind; an exception follows one id.
FOLLOWS = {"id": (")", "OR", "AND", "WITH"), "exception": (")", "OR", "AND"), ")": (")", "OR", "AND"),
           "(": ("(", "id"), "OR": ("(", "id"), "AND": ("(", "id"), "WITH": ("id",)}


def beginning(expression: str) -> list[str]:
    """The terms of the longest beginning that is an expression; a sentence's full
    stop or colon after an id is no part of it."""
    terms = [t.rstrip(".:") or t for t in TERM.findall(expression)]
    good, depth, before = 0, 0, "("      # before: what kind of term came last
    for k, term in enumerate(terms):
        kind = (term if term in "()" else term.upper() if term.upper() in BINDS
                else "id" if term[0].isalnum() else "?")
        if kind not in FOLLOWS[before]:
            break
        depth += (kind == "(") - (kind == ")")
        if depth < 0:
            break
        before = "exception" if before == "WITH" else kind
        if not depth and before in ("id", "exception", ")"):
            good = k + 1
    return terms[:good]


def postfix(expression: str) -> list[str]:
    """Postfix order of the licence expression that a text begins with; empty when it
    begins with none."""
    out, waiting = [], []
    for term in beginning(expression):
        name = term.upper()
        if term == "(":
            waiting.append(term)
        elif term == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif name in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[name]:
                out.append(waiting.pop())
            waiting.append(name)
        else:
            out.append(term)
    return out + waiting[::-1]


def grade_of(term: str) -> float:
    name = re.sub(r"(-only|-or-later|\+)$", "", term.lower())
    kind = ("permissive" if name in PERMISSIVE else "weak" if name in WEAK
            else "strong" if name in STRONG else "unknown")
    return GRADE[kind]


def evaluate(expression: str) -> tuple[list[str], float] | None:
    """Licence ids and grade of an expression; None when it is malformed."""
    terms = postfix(expression)
    if not terms:
        return None
    ids, stack = [], []
    for term in terms:
        if term not in BINDS:
            stack.append(grade_of(term))
            ids.append(term.lower())
            continue
        b, a = stack.pop(), stack.pop()
        if term == "WITH":
            ids.pop()                        # the exception was read last
            stack.append(max(a, GRADE["weak"]) if a else a)
        else:
            stack.append(min(a, b) if term == "AND" else max(a, b))
    return ids, stack[0]


def automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(text: bytes, found) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, grade)."""
    words = text.translate(FOLD).split(b" ")
    words = [w for w in words if w] if b"" in words else words
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    places, extra, base, labels = [], 0, set(), set()
    tag, at, before = False, 0, 0           # ``before`` spaces lie before ``at``
    for end, phrase in found.iter(line):
        if phrase in BASE:
            base.add(BASE[phrase])
            start = end - len(phrase) - 1
            before += (line.count(" ", at, start) if start >= at
                       else -line.count(" ", start, at))
            at = start
            places.append(before)
        elif phrase == TAG:
            tag = True
        else:
            labels.add(NOTICES[phrase])
            extra += 1
    grade = None
    if tag:
        for expression in TAG_LINE.findall(text.decode("utf-8", "replace")):
            for mark in CLOSING:
                expression = expression.split(mark)[0]
            result = evaluate(expression)
            if result is None:
                labels.add("spdx-malformed")
            else:
                labels.update(f"spdx:{i}" for i in result[0])
                grade = result[1] if grade is None else min(grade, result[1])
    score = 1.0 if grade is not None else 1 - 0.5 ** (len(places) + extra)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), score, grade)


COLUMNS = (("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
           ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
           ("score", pa.float64()), ("grade", pa.float64()))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id and the findings of every row."""
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in batches:
            for part in pieces(batch, "text"):
                made = [scan(t, found) for t in utf8(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array([m[i] for m in made], t)
                                        for i, (_, t) in enumerate(COLUMNS)],
                    ["doc_id"] + [n for n, _ in COLUMNS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, "
                           "last_word long, base_labels string, labels string, score double, "
                           "grade double")
