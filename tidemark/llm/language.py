"""Language identification with per-word scores and a Viterbi pass.

A model is learned from labelled rows: per language the counts of character
trigrams, hashed into a fixed number of slots, and the share of words that use
each script range. For a word, the script ranges of its letters leave a few
candidate languages; its trigrams give the log-odds between them. A Viterbi
pass over the words with a penalty for each switch labels the spans of a
mixed-language text. The language of a text is the one with most words.

Bounded sample: the model is fitted on about ``TRAIN_DOCS`` rows of each
language, drawn evenly by a hash of the row (every row, while a language has
fewer). Prediction reads every word of every text.

A letter is what Unicode's category L holds; combining marks stay with their letter.

Defined results: null text, or one without a letter, is ``und`` with score 0
and no spans; with no labelled row everything is ``und``; letters of no learned
script give the most frequent learned language with score 0; ties go to the
language that sorts first; null ids and repeated rows are carried as they are;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_DOCS = 4_000        # labelled rows of each language that fit the model
SLOTS = 1 << 17           # hashed trigrams
MIN_RANGE_SHARE = 0.01    # of a language's words, to count a script range as its own
SWITCH = 6.0              # penalty of a language change, in nats
FLOOR = -9.0              # lowest log-odds that one word can carry
CACHE_WORDS = 300_000     # distinct words a task remembers at once
BLOCK = 16_384            # new words that are scored together

#: First code point of each script range; a range ends where the next begins.
RANGES = (
    (0x0000, "basic latin"), (0x0080, "latin supplement"), (0x0100, "latin extended"),
    (0x0250, "phonetic"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "south asian"), (0x0E00, "thai and lao"),
    (0x0F00, "tibetan and burmese"), (0x10A0, "georgian"), (0x1100, "hangul letters"),
    (0x1200, "other"), (0x1E00, "latin additional"), (0x1F00, "greek extended"),
    (0x2000, "signs"), (0x3040, "kana"), (0x3400, "han"), (0xA000, "yi and others"),
    (0xAC00, "hangul"), (0xD800, "forms"), (0x20000, "han supplement"))
STARTS = [first for first, _ in RANGES]

#: A word: letters, each with the marks that belong to it. Fractions, superscripts and
#: other numbers are no letters.
PLAIN = re.compile("[a-z]+")
LETTERS = regex.compile(r"(?:\p{L}\p{M}*+)++")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    text = text.lower()
    return (PLAIN if text.isascii() else LETTERS).findall(text)


def script_ranges(word: str) -> int:
    """Bit set of the script ranges of a word's letters."""
    if word.isascii():
        return 1
    bits = 0
    for c in set(word):
        bits |= 1 << (bisect_right(STARTS, ord(c)) - 1)
    return bits


def slots(word: str) -> list[int]:
    """The hashed trigrams of a word with its two ends marked."""
    data = f"\x02{word}\x03"
    return [zlib.crc32(data[i:i + 3].encode("utf-8", "surrogatepass")) & (SLOTS - 1)
            for i in range(max(1, len(data) - 2))]


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray                 # SLOTS x languages: log P(trigram | language)
    ranges: np.ndarray               # ranges x languages: the language uses the range
    common: int                      # most frequent language


class Words(dict):
    """Row number of each distinct word; new words are scored together."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model, self.new = model, []
        self.scores = np.zeros((0, len(model.languages)), np.float32)
        self.known = np.zeros(0, bool)

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def score(self) -> None:
        """Log-odds of the new words over their candidates, some thousands at a time."""
        made = [self._odds(self.new[a:a + BLOCK]) for a in range(0, len(self.new), BLOCK)]
        self.scores = np.concatenate([self.scores, *[m[0] for m in made]])
        self.known = np.concatenate([self.known, *[m[1] for m in made]])
        self.new = []

    def _odds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        model = self.model
        grams = [slots(w) for w in words]
        sizes = np.fromiter(map(len, grams), np.int64, len(grams))
        flat = np.fromiter((s for g in grams for s in g), np.int64, int(sizes.sum()))
        sums = np.add.reduceat(model.logs[flat], np.r_[0, sizes.cumsum()[:-1]], axis=0)
        bits = np.fromiter(map(script_ranges, words), np.int64, len(words))
        used = (bits[:, None] >> np.arange(len(RANGES))) & 1 > 0
        every = ~(used[:, :, None] & ~model.ranges[None]).any(axis=1)
        some = (used[:, :, None] & model.ranges[None]).any(axis=1)
        candidates = np.where(every.any(axis=1, keepdims=True), every, some)
        known = candidates.any(axis=1)
        sums = np.where(candidates, sums, -np.inf)
        top = np.where(known, sums.max(axis=1), 0)[:, None]
        with np.errstate(invalid="ignore", divide="ignore"):
            odds = sums - top - np.log(np.exp(sums - top).sum(axis=1, keepdims=True))
        odds = np.where(known[:, None], np.maximum(odds, FLOOR), 0)
        return odds.astype(np.float32), known


def viterbi(scores: np.ndarray, ids: np.ndarray, sizes: np.ndarray,
            penalty: float = SWITCH) -> np.ndarray:
    """Best label of every word; texts lie one after another in ``ids``.

    All texts advance one word at a time together, longest first, so that those
    still running are always the first rows.
    """
    starts = np.r_[0, sizes.cumsum()[:-1]]
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    n = scores.shape[1]
    labels = np.zeros(len(ids), np.int32)
    if n == 1 or not len(ids):
        return labels
    running = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    # the smallest type that holds every language
    kind = np.min_scalar_type(n)
    before = np.empty((len(ids), n), kind)
    stay = np.arange(n, dtype=kind)
    best = np.zeros((len(sizes), n))
    for t, live in enumerate(running):
        at = starts[:live] + t
        now = best[:live]
        if t:
            top = now.argmax(axis=1)
            moved = now[np.arange(live), top][:, None] - penalty
            keep = now >= moved
            before[at] = np.where(keep, stay, top[:, None].astype(kind))
            now = np.where(keep, now, moved)
        best[:live] = now + scores[ids[at]]
    state = best.argmax(axis=1)
    for t in range(len(running) - 1, -1, -1):
        at = starts[:running[t]] + t
        labels[at] = state[:running[t]]
        if t:
            state[:running[t]] = before[at, state[:running[t]]]
    return labels


def label_texts(texts: Iterable[str | None], table: Words, spans: bool) -> list[tuple]:
    """(language, score, spans) of each text."""
    model = table.model
    n = len(model.languages)
    # words become numbers text by text, so only distinct words stay as strings
    number = table.__getitem__
    rows = [np.fromiter(map(number, words_of(t)), np.int32) for t in texts]
    if not n or not rows:
        table.clear()
        table.new = []
        return [("und", 0.0, [])] * len(rows)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    ids = np.concatenate(rows)
    del rows
    table.score()
    some = np.flatnonzero(sizes)
    labels = viterbi(table.scores, ids, sizes[some])
    first = np.r_[0, sizes.cumsum()]
    votes = np.zeros((len(sizes), n), np.int64)
    for lang in range(n):
        won = np.r_[0, (table.known[ids] & (labels == lang)).cumsum()]
        votes[:, lang] = won[first[1:]] - won[first[:-1]]
    out = []
    for k in range(len(sizes)):
        if not sizes[k]:
            out.append(("und", 0.0, []))
            continue
        counted = int(votes[k].sum())
        top = int(votes[k].argmax()) if counted else model.common
        parts = []
        if spans:
            own = labels[first[k]:first[k + 1]]
            cuts = np.r_[0, np.flatnonzero(np.diff(own)) + 1, len(own)]
            parts = [{"first_word": int(a), "words": int(b - a), "lang": model.languages[own[a]]}
                     for a, b in zip(cuts, cuts[1:])]
        out.append((model.languages[top], float(votes[k, top] / max(counted, 1)), parts))
    if len(table) > CACHE_WORDS:
        table.clear()
        table.scores, table.known = table.scores[:0], table.known[:0]
    return out


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (lang, kind, slot, n); kind 0 trigrams, 1 ranges, 2 words."""
    grams, ranges, words = defaultdict(Counter), defaultdict(Counter), Counter()
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in Counter(words_of(text)).items():
                words[lang] += n
                for s in slots(word):
                    grams[lang][s] += n
                bits = script_ranges(word)
                for r in range(len(RANGES)):
                    if bits >> r & 1:
                        ranges[lang][r] += n
    rows = [(lang, 0, s, n) for lang, c in grams.items() for s, n in c.items()]
    rows += [(lang, 1, r, n) for lang, c in ranges.items() for r, n in c.items()]
    rows += [(lang, 2, 0, n) for lang, n in words.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in
         enumerate((pa.string(), pa.int32(), pa.int32(), pa.int64()))],
        ["lang", "kind", "slot", "n"])


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          train_docs: int = TRAIN_DOCS) -> Model:
    """Fit the model; the driver gets at most SLOTS sums of each language.

    Rows are drawn by ``key``, so that copies of one text are drawn one by one."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    sizes = {r["lang"]: r["n"] for r in
             rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    shape = (SLOTS, len(languages))
    if not languages:
        return Model([], np.zeros(shape, np.float32), np.zeros((len(RANGES), 0), bool), 0)
    # a row is drawn when its hash falls in its language's share of 1,000,000
    share = F.create_map(*[x for k, n in sizes.items() for x in
                           (F.lit(k), F.lit(int(1e6 * min(1.0, train_docs / n)) + 1))])
    drawn = rows.where(F.pmod(F.xxhash64("key", F.lit("draw")), F.lit(1_000_000))
                       < F.element_at(share, F.col("lang")))
    sums = (drawn.mapInArrow(_counts, "lang string, kind int, slot int, n long")
            .groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")).toPandas())
    grams, ranges = np.zeros(shape), np.zeros((len(RANGES), len(languages)))
    words = np.ones(len(languages))
    place = sums["lang"].map(languages.index).to_numpy(np.int64)
    kind, slot, n = (sums[c].to_numpy() for c in ("kind", "slot", "n"))
    grams[slot[kind == 0], place[kind == 0]] = n[kind == 0]
    ranges[slot[kind == 1], place[kind == 1]] = n[kind == 1]
    words[place[kind == 2]] = n[kind == 2]
    logs = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * SLOTS)).astype(np.float32)
    return Model(languages, logs, ranges >= MIN_RANGE_SHARE * words,
                 max(range(len(languages)), key=lambda k: sizes[languages[k]]))


def label(docs: DataFrame, model: Model, text: str = "text", spans: bool = True,
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) plus lang_pred, score and, if wanted, spans.

    ``text`` names the text column, or a field of a struct as ``column.field``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SLOTS x languages
    names = docs.columns if keep is None else keep
    added = [("lang_pred", pa.string(), T.StringType()), ("score", pa.float64(), T.DoubleType())]
    if spans:
        added.append(("spans", pa.list_(pa.struct(
            [("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())])),
            T.ArrayType(T.StructType([
                T.StructField("first_word", T.IntegerType()),
                T.StructField("words", T.IntegerType()), T.StructField("lang", T.StringType())]))))
    column, _, inner = text.partition(".")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Words(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column))
            texts = texts.field(inner) if inner else texts
            each = (t for at in range(0, len(texts), 512) for t in texts.slice(at, 512).to_pylist())
            found = label_texts(each, table, spans)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in names], *[pa.array([f[i] for f in found], kind)
                                   for i, (_, kind, _) in enumerate(added)]],
                [*names, *[a[0] for a in added]])

    schema = T.StructType([*[docs.schema[c] for c in names], *[T.StructField(n, t) for n, _, t in added]])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Fold 2 of 4 by CRC-32 of the id as text; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, spans: bool = False, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score (and spans) of every row; the model is
    learned from the rows outside the held-out fold."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = learn(docs.where(fold != 2), train_docs=train_docs)
    out = label(docs.select("doc_id", "text", held_out().alias("held_out")), model, spans=spans,
                keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", *(["spans"] if spans else []))


#: A text is kept when its language covers at least this share of its words.
KEEP_SCORE = 0.5


def keep_identified(docs: DataFrame, min_score: float = KEEP_SCORE) -> DataFrame:
    """The rows whose language is known and covers ``min_score`` of the words."""
    model = learn(docs)
    marked = label(docs.select(F.struct("*").alias("_row")), model, "_row.text", spans=False)
    return marked.where((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select(
        "_row.*")
