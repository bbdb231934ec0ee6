"""Token counts by a unigram model, with one forward pass over a trie of words.

The pieces of a public vocabulary get unigram scores by their rank (Zipf's law:
``-ln(rank + 1)``). A text is cut at white space, each word with the mark of a
word start is split into the pieces of the highest total score, and the number
of pieces is added up. A character that is no piece is spelled in bytes: one token for
each, at the score ``UNKNOWN`` a byte. Of equal scores the fewer tokens win.

The distinct words of a batch form a trie. The forward scores (best score and
count of every prefix) depend on the prefix alone, so they are computed once for
each trie node; sorted order walks the trie depth first, with the scores of the
current path on a stack, and each word's end stores its count. Counts are kept
in a bounded cache between the batches of a task. Nothing is shuffled.

Defined results: null or blank text has no words and no tokens; repeated rows
and null ids are carried; an empty table gives an empty result; other columns
are ignored; texts are counted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import pieces, utf8

START = "▁"          # the vocabulary's mark of a word start
UNKNOWN = -20.0           # score of one spelled byte
CACHE_WORDS = 600_000     # distinct words a task remembers at once


@lru_cache(maxsize=2)
def piece_scores(path: str) -> dict[str, float]:
    """Score of each piece by its rank; control and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                     or model.is_unused(i))]
    return {p: -math.log(rank + 2) for rank, p in enumerate(plain)}


class WordTrie:
    """Forward scores over the trie of the words that are added together."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        # endings of pieces: a backward walk ends where no piece ends like this
        self.endings = {p[i:] for p in scores for i in range(len(p))}

    def counts(self, words: list[str]) -> list[tuple[int, float]]:
        """(tokens, score) of each word, in the order given."""
        order = sorted(range(len(words)), key=words.__getitem__)
        terminal: list[tuple[int, float]] = [(0, 0.0)] * len(words)
        scores, endings = self.scores, self.endings
        before, best, used = "", [0.0], [0]
        for k in order:
            word = START + words[k]
            depth, most = 0, min(len(before), len(word))
            while depth < most and before[depth] == word[depth]:
                depth += 1
            del best[depth + 1:], used[depth + 1:]
            for end in range(depth + 1, len(word) + 1):
                top, n = -math.inf, 0
                for start in range(end - 1, -1, -1):
                    piece = word[start:end]
                    if piece not in endings:
                        break
                    own = scores.get(piece)
                    if own is not None:
                        total, count = best[start] + own, used[start] + 1
                        if total > top or total == top and count < n:
                            top, n = total, count
                if word[end - 1] not in scores:
                    spelled = len(word[end - 1].encode("utf-8", "surrogatepass"))
                    total, count = best[end - 1] + UNKNOWN * spelled, used[end - 1] + spelled
                    if total > top or total == top and count < n:
                        top, n = total, count
                best.append(top)
                used.append(n)
            terminal[k] = (used[-1], best[-1])
            before = word
        return terminal


class Counted(dict):
    """Number of each distinct word; new words wait to be counted together."""

    def __init__(self, trie: WordTrie) -> None:
        super().__init__()
        self.trie, self.new = trie, []
        self.tokens, self.score = np.zeros(0, np.int64), np.zeros(0)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def count(self) -> None:
        if self.new:
            made = self.trie.counts([w.decode("utf-8", "replace") for w in self.new])
            self.tokens = np.r_[self.tokens, np.array([m[0] for m in made], np.int64)]
            self.score = np.r_[self.score, np.array([m[1] for m in made])]
            self.new = []


def count_texts(texts: list[bytes], table: Counted) -> list[np.ndarray]:
    """Words, tokens and score of each text."""
    if len(table) > CACHE_WORDS:
        table.clear()
        table.tokens, table.score = table.tokens[:0], table.score[:0]
    split = [t.split() for t in texts]        # bytes: ASCII white space only
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ids = np.fromiter((i for ws in split for i in map(table.__getitem__, ws)), np.int64,
                      int(sizes.sum()))
    table.count()
    text = np.repeat(np.arange(len(texts)), sizes)
    return [sizes, np.bincount(text, table.tokens[ids], len(texts)).astype(np.int64),
            np.bincount(text, table.score[ids], len(texts))]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens and score (total log score) of every row."""
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Counted(WordTrie(piece_scores(path)))
        for batch in batches:
            for part in pieces(batch, "text", 4096):
                words, tokens, score = count_texts(utf8(part.column(1)), table)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words), pa.array(tokens), pa.array(score)],
                    ["doc_id", "n_words", "n_tokens", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, score double")
