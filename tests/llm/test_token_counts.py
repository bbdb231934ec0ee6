import re
from functools import lru_cache

import public_tokenizers
import pytest

from tidemark.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(None)
def brute(word):
    scores = T.piece_scores(PATH)
    word = T.START + word
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[i][0] + scores[word[i:end]], best[i][1] - 1)
                   for i in range(end) if word[i:end] in scores]
        if word[end - 1] not in scores:
            n = len(word[end - 1].encode())
            options.append((best[end - 1][0] + T.UNKNOWN * n, best[end - 1][1] - n))
        best.append(max(options))
    return -best[-1][1], best[-1][0]


def test_awkward_documents(docs, empty):
    got = {}
    for r in T.token_counts(docs, PATH).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_tokens"], r["score"]))
    want = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        made = [brute(w) for w in words]
        want.setdefault(r["doc_id"], []).append(
            (len(words), sum(m[0] for m in made), sum(m[1] for m in made)))
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(sorted(got[k]), sorted(want[k])):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2])
    assert T.token_counts(empty, PATH).count() == 0


def test_prefixes_are_scored_once():
    class Scores(dict):
        looked = 0

        def get(self, key):
            Scores.looked += 1
            return super().get(key)

    words = ["water" + "s" * k for k in range(30)]
    trie = T.WordTrie(Scores(T.piece_scores(PATH)))
    together = trie.counts(words)
    shared, Scores.looked = Scores.looked, 0
    assert together == [trie.counts([w])[0] for w in words]
    assert shared < Scores.looked / 8


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 3)
    table = T.Counted(T.WordTrie(T.piece_scores(PATH)))
    for text in (b"one two three four five", b"six one", b"two"):
        words, tokens, _ = T.count_texts([text], table)
        assert tokens[0] == sum(brute(w.decode())[0] for w in text.split()) and words[0]
