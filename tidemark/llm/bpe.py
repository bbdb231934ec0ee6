"""Byte-pair encoding by speculation: propose greedily, verify pairs, merge the rest.

The words of a text are looked up in a cache. Texts of ASCII and Latin letters are cut, looked up
and put together in arrays where the vocabulary is for lower-case text. New words are encoded together:

1. propose: the longest vocabulary entry is taken again and again, for all
   words at once, by walking a trie over every position;
2. verify: a token sequence is the BPE result exactly when each token is the
   result of its own bytes and every adjacent pair would come out as that pair.
   A pair is tested by undoing the merges of its two sides, latest first, and
   looking for a merge across the border that would have come earlier; all
   distinct pairs are tested together;
3. merge: only words with a failing pair go through the merges themselves.

Words come from the tokenizer's own pattern, in every script; a text is split at the
strings of special tokens first. Failing words of more than ``LONG`` symbols are merged
from a heap, one by one. What remains with the library are runs of non-blanks that hold a
character that this Python's Unicode tables do not know, so ids are always those of the library.

Defined results: null is the empty text (no ids); texts are encoded whole; a
cache that is full starts anew, so memory is bounded; repeated rows and null
ids are carried; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import pieces

CACHE_WORDS = 250_000        # words that a task remembers at once
LONG = 1024                  # symbols of a word that is merged from a heap
NONE = 1 << 30


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Merger:
    """Vocabulary, merges and vectorised encoding of symbol sequences.

    A symbol is a byte, or 256 + byte for the last byte of a word where the
    vocabulary marks word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.size = max(*vocab.values(), *self.special) + 1
        self.symbol_id = np.zeros(512, np.int64)
        for c, b in letters.items():
            self.symbol_id[b] = vocab[c]
            if self.suffix:
                self.symbol_id[256 + b] = vocab[c + self.suffix]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs])
        right = np.array([vocab[b] for _, b in pairs])
        made = np.array([vocab[a + b] for a, b in pairs])
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.key_rank, self.key_made = key[order], order, made[order]
        # by token: the merge that makes it, -1 for a symbol
        self.rank = np.full(self.size, -1, np.int64)
        self.left, self.right = np.zeros((2, self.size), np.int64)
        self.rank[made], self.left[made], self.right[made] = np.arange(len(made)), left, right
        self.bytes = [b""] * self.size
        self.tokens: dict[int, list[int]] = {}
        for token, i in vocab.items():
            end = bool(self.suffix) and token.endswith(self.suffix)
            body = token[:-len(self.suffix)] if end else token
            if body and all(c in letters for c in body):
                data = [letters[c] for c in body]
                self.bytes[i] = bytes(data)
                if end:
                    data[-1] += 256
                self.tokens[i] = data
        self.pairs = np.zeros(0, np.int64)      # tested pairs, sorted
        self.pairs_ok = np.zeros(0, bool)
        for i, content in self.special.items():
            self.bytes[i] = content.encode()
            self.tokens.pop(i, None)
        self._build_trie()

    def _build_trie(self) -> None:
        """Trie over the tokens that are the BPE result of their own symbols."""
        ids = sorted(self.tokens)
        flat, sizes = self.flatten([self.tokens[i] for i in ids])
        out, counts = self.merge(flat, sizes)
        first = np.r_[0, counts.cumsum()[:-1]]
        sound = [i for i, n, at in zip(ids, counts, first) if n == 1 and out[at] == i]
        # nodes are the distinct prefixes, found level by level; an edge is keyed by
        # (node, symbol), the edges sorted
        flat, sizes = self.flatten([self.tokens[i] for i in sound])
        ids, starts = np.array(sound), sizes.cumsum() - sizes
        node, level, total = np.zeros(len(ids), np.int64), 0, 1
        edges, targets, ends, values = [], [], [np.zeros(1, np.int64)], [np.full(1, -1)]
        while len(ids):
            key, place = np.unique(node * 512 + flat[starts + level], return_inverse=True)
            edges.append(key)
            targets.append(total + np.arange(len(key)))
            node, level = total + place, level + 1
            total += len(key)
            done = sizes == level
            ends.append(node[done])
            values.append(ids[done])
            ids, starts, sizes, node = (x[~done] for x in (ids, starts, sizes, node))
        edges, targets = np.concatenate(edges), np.concatenate(targets)
        order = np.argsort(edges)
        self.edges, self.targets = edges[order], targets[order]
        self.token = np.full(total, -1, np.int64)
        self.token[np.concatenate(ends[1:])] = np.concatenate(values[1:])
        self.first = np.full(512, -1, np.int64)       # the root's edges, by symbol
        root = self.edges < 512
        self.first[self.edges[root]] = self.targets[root]

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Trie nodes after one more symbol, -1 where there is none."""
        key = node * 512 + symbol
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.targets[at], -1)

    @staticmethod
    def flatten(words: list) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter((s for w in words for s in w), np.int64, int(sizes.sum()))
        return flat, sizes

    def propose(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match: token ids of all words, and counts by word."""
        ends = np.repeat(sizes.cumsum(), sizes)
        length = np.ones(len(flat), np.int64)
        token = self.symbol_id[flat]
        at, node, step = np.arange(len(flat)), self.first[flat], 1
        at, node = at[node >= 0], node[node >= 0]
        while len(at):
            hit = self.token[node] >= 0
            token[at[hit]], length[at[hit]] = self.token[node[hit]], step
            inside = at + step < ends[at]
            at, node = at[inside], node[inside]
            node = self.step(node, flat[at + step])
            at, node, step = at[node >= 0], node[node >= 0], step + 1
        starts = sizes.cumsum() - sizes
        word, at = np.arange(len(sizes))[sizes > 0], starts[sizes > 0]
        picked = []
        limit = sizes.cumsum()
        while len(at):
            picked.append((word, at))
            at = at + length[at]
            more = at < limit[word]
            word, at = word[more], at[more]
        if not picked:
            return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
        place = np.sort(np.concatenate([a for _, a in picked]))
        counts = np.bincount(np.concatenate([w for w, _ in picked]), minlength=len(sizes))
        return token[place], counts

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the merge of each pair; rank NONE without one."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.key_rank[at], NONE), self.key_made[at]

    def test_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the symbols of each pair of sound tokens merge to that pair."""
        ok = np.ones(len(a), bool)
        at, x, y = np.arange(len(a)), a.copy(), b.copy()
        # a merge across the border must come before what was undone last; at
        # the same rank the leftmost place goes first
        limit = np.full(len(a), 2 * NONE)
        while len(at):
            across = 2 * self.merge_rank(x, y)[0]
            bad = across < limit
            ok[at[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry = at[go], x[go], y[go], rx[go], ry[go]
            undo_left = rx > ry
            limit = np.where(undo_left, 2 * rx, 2 * ry + 1)
            x, y = (np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y]))
        return ok

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``test_pairs`` with a memory of the pairs met before."""
        key, back = np.unique(a * self.size + b, return_inverse=True)
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            known = self.pairs[at] == key
        else:
            at, known = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        ok = np.zeros(len(key), bool)
        ok[known] = self.pairs_ok[at[known]]
        new = key[~known]
        ok[~known] = self.test_pairs(new // self.size, new % self.size)
        if len(self.pairs) > 4_000_000:
            self.pairs, self.pairs_ok = new[:0], ok[:0]
        merged = np.concatenate([self.pairs, new])
        order = np.argsort(merged, kind="stable")
        self.pairs = merged[order]
        self.pairs_ok = np.concatenate([self.pairs_ok, ok[~known]])[order]
        return ok[back]

    def merge(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merges themselves, in all words at once, one merge a word and step."""
        ids = self.symbol_id[flat].copy()
        word = np.repeat(np.arange(len(sizes)), sizes)
        result, owner = [], []
        rank = np.full(len(ids), NONE)
        made = np.zeros(len(ids), np.int64)

        def rerank(places: np.ndarray) -> None:
            inside = places[(places >= 0) & (places + 1 < len(ids))]
            rank[places[places >= 0]] = NONE
            inside = inside[word[inside] == word[inside + 1]]
            rank[inside], made[inside] = self.merge_rank(ids[inside], ids[inside + 1])

        rerank(np.arange(len(ids)))
        while len(ids):
            starts = np.r_[0, np.flatnonzero(np.diff(word)) + 1]
            counts = np.diff(np.r_[starts, len(ids)])
            lowest = np.minimum.reduceat(rank, starts)
            done = np.repeat(lowest == NONE, counts)
            if done.any():
                result.append(ids[done])
                owner.append(word[done])
                live = ~done
                ids, word, rank, made = ids[live], word[live], rank[live], made[live]
                if not len(ids):
                    break
                starts = np.r_[0, np.flatnonzero(np.diff(word)) + 1]
                counts = np.diff(np.r_[starts, len(ids)])
                lowest = np.minimum.reduceat(rank, starts)
            hits = np.flatnonzero(rank == np.repeat(lowest, counts))
            place = hits[np.r_[True, word[hits][1:] != word[hits][:-1]]]   # leftmost
            ids[place] = made[place]
            stay = np.ones(len(ids), bool)
            stay[place + 1] = False
            moved = place - np.arange(len(place))       # one place goes in each word
            ids, word, rank, made = ids[stay], word[stay], rank[stay], made[stay]
            rerank(np.r_[moved - 1, moved])
        if not result:
            return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
        ids, word = np.concatenate(result), np.concatenate(owner)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(sizes))

    @cached_property
    def pair_merges(self) -> dict[int, tuple[int, int]]:
        """(rank, result) by pair key, for lookups one by one."""
        return dict(zip(self.keys.tolist(), zip(self.key_rank.tolist(), self.key_made.tolist())))

    def merge_long(self, flat: np.ndarray) -> np.ndarray:
        """The merges of one long word: pairs wait in a heap by (rank, place), neighbours
        are linked, so the work grows with n log n."""
        ids = self.symbol_id[flat].tolist()
        n, size, merges = len(ids), self.size, self.pair_merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for k in range(n - 1):
            found = merges.get(ids[k] * size + ids[k + 1])
            if found:
                heap.append((found[0], k))
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if ids[k] < 0 or right >= n:
                continue
            found = merges.get(ids[k] * size + ids[right])
            if not found or found[0] != rank:           # a neighbour has changed since
                continue
            ids[k], ids[right], after[k] = found[1], -1, after[right]
            if after[k] < n:
                before[after[k]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] < n:
                    found = merges.get(ids[a] * size + ids[after[a]])
                    if found:
                        heapq.heappush(heap, (found[0], a))
        return np.array([i for i in ids if i >= 0], np.int64)

    def encode_symbols(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and counts by word."""
        ids, counts = self.propose(flat, sizes)
        word = np.repeat(np.arange(len(sizes)), counts)
        inner = np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.zeros(0, np.int64)
        good = self.compatible(ids[inner], ids[inner + 1])
        failed = np.zeros(len(sizes), bool)
        failed[word[inner[~good]]] = True
        if not failed.any():
            return ids, counts
        long = failed & (sizes > LONG)
        short = failed & ~long
        merged, merged_counts = self.merge(flat[np.repeat(short, sizes)], sizes[short])
        starts = sizes.cumsum() - sizes
        alone = [self.merge_long(flat[starts[k]:starts[k] + sizes[k]]) for k in np.flatnonzero(long)]
        counts = counts.copy()
        counts[short], counts[long] = merged_counts, list(map(len, alone))
        owner = np.repeat(np.arange(len(sizes)), counts)
        out = np.empty(len(owner), np.int64)
        out[~failed[owner]] = ids[~failed[word]]
        out[short[owner]] = merged
        if alone:
            out[long[owner]] = np.concatenate(alone)
        return out, counts

    def symbols(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Symbols of words that lie one after the other."""
        flat = data.astype(np.int16)
        if self.suffix:
            flat[sizes.cumsum()[sizes > 0] - 1] += 256
        return flat

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit bytes."""
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        flat = self.symbols(np.frombuffer(b"".join(data), np.uint8), sizes)
        ids, counts = self.encode_symbols(flat, sizes)
        data, at = ids.astype("<u4").tobytes(), (4 * np.r_[0, counts.cumsum()]).tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]


#: Unicode White_Space, as the tokenizer's pattern has it.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNITS = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
#: Characters of which the class, lower case and normal form are the same in every
#: Unicode version: ASCII, letters of Latin-1 and Latin Extended-A, punctuation.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
PLAIN = re.compile(f"[\t-\r !-~{LETTER}\u2010-\u2027\u2030-\u205e]*")
MARKS = "'(?:[stmd]|re|ve|ll)"
WITH_BLANKS = re.compile(f" ?[{LETTER}]+|{MARKS}| ?[0-9]+| ?[^\t-\r {LETTER}0-9]+"
                         r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
NO_BLANKS = re.compile(f"[{LETTER}]+|{MARKS}|[0-9]|[^\t-\r {LETTER}0-9]+")
#: The same patterns for all scripts.
ANY_WITH_BLANKS = regex.compile(rf"{MARKS}| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+"
                                rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
ANY_NO_BLANKS = regex.compile(rf"{MARKS}|\p{{L}}+|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+")


@lru_cache(maxsize=1)
def known() -> re.Pattern:
    """Texts of characters that are assigned in this Python's Unicode tables: their classes,
    lower case and normal form no longer change."""
    gaps, start = [], None
    for c in range(0x110001):
        free = c < 0x110000 and unicodedata.category(chr(c)) in ("Cn", "Cs")
        if free and start is None:
            start = c
        elif not free and start is not None:
            gaps.append(f"{re.escape(chr(start))}-{re.escape(chr(c - 1))}")
            start = None
    return re.compile(f"[^{''.join(gaps)}]*")

#: Classes of bytes: blanks, letters, digits, other, and bytes inside a character. Of a ``PLAIN``
#: text, characters of two bytes are letters, those of three are neither letters nor blanks.
CLASSES = np.full(256, 3, np.int8)
CLASSES[[*range(9, 14), 32]] = 0
CLASSES[[*range(65, 91), *range(97, 123), *range(0xc3, 0xc6)]] = 1
CLASSES[48:58] = 2
CLASSES[0x80:0xc0] = 4
BULK_CHARS = 4 << 20         # characters of texts that are cut together (or one text)


def cut_plain(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """What ``NO_BLANKS`` finds in ``PLAIN`` lower-case texts, and runs of blanks between, as one
    array of words; and of each text its first word, with the end of the last."""
    data = [t.encode() for t in texts]
    buffer = b"\n".join([*data, b"\n\n\n"])
    flat = np.frombuffer(buffer, np.uint8)
    kind = CLASSES[flat]
    inside = np.flatnonzero(kind == 4)
    for _ in range(2):                  # a character has two such bytes at most
        kind[inside] = kind[inside - 1]
    start = np.ones(len(flat), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    # an apostrophe that no other sign precedes may begin a mark; what follows it starts anew
    quote = np.flatnonzero(start & (flat == 39))
    after, last = flat[quote + 1], flat[quote + 2]
    short = np.isin(after, list(b"stmd"))
    long = (np.isin(after, list(b"rv")) & (last == ord("e"))
            | (after == ord("l")) & (last == ord("l")))
    start[quote[short | long] + 1] = False
    start[quote[long] + 2] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    at = np.flatnonzero(start)
    words = pa.StringArray.from_buffers(
        len(at), pa.py_buffer(np.r_[at, len(flat)].astype(np.int32)), pa.py_buffer(buffer))
    begin = np.r_[0, np.cumsum([len(d) + 1 for d in data])]
    return words.dictionary_encode(), np.searchsorted(at, begin)


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``counts`` values from ``starts`` on, one after the other."""
    at = np.repeat(starts - counts.cumsum() + counts, counts)
    at += np.arange(len(at))
    return flat[at]


class Learned:
    """Words and their ids in arrays; a memory that is full goes on with the words of the
    texts at hand, so memory is bounded."""

    def __init__(self, merger: Merger) -> None:
        self.merger = merger
        self.words = pa.array([], pa.string())
        self.ids, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def find(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, starts, counts) of distinct words; runs of blanks have none."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:][:len(words) + 1].astype(np.int64)
        data, sizes = np.frombuffer(words.buffers()[2], np.uint8), np.diff(offsets)
        real = CLASSES[data[offsets[:-1]]] != 0
        place = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        known = place >= 0
        starts, counts = np.zeros((2, len(words)), np.int64)
        counts[known] = self.counts[place[known]]
        starts[known] = (self.counts.cumsum() - self.counts)[place[known]]
        fresh = real & ~known
        if not fresh.any():
            return self.ids, starts, counts
        flat = self.merger.symbols(gather(data, offsets[:-1][fresh], sizes[fresh]), sizes[fresh])
        ids, counts[fresh] = self.merger.encode_symbols(flat, sizes[fresh])
        starts[fresh] = len(self.ids) + counts[fresh].cumsum() - counts[fresh]
        ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        short = sizes <= LONG
        if len(self.words) + int((fresh & short).sum()) > CACHE_WORDS:
            kept, old = real & short, self.words[:0]
            self.ids, self.counts = self.ids[:0], self.counts[:0]
        else:
            kept, old = fresh & short, self.words
        self.words = pa.concat_arrays([old, words.filter(pa.array(kept))])
        self.ids = np.concatenate([self.ids, gather(ids, starts[kept], counts[kept])])
        self.counts = np.concatenate([self.counts, counts[kept]])
        return ids, starts, counts


class Codec(dict):
    """Ids (bytes) of each word of text: a cache that encodes what it misses.

    A word is what the tokenizer's pattern cuts between special tokens, whose strings are
    words of their own. Of a text with characters that are not ``known``, units that the
    pattern never joins with their neighbours (a run of non-blanks with the space before it,
    or blanks) are cut first; those that hold such a character are encoded by the library."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.path, self.merger = path, Merger(path)
        self.learned = Learned(self.merger)
        self.lower = bool(self.merger.suffix)    # lower case, blanks dropped
        self.marks = {m: np.array([i], "<u4").tobytes() for i, m in self.merger.special.items()}
        self.at_marks = re.compile(f"({'|'.join(map(re.escape, self.marks))})")

    @cached_property
    def library(self):
        """The tokenizers library; loaded with the first text that needs it."""
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(self.path)
        own.no_truncation()
        own.no_padding()
        return own

    def by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids,
                        "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Encode words that are not cached yet, all together."""
        own = []
        for w in words:
            if w in self.marks:
                self[w] = self.marks[w]
            elif PLAIN.fullmatch(w) or known().fullmatch(w):
                own.append(w)
            else:
                self[w] = self.by_library(w)
        self.update(zip(own, self.merger.encode(own)))

    def words(self, text: str) -> list[str]:
        if not any(m in text for m in self.marks):
            return self.cut(text)
        out = []
        for k, part in enumerate(self.at_marks.split(text)):
            out += [part] if k % 2 else self.cut(part)
        return out

    def cut(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if PLAIN.fullmatch(text):
            return (NO_BLANKS.findall(text.lower()) if self.lower else WITH_BLANKS.findall(text))
        if known().fullmatch(text):
            if not self.lower:
                return ANY_WITH_BLANKS.findall(text)
            # letter by letter, as the tokenizer does: no final form of sigma
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
            return ANY_NO_BLANKS.findall(text)
        out = []
        for unit in UNITS.findall(text):
            out += self.cut(unit) if known().fullmatch(unit) else [unit]
        return out

    def encode_texts(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, in order."""
        if not self.lower:
            yield from self.encode_cut(texts)
            return
        plain = [PLAIN.fullmatch(t) is not None and not any(m in t for m in self.marks)
                 for t in texts]
        rest = self.encode_cut([t for t, p in zip(texts, plain) if not p])
        bulk = self.encode_plain([t for t, p in zip(texts, plain) if p])
        for p in plain:
            yield next(bulk if p else rest)

    def encode_plain(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of ``PLAIN`` texts without special tokens, cut, looked up and put together in
        arrays: no word is a Python string."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= BULK_CHARS):
                chars += len(texts[end])
                end += 1
            found, first = cut_plain([t.lower() for t in texts[at:end]])
            flat, starts, counts = self.learned.find(found.dictionary)
            word = found.indices.to_numpy()
            data = gather(flat, starts[word], counts[word]).astype("<u4").tobytes()
            ends = (4 * np.r_[0, counts[word].cumsum()][first]).tolist()
            yield from (data[a:b] for a, b in zip(ends, ends[1:]))
            at = end

    def encode_cut(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, in order, from lists of its words."""
        split = [self.words(t) for t in texts]
        every = set()
        for s in split:
            every.update(s)
        new = every.difference(self)
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = every
        self.learn(list(new))
        del every, new
        get = self.__getitem__
        for s in split:
            yield b"".join(map(get, s))

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 text of ids; bytes that are no UTF-8 become U+FFFD."""
        data = b"".join(map(self.merger.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(path)


def encoded(docs: DataFrame, path: str, schema: str,
            row: Callable[[bytes, Codec], list[tuple]], text: str = "text") -> DataFrame:
    """``docs`` without ``text``; each row becomes the rows ``row`` makes of its ids.

    ``schema`` lists the columns that ``row`` returns. The vocabulary file is
    read by every Python worker from ``path``."""
    kept = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in kept]
    whole = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + schema
    added = [c.strip().split()[0] for c in schema.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    types = [kinds[c.strip().split()[1]] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in pieces(batch, text, 1024):
                texts = [t or "" for t in part.column(len(names)).to_pylist()]
                at, made = [], []
                for k, ids in enumerate(own.encode_texts(texts)):
                    rows = row(ids, own)
                    at += [k] * len(rows)
                    made += rows
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).take(take) for i in range(len(names))]
                    + [pa.array([m[i] for m in made], t) for i, t in enumerate(types)],
                    names + added)

    return docs.select(*names, text).mapInArrow(run, whole)


def _digests(ids: bytes, own: Codec) -> list[tuple]:
    return [(len(ids) // 4, hashlib.sha256(ids).hexdigest(),
             hashlib.sha256(own.decode(ids)).hexdigest())]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    return encoded(docs.select("doc_id", "text"), path,
                   "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)
