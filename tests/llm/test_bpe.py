import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe

from .conftest import awkward_texts, prose

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param)
    return bpe.codec(path), Tokenizer.from_file(path)


def ids_of(codec, texts):
    return [np.frombuffer(b, "<u4").tolist() for b in codec.encode_texts(texts)]


def test_awkward_texts(pair):
    codec, library = pair
    texts = [t or "" for t in awkward_texts()]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(codec, texts) == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdehiostTHE ÉßñŁ12'.,!\n\t\xa0 　é日…’🙂st", max_size=60))
def test_any_text(pair, text):
    codec, library = pair
    assert ids_of(codec, [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_pairs_agree_with_merging(pair):
    """The speculation's verdict on adjacent pairs is that of the merges."""
    merger = pair[0].merger
    rng = np.random.default_rng(1)
    tokens = sorted(merger.tokens)
    inner = [t for t in tokens if max(merger.tokens[t]) < 256]      # not at a word's end
    a, b = rng.choice(inner, 300), rng.choice(tokens, 300)
    keep = []
    for x, y in zip(a.tolist(), b.tolist()):
        one = [merger.merge(*merger.flatten([merger.tokens[t]]))[0].tolist() for t in (x, y)]
        keep.append(one == [[x], [y]])
    a, b = a[keep], b[keep]
    flat, sizes = merger.flatten([merger.tokens[x] + merger.tokens[y]
                                  for x, y in zip(a.tolist(), b.tolist())])
    ids, counts = merger.merge(flat, sizes)
    parts = np.split(ids, counts.cumsum()[:-1])
    want = [p.tolist() == [x, y] for p, x, y in zip(parts, a.tolist(), b.tolist())]
    assert merger.test_pairs(a, b).tolist() == want and 0 < sum(want) < len(want)


def test_only_failing_words_are_merged(monkeypatch):
    codec = bpe.Codec(public_tokenizers.path(FILES[0]))
    seen = []
    merge = codec.merger.merge
    monkeypatch.setattr(codec.merger, "merge", lambda f, s: seen.append(len(s)) or merge(f, s))
    words = sorted({w for w in prose(1, 3000).split()})
    codec.merger.encode(words)
    assert sum(seen) < len(words) / 2


def test_cache_starts_anew(monkeypatch, pair):
    codec, library = pair
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    texts = [prose(k, 40) for k in range(4)]
    for t in texts:
        assert ids_of(codec, [t]) == [library.encode(t, add_special_tokens=False).ids]


def test_query_rows(docs, empty):
    path = public_tokenizers.path(FILES[0])
    library = Tokenizer.from_file(path)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    want = []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert text == t
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.encode_decode(docs, path).collect()]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert bpe.encode_decode(empty, path).count() == 0


SCRIPTS = ["Привет, мир! Ёлка’s 12½", "ΟΔΥΣΣΕΥΣ Σ ΑΣ ς", "नमस्ते दुनिया १२", "日本語の文章。東京　タワー", "한국어 각",
           "مرحبا بالعالم ٣٤", "🙂👩‍👩‍👧 ok", "éẹ́ İI ǅ ﬁ", "a b\u0085c​d", "ภาษาไทย",
           "x<|endoftext|>y  <|endoftext|> <|startoftext|>Жук"]


def test_other_scripts_and_special_tokens_stay_here(pair, monkeypatch):
    codec, library = pair
    want = [library.encode(t, add_special_tokens=False).ids for t in SCRIPTS]
    codec.clear()
    monkeypatch.setattr(bpe.Codec, "by_library", None)
    assert ids_of(codec, SCRIPTS) == want


def test_every_seventh_character(pair):
    codec, library = pair
    texts = [f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in range(0, 0x30000, 7)
             if not 0xd800 <= c < 0xe000]
    assert ids_of(codec, texts) == [e.ids for e in
                                    library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="Σσς ЖжĲ’日本 한각ẹ́İǅ½²٣ ‍🙂͸|<>endoftx", max_size=40))
def test_any_text_of_other_scripts(pair, text):
    codec, library = pair
    assert ids_of(codec, [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_long_words_are_merged_from_a_heap(pair):
    codec, library = pair
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcdehiost"), 200_000)), "日本語の文章東京" * 4_000, "a" * 50_001]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(codec, texts) == want
    flat = np.frombuffer(texts[0][:3_000].encode(), np.uint8).astype(np.int16)
    assert codec.merger.merge_long(flat).tolist() == \
        codec.merger.merge(flat, np.array([len(flat)]))[0].tolist()


def test_words_of_plain_texts_cut_in_arrays():
    """Array cuts give the words of the pattern and the library's ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library, r = bpe.Codec(path), Tokenizer.from_file(path), random.Random(3)
    bits = ["'", "'s", "'t", "'re", "'ve", "'ll", "r", "e", "l", "v", "s", "a", "Z", "É", "Ÿ", "ß", "0",
            "12", " ", "\n", "\t", "  ", ".", '"', "—", "…", "’", "<|", "_", "don't", "x'rest"]
    texts = ["", "'", " ", "\n\n", "'l", "'ve", "''s", "'s's", "é"]
    texts += ["".join(r.choices(bits, k=r.randint(0, 40))) for _ in range(3000)]
    words, first = bpe.cut_plain([t.lower() for t in texts])
    for t, a, b in zip(texts, first, first[1:]):
        found = [w for w in words[a:b].to_pylist() if not w.isspace()]
        assert found == bpe.NO_BLANKS.findall(t.lower()), t
    assert bpe.cut_plain(["the cat " * 50_000])[0].dictionary.to_pylist() == ["the", " ", "cat", " \n\n\n\n"]
    texts[5:5] = ["日本 語 x's", "a'll <|endoftext|> b", "İ Σ ς ×"]
    ids = [np.frombuffer(x, "<u4").tolist() for x in own.encode_texts(texts)]
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(own.encode_texts([])) == []


def test_words_in_arrays_are_learned_once_and_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    own = bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))
    learned = []
    encode = own.merger.encode_symbols
    own.merger.encode_symbols = lambda flat, sizes: learned.append((flat % 256).astype(np.uint8).tobytes()) or encode(flat, sizes)
    texts = [" ".join(["zebra", "same", "  ", *(f"w{chr(97 + k % 26)}{chr(97 + j)}" for j in range(20))]) for k in range(12)]
    got = [ids for t in texts for ids in own.encode_texts([t])]
    assert len(own) == 0                              # no word went through Python strings
    assert b"".join(learned).count(b"zebra") == 1 and len(own.learned.words) <= 50
    long = "ab" * 2000 + " " + "x" * 5000             # long words are not kept
    got += own.encode_texts([long + " zebra"])
    assert len(own.learned.words) <= 50 and max(map(len, own.learned.words.to_pylist())) < 1024
    assert got == list(own.encode_cut([*texts, long + " zebra"]))
