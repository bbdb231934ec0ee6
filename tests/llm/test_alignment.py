import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment as AL
from tidemark.llm.bpe import byte_letters

from .conftest import prose

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.letters = byte_letters()

    def tokens(self, text):
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                      else piece.replace("▁", " ").encode()))
        return a, b

    def groups(self, text):
        if not text:
            return None
        a, b = self.tokens(text)
        data = (" " + text).encode()
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            return None
        ends = [[sum(len(x) for _, x in side[:k + 1]) for k in range(len(side))] for side in (a, b)]
        out, low = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            out.append(tuple([i for (i, _), e in zip(side, own) if low < e <= cut]
                             for side, own in zip((a, b), ends)))
            low = cut
        return out

    def rows(self, docs):
        met = [(i, self.groups(t)) for i, t in docs]
        count = Counter()
        for _, g in met:
            count.update({(x, y) for a, b in g or () for x in a for y in b})
        top = defaultdict(int)
        for (x, _), n in count.items():
            top[x] = max(top[x], n)
        for i, g in met:
            if g is None:
                yield (i, 0, 0, 0, 0, 0, 0, "")
                continue
            links = [(x, y) for a, b in g for x in a for y in b]
            shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            yield (i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                   sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
                   hashlib.sha256(shown.encode()).hexdigest())


@pytest.fixture(scope="module")
def brute():
    return Brute()


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def small(docs):
    """Without the longest text, which brute force would take minutes for."""
    return docs.where("text is null or length(text) < 9000")


def test_rows_against_brute_force(docs, empty, brute):
    rows = [(r["doc_id"], r["text"]) for r in small(docs).collect()]
    assert got(AL.align(small(docs), BYTE, PIECE)) == sorted(brute.rows(rows), key=str)
    assert AL.align(empty, BYTE, PIECE).columns == COLUMNS
    assert got(AL.align(empty, BYTE, PIECE)) == []


def test_blocks_and_parts_do_not_show(docs):
    """Small blocks, and texts cut into parts by A ids, give the same rows."""
    whole = got(AL.align(docs, BYTE, PIECE))
    assert got(AL.align(docs.repartition(3), BYTE, PIECE, block_bytes=2000, block_links=50)) == whole


def test_copies_are_aligned_once_and_counted(spark, brute, monkeypatch):
    rows = [(k, prose(1, 40)) for k in range(30)] + [(99, prose(1, 40) + " river")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(AL.align(df, BYTE, PIECE)) == sorted(brute.rows(rows), key=str)


def test_texts_a_tokenizer_does_not_give_back(spark, brute):
    """U+2581 becomes a space in one tokenizer, so such a text has no tokens."""
    rows = [(1, "a▁b"), (2, "▁"), (3, "a b"), (4, " a  b "), (5, "\x00 <unk> <s> <|endoftext|>"),
            (6, "日本 語🙂 é"), (7, "a b"), (8, "=" * 700), (9, " \t\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    result = got(AL.align(df, BYTE, PIECE))
    assert result == sorted(brute.rows(rows), key=str)
    assert {r[0]: r[1] for r in result}[1] == 0 and {r[0]: r[7] for r in result}[2] == ""


def test_a_stretch_without_common_ends():
    """Links of one group are counted, not listed: memory follows distinct ids."""
    done = AL.Aligned.__new__(AL.Aligned)
    n = 30_000
    done.a, done.b = np.arange(n) % 3, np.arange(n) % 2
    done.a_group, done.b_group = np.zeros(n, np.int64), np.zeros(n, np.int64)
    done.in_a, done.in_b = np.array([n]), np.array([n])
    done.text_of_group = np.zeros(1, np.int64)
    found = list(done.parts(4))
    assert len(found) > 1
    pairs = {int(p): int(c) for _, pair, links in found for p, c in zip(pair, links)}
    assert pairs == {a * AL.IDS + b: n // 3 * (n // 2) for a in range(3) for b in range(2)}
