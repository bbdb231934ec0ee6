"""Byte-level encoders for bulk work, with the ids of the tokenizers library.

The vocabulary file is the tokenizers library's. Its byte-level merges are in
the order of the ids they make, so the same table can be given as ranks to
``tiktoken``, which encodes the words of the same pattern several times as fast.
What that library refuses (a run of white space too long for its pattern engine)
goes to the tokenizers library itself. ``tests/llm/test_token_files.py`` holds the
two against each other on every code point.
"""

from __future__ import annotations

import json
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import tiktoken

from tidemark.llm.bpe import byte_letters

#: The pattern of byte-level vocabularies without one of their own in the file.
PATTERN = public_tokenizers.PATTERN


class ByteEncoder:
    """``encode`` gives a text's ids. With ``plain`` the strings of special tokens
    are text like any other; else they get their own ids."""

    def __init__(self, path: str, plain: bool) -> None:
        self.path, self.plain = path, plain
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.table = {bytes(map(letters.__getitem__, token)): i
                      for token, i in spec["model"]["vocab"].items() if token not in special}
        made = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)]
                for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        self.fast = tiktoken.Encoding("bulk", pat_str=PATTERN, mergeable_ranks=self.table,
                                      special_tokens=special)

    @cached_property
    def library(self):
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(self.path)
        own.no_truncation()
        own.no_padding()
        own.encode_special_tokens = self.plain
        return own

    @cached_property
    def lengths(self) -> np.ndarray:
        """Bytes of each id."""
        out = np.zeros(self.fast.n_vocab, np.int64)
        for data, i in self.table.items():
            out[i] = len(data)
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids, as unsigned 32-bit integers."""
        try:
            ids = self.fast.encode(text, allowed_special=set() if self.plain else "all",
                                   disallowed_special=())
        except ValueError:          # more white space than its pattern engine can hold
            ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32)


@lru_cache(maxsize=2)
def byte_encoder(path: str, plain: bool) -> ByteEncoder:
    """One encoder for each Python worker."""
    return ByteEncoder(path, plain)
