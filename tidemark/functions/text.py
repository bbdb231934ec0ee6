"""Article text: normalisation, cleaning, length, token count, polarity."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C

# Characters kept by the cleaner: ASCII letters and digits, any Unicode
# punctuation, currency symbols and whitespace. (?U) makes Java's \s Unicode.
DISALLOWED = r"(?U)[^A-Za-z0-9\p{P}\p{Sc}\s]"
WHITESPACE_RUN = r"(?U)\s+"
TOKEN = r"\w+|[^\w\s]"
#: Bytes of text of which Python objects exist at once in a worker (or one row, if longer).
PIECE_BYTES = 1 << 20


def _normal(v) -> str:
    """NFKC of a string (most text is normal already and passes unchanged)."""
    return v if unicodedata.is_normalized("NFKC", v) else unicodedata.normalize("NFKC", v)


def _is_text(column: pa.Array) -> bool:
    return pa.types.is_string(column.type) or pa.types.is_large_string(column.type)


def text_pieces(*columns: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.Array, ...]]:
    """Zero-copy slices of columns of the same rows, in order, each of at most ``limit``
    bytes of text or one row."""
    rows = len(columns[0])
    ends = np.zeros(rows, np.int64)
    for c in filter(_is_text, columns):
        ends += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    ends = ends.cumsum()
    at = 0
    while at < rows:
        before = ends[at - 1] if at else 0
        end = max(int(np.searchsorted(ends, before + limit, side="right")), at + 1)
        yield tuple(c.slice(at, end - at) for c in columns)
        at = end


@F.arrow_udf(T.StringType())
def nfkc_concat(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """NFKC of title and of body (non-strings as ""), concatenated with no
    separator, piece by piece."""
    for batch in batches:
        for titles, bodies in text_pieces(*batch):
            yield pa.array([(_normal(t) if isinstance(t, str) else "")
                            + (_normal(b) if isinstance(b, str) else "")
                            for t, b in zip(titles.to_pylist(), bodies.to_pylist())], pa.string())


@F.arrow_udf(T.StringType())
def nfkc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Unicode NFKC normalisation (Spark has no built-in), piece by piece."""
    for batch in batches:
        for (texts,) in text_pieces(batch):
            yield pa.array([_normal(v) if isinstance(v, str) else None
                            for v in texts.to_pylist()], pa.string())


def normal_concat(title: Column, body: Column) -> Column:
    """``nfkc_concat``, for which only rows with other than ASCII characters cross into
    Python: ASCII is in NFKC already. The only Python step of the cleaner."""
    plain = F.concat(F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))
    other = F.length(plain) != F.octet_length(plain)
    return F.when(other, nfkc_concat(F.when(other, title), F.when(other, body))).otherwise(plain)


def strip_and_collapse(text: Column) -> Column:
    """Drop disallowed characters, collapse whitespace runs, trim."""
    kept = F.regexp_replace(text, DISALLOWED, "")
    return F.trim(F.regexp_replace(kept, WHITESPACE_RUN, " "))


def clean_text(title: Column, body: Column, normalize: bool = True) -> Column:
    """The cleaner: NFKC each field, keep allowed characters, join title and
    body without a separator, collapse whitespace, trim."""
    if normalize:
        joined = normal_concat(title, body)
    else:
        joined = F.concat(F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))
    return strip_and_collapse(joined)


def text_length(cleaned: Column) -> Column:
    """Code points of the cleaned text."""
    return F.length(cleaned).cast("int")


def token_count(cleaned: Column, max_length: int = C.TOKENIZER_MAX_LENGTH) -> Column:
    """Tokens the scorer sees, including the two special tokens, truncated
    at ``max_length`` (stand-in tokenizer: words and single punctuation)."""
    n = F.regexp_count(cleaned, F.lit(TOKEN)) + 2
    return F.least(n, F.lit(max_length)).cast("int")


def softmax_polarity(logits: Column, pos_idx: int = 0, neg_idx: int = 1) -> Column:
    """softmax(logits)[pos] - softmax(logits)[neg], stable (max-shifted)."""
    m = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return (F.element_at(e, pos_idx + 1) - F.element_at(e, neg_idx + 1)) / total


def softmax3(pos: Column, neg: Column, neu: Column) -> Column:
    """p_pos - p_neg of a 3-way softmax, as scalar (codegen'd) arithmetic."""
    m = F.greatest(pos, neg, neu)
    ep, en, eu = F.exp(pos - m), F.exp(neg - m), F.exp(neu - m)
    return (ep - en) / (ep + en + eu)
