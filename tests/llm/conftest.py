"""Small tables with the awkward rows that every operator must handle."""

import random

import pytest
from pyspark.sql import functions as F

WORDS = ("the of and to in is that for it was on are as with his they at be this from river "
         "stone window paper garden market winter summer letter bridge machine number").split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed"]) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 12]) + "." for i in range(0, n, 12))


def awkward_texts() -> list[str | None]:
    near = prose(1, 150)
    return [None, "", " \t\n\x0b ", "x", "one two", near, near, near.replace("river", "lake", 1),
            near + " end", prose(2, 200), prose(3, 90) + "\n" + prose(3, 90),
            "ÀÉ ñandú straße ½ x² a b   日本語 🙂🙂 é İstanbul Σς",
            "don't 'sun I'LL <|endoftext|> y  <|startoftext|>", "a" * 3000, prose(4, 9000),
            "*** !!! $$$ 12 345", "same line here\n" * 40]


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: null and repeated ids and rows, and columns whose names
    the operators use themselves."""
    texts = awkward_texts()
    rows = [(k, t, "en" if k % 2 else None, "src" if k % 3 else None)
            for k, t in enumerate(texts)]
    rows += [(None, prose(5, 80), "en", "src"), (3, "x", None, "src"), (3, "x", None, "src"),
             (3, prose(6, 70), "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ("_text", "_row", "_hash", "_id", "_key", "fp", "root", "score", "spans", "key",
             "words", "lines", "kept", "length", "start", "rank", "entry", "n_words", "held_out",
             "lang_pred", "sequence_id", "_host", "counts", "record", "n")
    return df.withColumns({c: F.lit(1) for c in clash}).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
