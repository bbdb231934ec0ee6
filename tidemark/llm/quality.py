"""Quality rules: per-document counts and cross-document line frequency.

Native: every step is a DataFrame expression. The texts are read once; each
row becomes its counts plus one ``(key, words)`` pair per line, written to the
shared folder. All later steps read that narrow table.

A line is normalised (A-Z lower-cased, digits to 0, runs of white space to one
space) and hashed. For each host the number of distinct documents holding a
line is counted. Documents count as the same when the whole sets of their line keys
are the same, so exact copies count once and do not make each other's lines look
like boilerplate. Lines above the host's limit are taken out, and a document left
with too few of its words is rejected.

Defined results: null or empty text has no words and fails the base rules;
null ``host`` values form one host; null ids are carried; repeated rows each
get their own row; an empty table gives an empty result; other columns are
ignored. No text is cut, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, UPPER, materialise, split_words

SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
#: A line is boilerplate in a host above this many documents …
LINE_DOCS = 20
#: … and above this share of the host's documents.
LINE_SHARE = 0.001
#: A document is depleted when less than this share of its words is left.
LEFT_SHARE = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(positions: Column) -> Column:
    """Words covered by 3-word windows starting at sorted ``positions``."""
    last = F.size(positions) - 1
    gaps = F.transform(positions, lambda p, j: F.when(j == last, F.lit(3)).otherwise(
        F.least(F.lit(3), F.get(positions, j + 1) - p)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the five counts and ``lines`` (array of key, words) to ``docs``.

    The steps are separate projections, so no array is built twice.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    hash_of = lambda ws: F.xxhash64(F.translate(
        F.array_join(ws, " "), UPPER + DIGITS, UPPER.lower() + "0" * 10))
    no_longs = F.array().cast("array<bigint>")
    df = docs.withColumns({
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "_lines": F.filter(F.split(t, "\n"), has_word)})
    df = df.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_lw": F.transform("_lines", split_words)})
    df = df.withColumns({
        "_words": F.flatten("_lw"),
        "lines": F.transform("_lw", lambda ws: F.struct(
            hash_of(ws).alias("key"), F.size(ws).alias("words")))})
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("_h", F.when(F.col("n_words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1),
                             F.get("_words", i + 2)))).otherwise(no_longs))
    df = df.withColumn("_again", F.size("_h") > F.size(F.array_distinct("_h")))
    df = df.withColumn("_pairs", F.when(F.col("_again"), F.sort_array(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    pairs = F.col("_pairs")
    same = lambda e, j: e["h"] == F.get(pairs, j)["h"]
    df = df.withColumn("_at", F.sort_array(F.transform(F.filter(
        pairs, lambda e, j: F.coalesce((j > 0) & same(e, j - 1), F.lit(False))
        | F.coalesce(same(e, j + 1), F.lit(False))), lambda e: e["p"])))
    df = df.withColumn("n_repeat_words", F.when(F.col("_again"), _covered(F.col("_at")))
                       .otherwise(F.lit(0).cast("long")))
    return df.drop("_lines", "_lw", "_words", "_h", "_again", "_pairs", "_at")


def judged(docs: DataFrame, keep: dict[str, Column], text: str = "text",
           host: str = "source", line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE,
           left_share: float = LEFT_SHARE) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, the counts,
    ``removed_words``, ``base_failed`` and ``kept``."""
    named = docs.select(F.col(text).alias("_text"),
                        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
                        *[c.alias(n) for n, c in keep.items()])
    rows = materialise(base_counts(named, "_text").drop("_text").withColumn(
        "_row", F.monotonically_increasing_id()), "quality")

    keys = F.array_sort(F.array_distinct(F.transform("lines", lambda e: e["key"])))
    lines = rows.select("_row", "_host", F.xxhash64(keys).alias("_doc"), F.inline("lines"))
    found = lines.select("_host", "key", "_doc").distinct().groupBy("_host", "key").agg(
        F.count(F.lit(1)).alias("docs"))
    size = rows.groupBy("_host").agg((F.count(F.lit(1)) * F.lit(line_share)).alias("share"))
    # only lines above the fixed limit meet the host sizes, and then the documents
    often = (found.where(F.col("docs") > line_docs).join(size, "_host")
             .where(F.col("docs") > F.col("share")).select("_host", "key"))
    removed = (lines.select("_row", "_host", "key", "words").join(often, ["_host", "key"])
               .groupBy("_row").agg(F.sum("words").alias("removed_words")))
    failed = ((F.col("n_words") < 50)
              | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    left = F.col("n_words") - F.col("removed_words")
    return (rows.select(*keep, "_row", *COUNTS).join(removed, "_row", "left")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (left >= F.lit(left_share) * F.col("n_words")))
            .drop("_row"))


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """``doc_id``, the counts, ``removed_words``, ``base_failed`` and ``kept``."""
    return judged(docs, {"doc_id": F.col("doc_id")}, **limits)


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged.

    The verdict depends on text and host alone, so it is joined back by id and
    content hash; texts are not written again.
    """
    key = {"_id": F.col("doc_id"), "_hash": F.xxhash64("text", "source")}
    good = judged(docs, key, **limits).where("kept").select(*key).distinct()
    marked = docs.select(F.struct("*").alias("_row"), *[c.alias(n) for n, c in key.items()])
    return marked.join(good, marked["_id"].eqNullSafe(good["_id"])
                       & (marked["_hash"] == good["_hash"]), "left_semi").select("_row.*")
