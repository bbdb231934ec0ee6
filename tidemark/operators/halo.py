"""Sliding windows without storing a row once for each window it is in.

Rows are dealt into blocks of ``BLOCK`` consecutive dates for each key (a symbol, say).
A block also carries the ``window`` rows before it (its halo), so every window
lies in one block: a row is shuffled once, and the rows near a block's end once
more, 1 + window / BLOCK times in all. A key with a million dates is four
thousand blocks for as many tasks, and no block grows with the table.

Positions are those of the date index: the long tables are dense (every date of
the index has a row of every key), and a key that lacks a date fails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 256


def blocked(rows: DataFrame, index: DataFrame, window: int, columns: Sequence[str],
            keys: Sequence[str] = (), block: int = BLOCK, gaps: bool = False) -> DataFrame:
    """(keys…, block, t0, rows): per block its rows from position ``t0`` on, in order,
    as structs of ``t``, ``localDate`` and ``columns``.

    ``index`` has (localDate, t). A block's samples are the positions
    [block * size, (block + 1) * size). Unless ``gaps`` are allowed, a missing position fails."""
    block = max(block, window)
    placed = rows.join(index.select("localDate", "t"), "localDate")
    own = lambda t: F.floor(t / F.lit(block)).cast("long")
    dealt = placed.withColumn("block", F.explode(F.array_distinct(F.array(
        own(F.col("t")), own(F.col("t") + window)))))
    g = dealt.groupBy(*keys, "block").agg(F.sort_array(F.collect_list(
        F.struct("t", "localDate", *columns))).alias("rows"))
    t0 = F.col("rows")[0]["t"]
    if not gaps:
        whole = F.element_at("rows", -1)["t"] - t0 + 1 == F.size("rows")
        name = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("rows")
        t0 = F.when(whole, t0).otherwise(F.raise_error(F.concat(
            F.lit("a date is missing or repeated among the rows of "), name)))
    return g.select(*keys, "block", t0.alias("t0"), "rows")


def windows(blocks: DataFrame, window: int, record, block: int = BLOCK) -> DataFrame:
    """(keys…, t, row, window): for each position t of a block with ``window`` rows before
    it, its own row and ``record`` of each of these rows, oldest first."""
    block = max(block, window)
    at, rows = F.col("t"), F.col("rows")
    first = F.greatest(F.col("block") * block, F.col("t0") + window)
    last = F.least((F.col("block") + 1) * block, F.col("t0") + F.size("rows")) - 1
    some = blocks.where(first <= last).withColumn("t", F.explode(F.sequence(first, last)))
    start = (at - window - F.col("t0") + 1).cast("int")
    return some.select(
        *[c for c in blocks.columns if c not in ("block", "t0", "rows")], "t",
        F.get(rows, (at - F.col("t0")).cast("int")).alias("row"),
        F.transform(F.slice(rows, start, F.lit(window)), record).alias("window"))


def arrays(blocks: DataFrame, **columns) -> DataFrame:
    """Blocks with one flat array of doubles for each of ``columns`` (a name and the
    functions of a row that follow each other), for array code in tasks."""
    def flat(fields):
        return F.flatten(F.transform("rows", lambda r: F.array(
            *[c.cast("double") for c in fields(r)])))

    kept = [c for c in blocks.columns if c != "rows"]
    return blocks.select(*kept, *[flat(f).alias(n) for n, f in columns.items()])

