"""Long <-> wide reshapes: symbol-major pivots at the sink, unpivot, packed
prediction arrays and window tensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators import halo


def symbol_list(symbols: DataFrame) -> list[str]:
    """Symbols in list order, for generated column names."""
    return [r["id"] for r in symbols.orderBy("pos").select("id").collect()]


def pivot_blocks(long: DataFrame, symbols: DataFrame, metrics,
                 size: int = C.SYMBOL_BLOCK) -> list[DataFrame]:
    """The wide table in column blocks of ``size`` symbols, each one row a date.

    A block reads only its own symbols, and no schema or row grows beyond it;
    a universe of up to ``size`` symbols is one block."""
    names = symbol_list(symbols)
    out = []
    for at in range(0, len(names), size):
        own = symbols.filter((F.col("pos") >= at) & (F.col("pos") < at + size)).select("id")
        out.append(pivot_wide(long.join(own, "id", "left_semi"), names[at:at + size], metrics))
    return out


def wide_table(long: DataFrame, symbols: DataFrame, metrics) -> DataFrame:
    """All column blocks side by side, one row a date."""
    blocks = pivot_blocks(long, symbols, metrics)
    out = blocks[0] if blocks else long.select("localDate").distinct()
    for b in blocks[1:]:
        out = out.join(b, "localDate", "full_outer")
    return out


def wide_columns(symbols: list[str], metrics) -> list[str]:
    """``{symbol}_{metric}``, symbol-major in list order, metrics in order."""
    return [f"{s}_{m}" for s in symbols for m in metrics]


def pivot_wide(long: DataFrame, symbols: list[str], metrics) -> DataFrame:
    """One row per date with ``{symbol}_{metric}`` columns in schema order.

    A grouped pivot with an explicit value list (no extra distinct job);
    per-date partial aggregation keeps a hot date safe."""
    p = (long.groupBy("localDate").pivot("id", symbols)
             .agg(*[F.first(m, ignorenulls=True).alias(m) for m in metrics]))
    if len(metrics) == 1:    # Spark names single-aggregate pivots by value only
        p = p.withColumnsRenamed({s: f"{s}_{metrics[0]}" for s in symbols})
    return p.select("localDate", *[F.col(f"`{c}`") for c in wide_columns(symbols, metrics)])


def unpivot_wide(wide: DataFrame) -> DataFrame:
    """Wide ``{symbol}_{metric}`` row -> (localDate, symbol, metric, value);
    the name splits on its first '_' (symbols carry none)."""
    cols = [c for c in wide.columns if c != "localDate"]
    u = wide.select("localDate", *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]) \
            .unpivot("localDate", cols, "name", "value")
    parts = F.split(F.col("name"), "_", 2)
    return u.select("localDate", parts.getItem(0).alias("symbol"),
                    parts.getItem(1).alias("metric"), "value")


def symbol_block(pos="pos") -> Column:
    return F.floor(F.col(pos) / C.SYMBOL_BLOCK).cast("int")


def pack_predictions(long: DataFrame, heads=C.INFERENCE_METRICS) -> DataFrame:
    """Per date and symbol block: parallel arrays of symbols and of each head,
    in list order. A block bounds the arrays, whatever the universe."""
    rec = F.struct("pos", F.col("symbol"), *[F.col(h) for h in heads])
    g = long.groupBy("localDate", symbol_block().alias("block")).agg(
        F.sort_array(F.collect_list(rec)).alias("_r"))
    return g.select("localDate", "block", F.col("_r.symbol").alias("symbol"),
                    *[F.col(f"_r.{h}").alias(h) for h in heads])


def unpack_predictions(packed: DataFrame, heads=C.INFERENCE_METRICS) -> DataFrame:
    """Parallel arrays -> one row per symbol (``arrays_zip`` + ``explode``)."""
    z = packed.select("localDate", F.explode(F.arrays_zip("symbol", *heads)).alias("z"))
    return z.select("localDate", F.col("z.symbol").alias("symbol"),
                    *[F.col(f"z.{h}").alias(h) for h in heads])


def window_tensor(long_features: DataFrame, index: DataFrame, window: int = C.WINDOW_SIZE,
                  features=("close", "high", "low", "open", "volume"),
                  block: int = halo.BLOCK) -> DataFrame:
    """Per date and symbol block: a (window, symbols, features) nested array, symbols in
    list order.

    The cross-section of a date (its symbols' features in list order) is made once; the
    tensor of a date is a window over cross-sections, cut from halo blocks."""
    rec = F.struct("pos", F.array(*[F.col(f).cast("double") for f in features]).alias("v"))
    cross = long_features.groupBy("localDate", symbol_block().alias("symbols")).agg(
        F.transform(F.sort_array(F.collect_list(rec)), lambda s: s["v"]).alias("cross"))
    parts = halo.blocked(cross, index, window, ["cross"], ["symbols"], block)
    cut = halo.windows(parts, window, lambda r: r["cross"], block)
    return cut.select(F.col("row.localDate").alias("localDate"), F.col("symbols").alias("block"),
                      F.col("window").alias("tensor"))


def mean_over_symbols(long: DataFrame, features=("close", "high", "low", "open", "volume")) -> DataFrame:
    """Per date, each feature averaged over all symbols."""
    return long.groupBy("localDate").agg(*[F.avg(F.col(f).cast("double")).alias(f"mean_{f}")
                                           for f in features])


def previous_day_predictions(targets: DataFrame) -> DataFrame:
    """Fixture predictions: each symbol's previous trading row's targets
    predicted for the day (first day: no prediction)."""
    w = Window.partitionBy("id").orderBy("localDate")
    heads = [F.lag(F.col(h).cast("double"), 1).over(w).alias(h) for h in C.INFERENCE_METRICS]
    return (targets.select("localDate", F.col("id").alias("symbol"), "pos", *heads)
                   .filter(F.col("zscore_1d").isNotNull()))
