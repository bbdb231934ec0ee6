"""Training-set assembly: date alignment, sliding windows, chronological
split and batches. Tables stay long (date, symbol, ...); per-date tables
are one row per trading day, so the global orderings used here are bounded
by the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators import halo

FEATURES = ("close", "high", "low", "open", "volume")


class AlignmentError(ValueError):
    pass


class SplitError(ValueError):
    pass


def common_dates(*tables: DataFrame) -> DataFrame:
    """Dates present in every table (left-semi joins on the date column)."""
    out = tables[0].select("localDate").distinct()
    for t in tables[1:]:
        out = out.join(t.select("localDate").distinct(), "localDate", "left_semi")
    return out


def intersect_dates(*tables: DataFrame) -> DataFrame:
    """The same set as :func:`common_dates`, as a set intersection."""
    out = tables[0].select("localDate")
    for t in tables[1:]:
        out = out.intersect(t.select("localDate"))
    return out


def alignment_report(*tables: DataFrame, check: bool = False) -> DataFrame:
    """One row: dates common to all tables and dates missing from some table,
    from one aggregate over a full outer join of per-date row counts.

    With ``check`` the row fails when no date is common, or when the aligned
    dates of a table do not all have the same number of rows (a repeated or an
    incomplete date)."""
    j = None
    for i, t in enumerate(tables):
        d = t.groupBy("localDate").agg(F.count(F.lit(1)).alias(f"_n{i}"))
        j = d if j is None else j.join(d, "localDate", "full_outer")
    rows = [F.col(f"_n{i}") for i in range(len(tables))]
    all_in = F.lit(True)
    for n in rows:
        all_in = all_in & n.isNotNull()
    own = [F.when(all_in, n) for n in rows]
    out = j.agg(F.count_if(all_in).alias("aligned_dates"),
                F.count_if(~all_in).alias("unaligned_dates"),
                *[f(n).alias(f"_{f.__name__}{i}") for i, n in enumerate(own) for f in (F.min, F.max)])
    aligned = F.col("aligned_dates")
    if check:
        aligned = F.when(aligned == 0, F.raise_error(F.lit("the tables share no date")))
        for i in range(len(tables)):
            aligned = aligned.when(F.col(f"_min{i}") != F.col(f"_max{i}"), F.raise_error(
                F.lit(f"table {i}: aligned dates differ in their number of rows")))
        aligned = aligned.otherwise(F.col("aligned_dates"))
    return out.select(aligned.alias("aligned_dates"), "unaligned_dates")


def check_alignment(*tables: DataFrame) -> int:
    """Number of common dates; fails as :func:`alignment_report` does."""
    try:
        return alignment_report(*tables, check=True).first()["aligned_dates"]
    except Exception as e:
        if "share no date" in str(e) or "aligned dates differ" in str(e):
            raise AlignmentError(str(e)) from e
        raise


def align(dates: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    """Restrict each table to the aligned dates."""
    return [t.join(dates, "localDate", "left_semi") for t in tables]


def date_index(dates: DataFrame) -> DataFrame:
    """0-based position of each aligned date; one row per day."""
    return dates.withColumn("t", (F.row_number().over(Window.orderBy("localDate")) - 1)
                            .cast("long"))


def split_point(rows: int, window: int = C.WINDOW_SIZE,
                share: float = C.VALIDATION_MAX_RATIO,
                windows: float = C.VALIDATION_TO_WINDOW_RATIO) -> tuple[int, int]:
    """(first validation row, validation rows) of ``rows`` aligned dates.

    The last ``share`` of the rows validates. It must span ``windows`` windows,
    and what is left for training at least one."""
    held_out = int(rows * share)
    kept = rows - held_out
    if held_out < windows * window:
        raise SplitError(f"{held_out} of {rows} rows would validate: {windows:g} windows of "
                         f"{window} rows are needed")
    if kept < window:
        raise SplitError(f"{kept} of {rows} rows would train: fewer than one window of {window}")
    return kept, held_out


def chrono_split(indexed_dates: DataFrame, window: int = C.WINDOW_SIZE) -> DataFrame:
    """Label aligned dates 'train' before the split point and 'validation' from
    ``window`` rows before it: validation starts ``window`` rows early
    so its first sample has a full window (the overlap is by design)."""
    n = indexed_dates.count()          # one row per day
    first, _ = split_point(n, window)
    train = indexed_dates.filter(F.col("t") < first).withColumn("split", F.lit("train"))
    val = (indexed_dates.filter(F.col("t") >= first - window)
           .withColumn("split", F.lit("validation")))
    return train.unionByName(val)


def sliding_windows(long_features: DataFrame, window: int = C.WINDOW_SIZE,
                    features=FEATURES, index: DataFrame | None = None,
                    block: int = halo.BLOCK) -> DataFrame:
    """For each symbol and row t >= window: the features of its rows
    [t - window, t) as an ordered array of structs.

    Cut from halo blocks of (symbol, date range): a row is shuffled about once, and a
    symbol of any length spans tasks. ``index`` (localDate, t) is that of the table's own dates
    unless given; every symbol has a row on each of them."""
    idx = index if index is not None else date_index(long_features.select("localDate").distinct())
    rest = [c for c in long_features.columns if c not in ("localDate", "id", *features)]
    parts = halo.blocked(long_features, idx, window, [*features, *rest], ["id"], block)
    cut = halo.windows(parts, window, lambda r: F.struct(
        r["localDate"].alias("date"), *[r[f].alias(f) for f in features]), block)
    return cut.select(F.col("row.localDate").alias("localDate"), "id",
                      *[F.col("row")[c].alias(c) for c in rest], "window")


def news_windows(lagged: DataFrame, index: DataFrame, window: int = C.WINDOW_SIZE,
                 block: int = halo.BLOCK) -> DataFrame:
    """Per indexed date t >= window: the lagged news rows [t - window, t) in order,
    as (localDate, news_window ARRAY<STRUCT<date, values>>).

    ``index`` has (localDate, t); the news has a row on each of its dates."""
    cols = [c for c in lagged.columns if c != "localDate"]
    rows = lagged.select("localDate", F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
                         .alias("values"))
    cut = halo.windows(halo.blocked(rows, index, window, ["values"], block=block), window,
                       lambda r: F.struct(r["localDate"].alias("date"), r["values"].alias("values")),
                       block)
    return cut.select(F.col("row.localDate").alias("localDate"),
                      F.col("window").alias("news_window"))


def assign_batches(samples: DataFrame, batch_size: int = C.BATCH_SIZE) -> DataFrame:
    """Batches of ``batch_size`` samples in date order; the incomplete last
    batch is dropped. One sample per date (bounded)."""
    rn = F.row_number().over(Window.orderBy("localDate")) - 1
    b = samples.withColumn("batch", F.floor(rn / batch_size).cast("long"))
    full = b.groupBy("batch").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == batch_size)
    return b.join(full.select("batch"), "batch", "left_semi")


def dedupe_keep_last(parts: DataFrame, key: str = "localDate") -> DataFrame:
    """One row per ``key``: the last occurrence in (part name, row index)
    order. ``parts`` carries ``_part`` and ``_row`` columns. A grouped
    ``max_by`` (partial per task) rather than a window over the key."""
    cols = [c for c in parts.columns if c not in ("_part", "_row", key)]
    order = F.struct("_part", "_row")
    best = parts.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_v"))
    return best.select(key, "_v.*")


def union_strict(*tables: DataFrame) -> DataFrame:
    """Concatenate tables whose schemas are identical (names, order, types)."""
    first = [(f.name, f.dataType) for f in tables[0].schema.fields]
    for t in tables[1:]:
        if [(f.name, f.dataType) for f in t.schema.fields] != first:
            raise ValueError(f"schema mismatch: {t.schema.simpleString()} vs "
                             f"{tables[0].schema.simpleString()}")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=False)
    return out


def unprocessed_dates(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw dates minus processed dates."""
    return raw.select("localDate").subtract(processed.select("localDate"))
