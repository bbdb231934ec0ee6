"""Exact positions and medians inside groups without funnelling a group into one task.

``Window.partitionBy(g).orderBy(k)`` sends every row of a group to one task;
a date that holds a third of all articles would then sort in one task. Here
the rows are range-partitioned on ``(group, order)`` so a hot group spans
many tasks; each task's per-group row count (at most tasks + groups rows)
gives the task its offset inside the group, and a row's position is that
offset plus its index inside the task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

_PID, _MID, _N, _M0, _OFF = "_rk_pid", "_rk_mid", "_rk_n", "_rk_m0", "_rk_off"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_number_within(df: DataFrame, order: Sequence, group: Sequence[str] = (),
                      out: str = "rn", partitions: int | None = None) -> DataFrame:
    """0-based row number of each row inside ``group`` under ``order``.

    ``order`` must be a total order inside each group (add a unique
    tie-breaker), otherwise positions among ties are arbitrary.

    The range-partitioned, sorted rows are checkpointed once so the count
    pass and the numbering pass see exactly the same layout, and so a lost
    executor cannot re-derive a different one. The offsets have at most one
    row for each task and one more for each group.
    """
    keys = [F.col(g) for g in group] + [_as_col(o) for o in order]
    spread = (df.repartitionByRange(partitions, *keys) if partitions
              else df.repartitionByRange(*keys))
    staged = (spread.sortWithinPartitions(*keys)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    staged = cut_lineage(staged)
    counts = staged.groupBy(_PID, *group).agg(F.count(F.lit(1)).alias(_N),
                                              F.min(_MID).alias(_M0))
    w = (Window.partitionBy(*group).orderBy(_PID)
         .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(_PID, *group, _M0,
                            F.coalesce(F.sum(_N).over(w), F.lit(0)).alias(_OFF))
    joined = staged.join(offsets, [_PID, *group])
    return (joined.withColumn(out, F.col(_OFF) + F.col(_MID) - F.col(_M0))
                  .drop(_PID, _MID, _M0, _OFF))


#: Buckets of a power of two. A float32 has 24 bits of mantissa, so one bucket holds at
#: most 2**24 / OCTAVE of them, and all of them lie in 2 * 278 * OCTAVE buckets.
OCTAVE = 256


def magnitude_bucket(v: Column) -> Column:
    """An integer that never falls as ``v`` (a double) grows: NaN is greatest, as in Spark's
    order, and an infinity beyond every number."""
    # from 2**-1074 on: the logarithm plus 1080 is positive
    size = F.floor((F.log2(F.abs(v)) + 1080) * OCTAVE).cast("long")
    far = F.lit(1 << 40)
    return (F.when(F.isnan(v), 2 * far).when(F.abs(v) == float("inf"), F.signum(v).cast("long") * far)
            .when(v == 0, F.lit(0).cast("long")).otherwise(F.signum(v).cast("long") * size))


def exact_median(df: DataFrame, value: str, group: Sequence[str] = (), out: str = "median",
                 weight: str | None = None) -> DataFrame:
    """Exact median per group (mean of the two middle values when the count is even), by
    counting: no row is sorted, and no task holds a group.

    The first pass counts each group's rows by a bucket of their magnitude; the second, of the
    rows in the bucket or two of the middle, by value. Both counts are made in the tasks
    first, so what is shuffled and ordered are buckets and distinct values: of float32
    values at most 2**16 in a bucket. ``weight`` names a column of how often a value counts.
    Null values are left out."""
    v, n = F.col("_v"), F.col("_n")
    rows = df.where(F.col(value).isNotNull()).select(
        *group, F.col(value).cast("double").alias("_v"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("_n"))
    rows = rows.withColumn("_b", magnitude_bucket(v))
    buckets = rows.groupBy(*group, "_b").agg(F.sum(n).alias("_n"))
    whole = Window.partitionBy(*group)
    upto = F.sum(n).over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(n).over(whole)
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    holds = lambda end: ((F.col(end) > low) & (F.col(end) - n <= high))
    middle = (buckets.withColumns({"_end": upto, "_total": total}).where(holds("_end"))
              .select(*group, "_b", (F.col("_end") - n).alias("_before"), "_total"))
    values = (rows.join(middle, [*group, "_b"]).groupBy(*group, "_b", "_before", "_total", "_v")
              .agg(F.sum(n).alias("_n")))
    ends = F.col("_before") + F.sum(n).over(
        Window.partitionBy(*group, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    found = values.withColumn("_end", ends).where(holds("_end"))
    # of one or two values at the middle positions
    return found.groupBy(*group).agg(((F.min("_v") + F.max("_v")) / 2).alias(out))
