"""Exact positions and medians over range-partitioned rows, including one
group holding most rows."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.rank import exact_median, magnitude_bucket, row_number_within


def _skewed(spark):
    rows = [("hot", i, float((i * 37) % 101)) for i in range(600)]
    rows += [(f"g{j}", i, float((i * 13 + j) % 17)) for j in range(5) for i in range(7)]
    return spark.createDataFrame(rows, "g string, i long, v double")


def test_distributed_row_number_matches_window(spark):
    df = _skewed(spark)
    dist = row_number_within(df, ["v", "i"], ["g"], out="rn", partitions=6)
    win = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "i")) - 1)
    a = sorted(tuple(r) for r in dist.select("g", "i", "rn").collect())
    b = sorted(tuple(r) for r in win.select("g", "i", "rn").collect())
    assert a == b
    hot = sorted(r.rn for r in dist.filter("g = 'hot'").collect())
    assert hot == list(range(600))            # a permutation of 0..n-1


def test_global_row_number(spark):
    df = spark.range(0, 257).select((F.col("id") * 7919 % 257).alias("k"))
    out = row_number_within(df, ["k"], partitions=5).collect()
    assert all(r.rn == r.k for r in out)


def test_exact_median(spark):
    df = _skewed(spark)
    want = df.toPandas().groupby("g").v.median().to_dict()
    got = {r.g: r.median for r in exact_median(df, "v", ["g"]).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert np.isclose(got[k], want[k])


def test_median_of_awkward_values(spark):
    """Signs, zeros, tiny and huge values, ties, even counts across two buckets, NaN,
    infinities and nulls; nothing but buckets and distinct values is ordered."""
    inf, nan = float("inf"), float("nan")
    groups = {"even": [1.0, 2.0, 1e30, -5.0], "two": [-1e-300, 1e300], "one": [-0.25],
              "tie": [0.5] * 7 + [0.25] * 7, "zero": [-1.0, 0.0, -0.0, 3.0], "null": [None, 2.0, None],
              "tiny": [5e-324, 1e-310, -5e-324], "inf": [-inf, 1.0, inf, inf], "nan": [1.0, 2.0, nan],
              "near": [1.0, 1.0 + 2 ** -23, 1.0 + 2 ** -22, 1.0 + 2 ** -21]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in exact_median(df.repartition(3), "v", ["g"]).collect()}
    for g, vs in groups.items():
        vs = sorted((v for v in vs if v is not None), key=lambda v: (v != v, v))
        want = (vs[(len(vs) - 1) // 2] + vs[len(vs) // 2]) / 2
        assert got[g] == want, g
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    assert {r.g: r.median for r in exact_median(counted, "v", ["g"], weight="n").collect()} == got
    assert exact_median(df.where("false"), "v", ["g"]).count() == 0


def test_median_sorts_no_rows(spark):
    """One group of 200,000 rows: what the windows order are buckets and values."""
    df = spark.range(200_000).select(F.lit("hot").alias("g"),
                                     ((F.col("id") * 7919 % 2001 - 1000) / 1000).alias("v"))
    got = exact_median(df, "v", ["g"])
    vs = np.sort((np.arange(200_000) * 7919 % 2001 - 1000) / 1000)
    assert got.first()["median"] == (vs[99_999] + vs[100_000]) / 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan


def test_buckets_never_fall(spark):
    rng = np.random.default_rng(2)
    x = np.sort(np.concatenate([rng.normal(size=500), 10.0 ** rng.uniform(-320, 300, 500),
                                -10.0 ** rng.uniform(-320, 300, 500), 2.0 ** np.arange(-1074, 1000, 7),
                                np.nextafter(2.0 ** np.arange(-60, 60), 0)]))
    df = spark.createDataFrame([(k, float(v)) for k, v in enumerate(x)], "k long, v double")
    got = [r.b for r in df.select("k", magnitude_bucket(F.col("v")).alias("b")).orderBy("k").collect()]
    assert got == sorted(got)
