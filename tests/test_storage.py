"""Sinks and sources."""

import datetime as dt
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dataset import dedupe_keep_last
from tidemark.schemas import SchemaMismatch, assert_schema
from tidemark.session import scratch_path
from tidemark.sources import parquet as PQ
from tidemark.sources import state as ST
from tidemark.sources import tables as TB
from tidemark.sources.keyed import KeyedTable

TICK = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("lots", T.IntegerType()),
                     T.StructField("paid", T.FloatType()), T.StructField("settled", T.DateType()),
                     T.StructField("open", T.BooleanType())])


def test_parquet_round_trip(spark):
    rows = [("ÄB.C", -3, 0.25, dt.date(1969, 12, 31), True), ("", 2 ** 31 - 1, -1e30, None, False),
            (None, None, None, dt.date(2400, 2, 29), None)]
    path = scratch_path(spark, "ticks")
    df = spark.createDataFrame(rows, TICK)
    df.select("open", *TICK.fieldNames()[:-1]).write.parquet(path)      # stored in another order
    back = PQ.read_checked(spark, path, TICK)
    assert back.columns == TICK.fieldNames()
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_schema_check(spark):
    df = spark.createDataFrame([(1, "a")], "a long, b string")
    assert_schema(df, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]))
    with pytest.raises(SchemaMismatch):
        assert_schema(df, T.StructType([T.StructField("b", T.StringType()),
                                        T.StructField("a", T.LongType())]))


def test_state_round_trip(spark):
    path = scratch_path(spark, "control")
    marks = spark.createDataFrame([("bars", "lastAdded", dt.date(2020, 2, 29))],
                                  "pipeline string, key string, value date")
    ST.write_marks(marks, path)
    assert ST.read_mark(spark, path, "bars", "lastAdded").first().value == dt.date(2020, 2, 29)
    assert ST.read_mark(spark, path, "news", "lastAdded", "2001-03-04").first().value == \
        dt.date(2001, 3, 4)


def test_marks_of_one_pipeline_survive_each_other(spark):
    path = scratch_path(spark, "control")
    for key, day in (("lastAdded", 3), ("lastProcessed", 2), ("lastAdded", 5)):
        ST.write_marks(spark.createDataFrame([("bars", key, dt.date(2024, 1, day))],
                                             "pipeline string, key string, value date"), path)
    got = {(r.pipeline, r.key): r.value.day for r in ST.read_marks(spark, path).collect()}
    assert got == {("bars", "lastAdded"): 5, ("bars", "lastProcessed"): 2}


def test_a_write_tells_its_newest_date(spark):
    path = scratch_path(spark, "observed")
    df = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (3, 1, 7, 2)], "localDate date, v long")
    done = ST.write_observed(df.repartition(3), lambda x: PQ.write_partitions(x, path))
    assert done == {"newest": dt.date(2024, 1, 7), "rows": 4} and spark.read.parquet(path).count() == 4
    none = ST.write_observed(df.where("false"), lambda x: PQ.write_partitions(x, path))
    assert none == {"newest": None, "rows": 0} and spark.read.parquet(path).count() == 4


def test_partition_overwrite_and_empty_input(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 2, 3)], "localDate date, v long")
    PQ.write_partitions(df, path)
    PQ.write_partitions(df.filter("v = 2").withColumn("v", F.lit(20).cast("long")), path)
    PQ.write_partitions(df.filter(F.lit(False)), path)
    got = sorted((r.localDate.day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 20), (3, 3)]


def test_runs_keep_last_and_compaction(spark):
    path = scratch_path(spark, "runs")
    a = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 2, 3)], "localDate date, v long")
    PQ.append_run(a, path, "20240101T000000")
    PQ.append_run(a.filter("v >= 2").withColumn("v", F.col("v") * 10), path, "20240102T000000")
    want = [(1, 1), (2, 20), (3, 30)]
    got = dedupe_keep_last(PQ.read_runs(spark, path), "localDate")
    assert sorted((r.localDate.day, r.v) for r in got.collect()) == want
    assert PQ.compact_runs(spark, path, "localDate", "20240103T000000")
    assert PQ.list_runs(spark, path) == ["run=20240103T000000"]
    assert not PQ.compact_runs(spark, path, "localDate", "20240104T000000")
    got = dedupe_keep_last(PQ.read_runs(spark, path), "localDate")
    assert sorted((r.localDate.day, r.v) for r in got.collect()) == want


def test_table_demo_insert_twice_then_dedupe(spark):
    import uuid
    db = f"t_{uuid.uuid4().hex[:8]}"
    TB.ensure_database(spark, db, scratch_path(spark, "db"))
    name = f"{db}.news"
    items = spark.createDataFrame(
        [(dt.date(2025, 9, 21), "1", "Markets rally on Fed pause", "Bloomberg"),
         (dt.date(2025, 9, 21), "2", "Oil prices hit new high", "Reuters")],
        "localDate date, id string, headline string, body string")
    assert TB.append_or_create(items, name) == "create"
    assert TB.append_or_create(items, name) == "append"
    assert spark.table(name).count() == 4
    TB.dedupe_table(spark, name, ["id", "localDate"])
    assert sorted(r.id for r in spark.table(name).collect()) == ["1", "2"]
    assert TB.scan_if_exists(spark, f"{db}.absent") is None


def test_keyed_upsert_modes(spark):
    cur = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k long, v string, w string")
    upd = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    over = {r.k: r for r in TB.keyed_upsert(cur, upd, "k", True).collect()}
    keep = {r.k: r for r in TB.keyed_upsert(cur, upd, "k", False).collect()}
    assert (over[2].v, over[2].w, over[2].action) == ("B", "y", "update")
    assert (keep[2].v, keep[2].action) == ("b", "update")
    assert (over[3].v, over[3].action, over[1].action) == ("C", "insert", "keep")


def test_keyed_table_changes_in_place(spark):
    """A change rewrites the partitions of its keys alone, and the stored side of its join is
    not shuffled; lookups read only their partitions."""
    db, where = f"k_{uuid.uuid4().hex[:8]}", scratch_path(spark, "db")
    TB.ensure_database(spark, db, where)
    rows = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"),
                                   F.lit("x").alias("w"))
    table = KeyedTable.create(rows, f"{db}.t", "k", parts=16)

    def files():
        found = glob.glob(where.removeprefix("file:") + "/t/part=*/*.parquet")
        return {f: os.stat(f).st_mtime_ns for f in found}

    before = files()
    new = spark.createDataFrame([(5, 50), (7, None), (900, 1)], "k long, v long")
    touched = table.touched(new)
    plan = TB.keyed_upsert(table._stored(touched), new, "k")._jdf.queryExecution().executedPlan()
    stored = [line for line in plan.toString().split("\n") if "Bucketed: true" in line]
    assert len(stored) == 1 and "PartitionFilters: [part" in stored[0]
    assert plan.toString().count("Exchange") == 1                      # that of the changes
    assert {(r.k, r.action) for r in table.upsert(new).collect()} == {
        (5, "update"), (7, "update"), (900, "insert")}
    after = files()
    same = [f for f in before if after.get(f) == before[f]]
    assert all(f"part={p}/" not in f for f in same for p in touched)
    assert {f.split("part=")[1].split("/")[0] for f in before if f not in same} == set(map(str, touched))
    got = {r.k: (r.v, r.w) for r in table.rows().collect()}
    assert (got[5], got[7], got[900], got[8], len(got)) == ((50, "x"), (14, "x"), (1, None), (16, "x"), 501)
    table.upsert(spark.createDataFrame([(5, 1), (900, 2), (901, 3)], "k long, v long"), overwrite=False)
    assert {(r.k, r.v) for r in table.get(spark.createDataFrame(
        [(5,), (900,), (901,), (999,), (5,)], "k long")).collect()} == {(5, 50), (900, 1), (901, 3)}
    table.delete(spark.range(490).withColumnRenamed("id", "k"))
    assert sorted(r.k for r in table.rows().collect()) == [*range(490, 500), 900, 901]
    table.delete(table.rows().select("k"))
    assert table.rows().count() == 0 and table.get(new).count() == 0


def test_path_values(spark):
    df = spark.createDataFrame([("s3://b/inference/localDate=2024-01-02/data.parquet",),
                                ("s3://b/inference/localDate=junk/data.parquet",),
                                ("s3://b/model/score=0.1234/model.keras",)], "p string")
    r = df.select(PQ.path_value("localDate", F.col("p"), "date").alias("d"),
                  PQ.path_value("score", F.col("p"), "double").alias("s")).collect()
    assert [x.d for x in r] == [dt.date(2024, 1, 2), None, None]
    assert r[2].s == 0.1234


def test_missing_control_table_gives_the_default(spark):
    import datetime as dt

    from tidemark.session import scratch_path
    from tidemark.sources import state as ST
    path = scratch_path(spark, "no-control")
    assert ST.read_mark(spark, path, "p", "k").first().value is None
    day = dt.date(2024, 1, 2)
    assert ST.read_mark(spark, path, "p", "k", day).first().value == day
