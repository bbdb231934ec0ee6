"""Registered storage queries: each writes into a fresh folder under the
shared checkpoint directory and returns the table read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as SC
from tidemark.operators import dataset as DS
from tidemark.operators import incremental as INC
from tidemark.operators import reshape as RS
from tidemark.plans import oracle as O
from tidemark.plans.q_stock import target_table
from tidemark.plans.registry import register, rounded
from tidemark.session import scratch_path
from tidemark.sources import fixtures as FX
from tidemark.sources import parquet as PQ
from tidemark.sources import state as ST
from tidemark.sources import tables as TB
from tidemark.sources.keyed import KeyedTable

ORDERS_CHECKED = T.StructType([T.StructField("o_orderkey", T.LongType()),
                               T.StructField("o_totalprice", T.DoubleType()),
                               T.StructField("o_orderpriority", T.StringType())])


@register("parquet_read_checked", "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, "
          "o_orderpriority FROM orders")
def q_parquet_read_checked(spark, sf_dir):
    return rounded(PQ.read_checked(spark, f"{sf_dir}/orders.parquet", ORDERS_CHECKED))


@register("parquet_read_columns", "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) "
          "AS l_extendedprice FROM lineitem")
def q_parquet_read_columns(spark, sf_dir):
    return rounded(PQ.read_columns(spark, f"{sf_dir}/lineitem.parquet",
                                   ["l_orderkey", "l_linenumber", "l_extendedprice"]))


@register("write_partition_overwrite", O.with_(O.BARS_EVENTS) + """
SELECT localDate, id, round(close, 6) AS close,
       CASE WHEN localDate <= DATE '2024-01-05' THEN volume * 10 ELSE volume END AS volume
FROM bars""")
def q_write_partition_overwrite(spark, sf_dir):
    path = scratch_path(spark, "raw-stock")
    b = FX.bars_events(spark, sf_dir).select(*SC.RAW_STOCK.fieldNames())
    PQ.write_partitions(b, path, SC.RAW_STOCK)
    early = F.col("localDate") <= F.lit("2024-01-05").cast("date")
    PQ.write_partitions(b.filter(early).withColumn("volume", F.col("volume") * 10), path, SC.RAW_STOCK)
    PQ.write_partitions(b.filter(F.lit(False)), path, SC.RAW_STOCK)       # empty: no-op
    back = PQ.read_checked(spark, path, SC.RAW_STOCK)
    return rounded(back.select("localDate", "id", "close", "volume"))


def _two_runs(spark, sf_dir, path):
    b = FX.bars_events(spark, sf_dir).select("localDate", "id", "volume")
    day = F.dayofmonth("localDate")
    PQ.append_run(b.filter(day <= 15), path, "20240101T000000")
    PQ.append_run(b.filter(day > 10).withColumn("volume", F.col("volume") + 1000), path,
                  "20240102T000000")


RUNS_SQL = O.with_(O.BARS_EVENTS) + """, runs AS (
  SELECT localDate, id, volume, '20240101T000000' AS part FROM bars WHERE day(localDate) <= 15
  UNION ALL
  SELECT localDate, id, volume + 1000, '20240102T000000' FROM bars WHERE day(localDate) > 10)"""


@register("append_run_output", RUNS_SQL + " SELECT part AS run, count(*) AS n FROM runs GROUP BY part")
def q_append_run_output(spark, sf_dir):
    path = scratch_path(spark, "runs")
    _two_runs(spark, sf_dir, path)
    return PQ.read_runs(spark, path).groupBy(F.col("_part").alias("run")) \
             .agg(F.count(F.lit(1)).alias("n"))


@register("union_part_files", RUNS_SQL + " SELECT localDate, id, volume, part FROM runs")
def q_union_part_files(spark, sf_dir):
    path = scratch_path(spark, "runs")
    _two_runs(spark, sf_dir, path)
    return PQ.read_runs(spark, path).select("localDate", "id", "volume", F.col("_part").alias("part"))


KEEP_LAST_SQL = O.with_(O.BARS_EVENTS) + """
SELECT localDate, id, CASE WHEN day(localDate) > 10 THEN volume + 1000 ELSE volume END AS volume
FROM bars"""


def _keyed_runs(spark, sf_dir, path):
    """Runs of a (date|symbol)-keyed table for the keep-last dedupe."""
    b = FX.bars_events(spark, sf_dir).select(
        F.concat_ws("|", F.col("localDate").cast("string"), "id").alias("k"),
        "localDate", "id", "volume")
    day = F.dayofmonth("localDate")
    PQ.append_run(b.filter(day <= 15), path, "20240101T000000")
    PQ.append_run(b.filter(day > 10).withColumn("volume", F.col("volume") + 1000), path,
                  "20240102T000000")


@register("dedupe_keep_last", KEEP_LAST_SQL)
def q_dedupe_keep_last(spark, sf_dir):
    path = scratch_path(spark, "runs")
    _keyed_runs(spark, sf_dir, path)
    return DS.dedupe_keep_last(PQ.read_runs(spark, path), "k").select("localDate", "id", "volume")


@register("compact_parts", "SELECT *, 1 AS n_runs FROM (" + KEEP_LAST_SQL + ")")
def q_compact_parts(spark, sf_dir):
    path = scratch_path(spark, "runs")
    _keyed_runs(spark, sf_dir, path)
    PQ.compact_runs(spark, path, "k", "20240103T000000")
    n = len(PQ.list_runs(spark, path))
    back = DS.dedupe_keep_last(PQ.read_runs(spark, path), "k")
    return back.select("localDate", "id", "volume", F.lit(n).alias("n_runs"))


def _news_table(spark, sf_dir):
    db = f"tidemark_{uuid.uuid4().hex[:10]}"
    TB.ensure_database(spark, db, scratch_path(spark, "db"))
    name = f"{db}.news"
    items = FX.articles(spark, sf_dir).select("localDate", "id", F.col("title").alias("headline"),
                                              "body")
    first = TB.append_or_create(items, name)
    second = TB.append_or_create(items, name)
    assert (first, second) == ("create", "append")
    return name


@register("table_append_or_create", O.with_(O.ARTICLES) +
          "SELECT localDate, id, count(*) * 2 AS n FROM articles GROUP BY localDate, id")
def q_table_append_or_create(spark, sf_dir):
    name = _news_table(spark, sf_dir)
    return spark.table(name).groupBy("localDate", "id").agg(F.count(F.lit(1)).alias("n"))


@register("table_scan_if_exists", O.with_(O.ARTICLES) +
          "SELECT localDate, count(*) * 2 AS n FROM articles GROUP BY localDate")
def q_table_scan_if_exists(spark, sf_dir):
    name = _news_table(spark, sf_dir)
    assert TB.scan_if_exists(spark, name + "_absent") is None
    return TB.scan_if_exists(spark, name).groupBy("localDate").agg(F.count(F.lit(1)).alias("n"))


@register("drop_duplicates_id_date", O.with_(O.ARTICLES) +
          "SELECT localDate, id, title AS headline, body FROM articles")
def q_drop_duplicates_id_date(spark, sf_dir):
    name = _news_table(spark, sf_dir)
    TB.dedupe_table(spark, name, ["id", "localDate"])
    return spark.table(name).select("localDate", "id", "headline", "body")


EVENT_PREDS = O.with_(*O.target_chain(O.BARS_EVENTS)) + """, preds AS (
  SELECT * FROM (
    SELECT localDate, id AS symbol,
      lag(CAST(CAST(zscore_1d AS FLOAT) AS DOUBLE)) OVER w AS zscore_1d,
      lag(CAST(CAST(log_return_1d AS FLOAT) AS DOUBLE)) OVER w AS log_return_1d
    FROM targets WINDOW w AS (PARTITION BY id ORDER BY localDate))
  WHERE zscore_1d IS NOT NULL)"""


def _inference_rows(spark, sf_dir):
    preds = RS.previous_day_predictions(target_table(spark, sf_dir))
    return preds.select("localDate", "symbol",
                        *[F.col(m).cast("float").alias(m) for m in SC.INFERENCE.fieldNames()[2:]])


@register("write_predictions", EVENT_PREDS + """
SELECT localDate, symbol, round(zscore_1d, 6) AS zscore_1d, round(log_return_1d, 6) AS log_return_1d
FROM preds""")
def q_write_predictions(spark, sf_dir):
    path = scratch_path(spark, "inference")
    PQ.write_partitions(_inference_rows(spark, sf_dir), path, SC.INFERENCE)
    back = PQ.read_checked(spark, path, SC.INFERENCE)
    return rounded(back.select("localDate", "symbol", "zscore_1d", "log_return_1d"))


@register("partition_value_from_path", EVENT_PREDS + """
SELECT localDate, count(*) AS n FROM preds GROUP BY localDate
UNION ALL
SELECT NULL AS localDate, count(*) AS n FROM preds WHERE localDate = (SELECT min(localDate) FROM preds)""")
def q_partition_value_from_path(spark, sf_dir):
    path = scratch_path(spark, "inference")
    rows = _inference_rows(spark, sf_dir)
    PQ.write_partitions(rows, path, SC.INFERENCE)
    first = rows.select(F.min("localDate")).scalar()
    rows.filter(F.col("localDate") == first).drop("localDate").write.parquet(
        f"{path}/localDate=notadate")
    files = spark.read.option("recursiveFileLookup", "true").parquet(path)
    d = PQ.path_value("localDate", F.col("_metadata.file_path"), "date")
    return files.groupBy(d.alias("localDate")).agg(F.count(F.lit(1)).alias("n"))


MARKS_SQL = O.with_(O.BARS_EVENTS, O.SYMBOLS, O.TDATES, O.ARTICLES)


def _marks(spark, sf_dir, path):
    """Write the outputs of two pipelines; their marks come from the writes."""
    from tidemark.plans.q_stock import panel_inputs
    _, _, d = panel_inputs(spark, sf_dir)
    outputs = {"stock": d.withColumn("v", F.lit(1)),
               "news": FX.articles(spark, sf_dir).select("localDate", "id")}
    for pipeline, rows in outputs.items():
        done = ST.write_observed(rows, lambda df: PQ.write_partitions(df, scratch_path(spark, "out")))
        ST.write_marks(spark.createDataFrame([(pipeline, "lastProcessed", done["newest"])],
                                             "pipeline string, key string, value date"), path)


@register("high_water_mark", MARKS_SQL + """
SELECT 'stock' AS pipeline, 'lastProcessed' AS key, (SELECT max(localDate) FROM tdates) AS value
UNION ALL SELECT 'news', 'lastProcessed', (SELECT max(localDate) FROM articles)
UNION ALL SELECT 'inference', 'lastInferred', DATE '1999-11-01'""")
def q_high_water_mark(spark, sf_dir):
    path = scratch_path(spark, "control")
    _marks(spark, sf_dir, path)
    out = None
    for p, k in (("stock", "lastProcessed"), ("news", "lastProcessed"),
                 ("inference", "lastInferred")):
        r = ST.read_mark(spark, path, p, k, "1999-11-01")
        out = r if out is None else out.unionByName(r)
    return out


@register("joint_watermark", MARKS_SQL + """
SELECT least((SELECT max(localDate) FROM tdates), (SELECT max(localDate) FROM articles)) AS watermark""")
def q_joint_watermark(spark, sf_dir):
    path = scratch_path(spark, "control")
    _marks(spark, sf_dir, path)
    return ST.joint_watermark(ST.read_marks(spark, path), "lastProcessed", ["stock", "news"])


UPSERT_SQL = """
WITH cur AS (SELECT doc_id, quality, toxic FROM labels),
upd AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 1 - quality END AS quality FROM labels
        WHERE doc_id % 3 = 0
        UNION ALL
        SELECT doc_id, CAST(CASE WHEN length(text) > 1000 THEN 1 ELSE 0 END AS INTEGER) FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id % 5 = 0)
SELECT coalesce(c.doc_id, u.doc_id) AS doc_id, {quality} AS quality, c.toxic AS toxic,
       CASE WHEN c.doc_id IS NULL THEN 'insert' WHEN u.doc_id IS NULL THEN 'keep'
            ELSE 'update' END AS action
FROM cur c FULL OUTER JOIN upd u ON c.doc_id = u.doc_id"""


def _upsert_inputs(spark, sf_dir):
    lab = FX.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    docs = FX.table(spark, sf_dir, "documents")
    upd = (lab.filter(F.col("doc_id") % 3 == 0)
              .select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1 - F.col("quality"))
                      .alias("quality"))
              .unionByName(docs.join(lab, "doc_id", "left_anti").filter(F.col("doc_id") % 5 == 0)
                           .select("doc_id", F.when(F.length("text") > 1000, 1).otherwise(0)
                                   .cast("int").alias("quality"))))
    return lab, upd


def _keyed_labels(spark, lab):
    """The labels as a keyed table of their own."""
    db = f"tidemark_{uuid.uuid4().hex[:10]}"
    TB.ensure_database(spark, db, scratch_path(spark, "db"))
    return KeyedTable.create(lab, f"{db}.labels", "doc_id", parts=16, buckets=8)


def _upserted(spark, sf_dir, overwrite):
    """Upsert in place; the table read back, with what became of each key."""
    lab, upd = _upsert_inputs(spark, sf_dir)
    table = _keyed_labels(spark, lab)
    done = table.upsert(upd, overwrite)
    return table.rows().join(done, "doc_id", "left").withColumn(
        "action", F.coalesce("action", F.lit("keep")))


@register("keyed_upsert", UPSERT_SQL.format(quality="coalesce(u.quality, c.quality)"))
def q_keyed_upsert(spark, sf_dir):
    return _upserted(spark, sf_dir, True)


@register("keyed_upsert_if_not_exists", UPSERT_SQL.format(quality="coalesce(c.quality, u.quality)"))
def q_keyed_upsert_keep(spark, sf_dir):
    return _upserted(spark, sf_dir, False)


@register("keyed_get", "SELECT doc_id, quality, toxic FROM labels WHERE doc_id IN "
          "(SELECT doc_id FROM documents WHERE lang = 'en')")
def q_keyed_get(spark, sf_dir):
    lab = FX.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    keys = FX.table(spark, sf_dir, "documents").filter(F.col("lang") == "en")
    return _keyed_labels(spark, lab).get(keys)


@register("keyed_get_delete", "SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN "
          "(SELECT doc_id FROM documents WHERE lang = 'fr')")
def q_keyed_delete(spark, sf_dir):
    lab = FX.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    keys = FX.table(spark, sf_dir, "documents").filter(F.col("lang") == "fr")
    table = _keyed_labels(spark, lab)
    table.delete(keys)
    return table.rows()


@register("missing_partitions", O.with_(O.ARTICLES) +
          "SELECT DISTINCT localDate FROM articles WHERE localDate > DATE '2024-01-15'")
def q_missing_partitions(spark, sf_dir):
    """Dates lacking stored roll-up partitions; only those are computed."""
    from tidemark.plans.q_news import daily
    path = scratch_path(spark, "aggregated")
    d = daily(spark, sf_dir, with_median=False)
    PQ.write_partitions(d.filter(F.col("localDate") <= F.lit("2024-01-15").cast("date")), path)
    wanted = FX.articles(spark, sf_dir).select("localDate").distinct()
    return INC.missing_dates(wanted, spark.read.parquet(path))
