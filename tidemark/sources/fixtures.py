"""Domain inputs derived from the driver's tables.

The engine's functions accept the reference's domain schemas (bars,
articles, sentiment, ...). For tests and the registered queries those inputs
are derived, with Spark, from the driver tables so their size grows with the
scale factor. The same definitions are written in DuckDB SQL in
``tidemark.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rank import row_number_within


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per user: open/close at the first/last (ts, event_id)."""
    ev = table(spark, sf_dir, "events")
    order = F.struct("ts", "event_id")
    return (ev.groupBy(F.to_date("ts").alias("localDate"),
                       F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"))
              .agg(F.max_by("value", order).alias("close"),
                   F.max("value").alias("high"),
                   F.min("value").alias("low"),
                   F.min_by("value", order).alias("open"),
                   F.count(F.lit(1)).alias("volume")))


def bars_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per order priority: long and narrow (5 symbols)."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("localDate"),
                      F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("id"))
             .agg(F.max_by("o_totalprice", "o_orderkey").alias("close"),
                  F.max("o_totalprice").alias("high"),
                  F.min("o_totalprice").alias("low"),
                  F.min_by("o_totalprice", "o_orderkey").alias("open"),
                  F.count(F.lit(1)).alias("volume")))


def bars(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    return bars_events(spark, sf_dir) if source == "events" else bars_orders(spark, sf_dir)


def symbols_from_bars(b: DataFrame) -> DataFrame:
    """Symbol dimension: distinct ids, ``pos`` = 0-based rank by id, sector."""
    ids = b.select("id").distinct()
    ranked = row_number_within(ids, ["id"], out="pos")
    return ranked.select("id", F.substring("id", 1, 1).alias("sector"),
                         F.col("pos").cast("int").alias("pos"))


#: First day, days and days without news of the articles that go with each bar source.
ARTICLE_DAYS = {"events": ("2024-01-01", 30, (6, 13)), "orders": ("1995-01-01", 2400, ())}


def articles(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """News articles from ``documents``, dated over the calendar of ``source``.

    Events: localDate = 2024-01-01 + doc_id % 30 days, dropping residues 6 and 13 so
    some calendar days are empty. Orders: 1995-01-01 + doc_id % 2400 days.
    title = first line, body = the rest.
    """
    d = table(spark, sf_dir, "documents")
    first, days, empty = ARTICLE_DAYS[source]
    res = F.col("doc_id") % days
    nl = F.instr("text", "\n")
    return (d.filter(~res.isin(*empty) if empty else F.lit(True))
             .select(F.date_add(F.lit(first).cast("date"), res.cast("int")).alias("localDate"),
                     F.col("doc_id").cast("string").alias("id"),
                     F.when(nl > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)"))
                      .otherwise(F.col("text")).alias("title"),
                     F.when(nl > 0, F.expr("substring(text, instr(text, '\n') + 1)"))
                      .otherwise(F.lit("")).alias("body"),
                     F.col("doc_id"), F.col("lang")))


def fixed_score(doc_id) -> F.Column:
    """Deterministic stand-in score in [-1, 1] keyed by document id."""
    return ((doc_id * 7919) % 2001 - 1000) / F.lit(1000.0)


def sentiment_fixed(spark: SparkSession, sf_dir: str, normalize: bool = True,
                    source: str = "events") -> DataFrame:
    """Sentiment rows with a fixed score keyed by doc_id (the scorer is
    injected elsewhere); lengths and token counts come from the cleaner."""
    from tidemark.functions import text as TX
    a = articles(spark, sf_dir, source)
    t = a.select("localDate", "id", "doc_id",
                 TX.clean_text(F.col("title"), F.col("body"), normalize).alias("_t"))
    return t.select("localDate", "id",
                    fixed_score(F.col("doc_id")).cast("float").alias("sentiment_score"),
                    TX.text_length(F.col("_t")).alias("text_length"),
                    TX.token_count(F.col("_t")).alias("token_count"))


def _user_no(id_col: str = "id") -> F.Column:
    return F.substring(F.col(id_col), 2, 64).cast("long")


ERROR_PAGE = "<html><body>502 Bad Gateway</body></html>"
NO_DATA = '{"status":{"rCode":200},"data":null}'
CUT_PAGE = '{"response":{"pages":'


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed quote-history payload per user symbol, encoded from
    ``bars_events``: '$' prices with thousands commas, US dates, 'N/A' for
    some volumes. Users with no % 7 == 3 answer 'not found' (1001), no % 19
    == 7 a server failure, no % 11 == 5 'no records'. Before that, no % 17 == 2
    answers an error page, no % 17 == 4 has no data, no % 17 == 9 is cut short."""
    b = bars_events(spark, sf_dir)
    n = _user_no()
    money = lambda c: F.concat(F.lit("$"), F.format_number(F.col(c), 2))
    vol = F.when((n + F.dayofmonth("localDate")) % 13 == 0, F.lit("N/A")) \
           .otherwise(F.format_number(F.col("volume"), 0))
    row = F.struct(F.date_format("localDate", "MM/dd/yyyy").alias("date"),
                   money("close").alias("close"), money("high").alias("high"),
                   money("low").alias("low"), money("open").alias("open"),
                   vol.alias("volume"))
    per = b.groupBy("id").agg(F.collect_list(row).alias("rows"))
    n = _user_no()
    status = (F.when(n % 7 == 3, F.lit(400)).when(n % 19 == 7, F.lit(500))
               .otherwise(F.lit(200)))
    codes = (F.when(n % 7 == 3, F.array(F.struct(F.lit(1001).alias("code"))))
              .when(n % 19 == 7, F.array(F.struct(F.lit(9999).alias("code")))))
    empty = n % 11 == 5
    payload = F.struct(
        F.struct(status.alias("rCode"), codes.alias("bCodeMessage")).alias("status"),
        F.struct(F.when(empty, 0).otherwise(F.size("rows")).alias("totalRecords"),
                 F.struct(F.when(empty, F.array().cast(
                     "array<struct<date:string,close:string,high:string,low:string,"
                     "open:string,volume:string>>")).otherwise(F.col("rows")).alias("rows"))
                 .alias("tradesTable")).alias("data"))
    whole = F.to_json(payload)
    landed = (F.when(n % 17 == 2, F.lit(ERROR_PAGE)).when(n % 17 == 4, F.lit(NO_DATA))
               .when(n % 17 == 9, F.expr("left(whole, length(whole) - 20)")).otherwise(whole))
    return per.withColumn("whole", whole).select("id", landed.alias("payload"))


PILLAR_BY_LANG = {"en": "pillar/news", "de": "Pillar/News", "fr": "pillar/arts",
                  "es": "pillar/sport"}


def news_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed search pages per date encoded from ``articles``: pillar by
    language, blank bodies for doc_id % 17 == 0 and (in Unicode blanks) % 29 == 0,
    no title for % 23 == 0; page = doc_id // 1500 + 1 (pages of at most 50 results
    per day). Days of month ending in 3 land one more page that is cut short; days
    ending in 7 announce two pages that never land."""
    a = articles(spark, sf_dir)
    pillar = F.col("lang")
    for k, v in PILLAR_BY_LANG.items():
        pillar = F.when(F.col("lang") == k, F.lit(v)).otherwise(pillar)
    body = (F.when(F.col("doc_id") % 17 == 0, F.lit("  \t "))
             .when(F.col("doc_id") % 29 == 0, F.lit("\u2003\u2028 ")).otherwise(F.col("body")))
    title = F.when(F.col("doc_id") % 23 == 0, F.lit(None)).otherwise(F.col("title"))
    res = F.struct(F.col("id"), pillar.alias("pillarId"), title.alias("webTitle"),
                   F.struct(body.alias("bodyText")).alias("fields"))
    paged = a.withColumn("page", (F.col("doc_id") / 1500).cast("long") + 1)
    per_page = paged.groupBy("localDate", "page").agg(F.collect_list(res).alias("results"))
    pages = paged.groupBy("localDate").agg(F.max("page").alias("pages"))
    last = F.dayofmonth("localDate") % 10
    said = F.col("pages") + F.when(last == 7, 2).otherwise(0)
    out = per_page.join(pages, "localDate").select("localDate", "page", F.to_json(F.struct(
        F.struct(said.cast("int").alias("pages"), F.col("results").alias("results"))
        .alias("response"))).alias("payload"))
    cut = pages.filter(last == 3).select("localDate", (F.col("pages") + 1).alias("page"),
                                         F.lit(CUT_PAGE).alias("payload"))
    return out.unionByName(cut)


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker-like symbols from part names; every fourth carries a '.B' class,
    and some are the renamed ticker in either case."""
    p = table(spark, sf_dir, "part")
    base = F.upper(F.concat(F.substring(F.split("p_name", " ").getItem(1), 1, 3),
                            F.substring("p_name", 1, 1)))
    k = F.col("p_partkey")
    t = (F.when(k % 50 == 7, F.lit("FI")).when(k % 50 == 9, F.lit("fi"))
          .when(k % 4 == 0, F.concat(base, F.lit(".B"))).otherwise(base))
    return p.select("p_partkey", t.alias("symbol"))
