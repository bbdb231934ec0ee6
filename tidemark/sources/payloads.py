"""Landed API payloads -> rows.

Quote-history and news-search responses are landed as JSON text (one payload per
symbol, or per date and page). A payload is parsed once, into a VARIANT; its known
fields are extracted by path, and one frame routes every payload to rows or to the quarantine
(:func:`routed_prices`, :func:`routed_pages`). A job that stores both keeps that frame and
reads it twice. Fields that are not known stay with their row, in ``more``.

Defined results: null and empty payloads, text that is no JSON or that repeats a key, and
payloads beyond the size limit of VARIANT are undecodable; numbers and texts in known text fields
count alike; counts and codes must be whole numbers; repeated payloads give their rows again;
an empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.dates import parse_us_date
from tidemark.functions.numeric import bad_number, parse_price, parse_volume

PRICE_FIELDS = ("date", "close", "high", "low", "open", "volume")
ARTICLE_FIELDS = ("id", "pillarId", "webTitle", "fields")
_MAP = "map<string,string>"
#: White space of a blank body (``Character.isWhitespace``).
BLANK = r"\t-\r\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000"


def _at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _whole(v: Column, path: str) -> Column:
    """A whole number at a path; null where there is none."""
    return F.when(F.schema_of_variant(_at(v, path)) == "BIGINT", F.try_variant_get(v, path, "int"))


def _odd(v: Column, path: str) -> Column:
    """Whether something other than a whole number or null stands at a path."""
    return F.coalesce(~F.schema_of_variant(_at(v, path)).isin("BIGINT", "VOID"), F.lit(False))


def _more(fields: Column, known: tuple[str, ...]) -> Column:
    """The fields that are not known, null without any."""
    rest = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    return F.when(F.size(rest) > 0, rest)


def routed_prices(landed: DataFrame, strict: bool = True) -> DataFrame:
    """``landed(id, payload)`` -> one row for each bar (``reason`` null) or quarantined payload
    (the bar's columns null), from one parse.

    A payload yields bars with ``status.rCode = 200`` and ``data.totalRecords > 0``,
    and nothing with ``totalRecords = 0``. Every other payload goes to the
    quarantine (id, rcode, code, reason, payload): code 1001 is a missing
    symbol, another status a failure, and what cannot be decoded (no JSON, cut
    short, without status, record count or rows) is undecodable. A price or date
    that does not parse fails the query, or, unless ``strict``, puts its
    whole payload into the quarantine as a bad value.
    """
    paths = {"rcode": "$.status.rCode", "total": "$.data.totalRecords",
             "code": "$.status.bCodeMessage[0].code"}
    v = F.col("v")
    p = landed.select("id", "payload", F.try_parse_json("payload").alias("v"))
    p = p.select("id", "payload", *[_whole(v, x).alias(c) for c, x in paths.items()],
                 F.try_variant_get(v, "$.data.tradesTable.rows", f"array<{_MAP}>").alias("rows"),
                 (v.isNull() | _odd(v, paths["rcode"]) | _odd(v, paths["total"])
                  | _odd(v, paths["code"])).alias("broken"))
    rows, rcode, total = F.col("rows"), F.col("rcode"), F.col("total")
    undecodable = F.col("broken") | rcode.isNull() | ((rcode == 200) & (
        total.isNull() | ((total > 0) & (rows.isNull() | F.exists(rows, lambda r: r.isNull())))))
    reason = (F.when(undecodable, "undecodable")
              .when(rcode != 200, F.when(
                  F.col("code") == C.SYMBOL_NOT_FOUND_CODE, "symbol_not_found").otherwise("failure")))
    if not strict:
        bad = lambda r: (parse_us_date(r["date"], strict=False).isNull()
                         | F.exists(F.array(r["close"], r["high"], r["low"], r["open"]),
                                    lambda v: v.isNotNull() & bad_number(v)))
        reason = reason.when((total > 0) & F.exists(rows, bad), "bad_value")
    p = p.withColumn("reason", reason)
    out = F.col("reason").isNotNull()
    r = F.col("r")
    p = p.select("id", "reason", *[F.when(~F.col("broken"), F.col(c)).alias(c)
                                   for c in ("rcode", "code")],
                 F.when(out, F.col("payload")).alias("payload"),
                 F.explode(F.when(out, F.array(F.lit(None).cast(_MAP)))
                           .when(total > 0, rows)).alias("r"))
    return p.select(
        "id", "reason", "rcode", "code", "payload", parse_us_date(r["date"]).alias("localDate"),
        *[parse_price(r[c]).alias(c) for c in PRICE_FIELDS[1:5]],
        F.when(r.isNotNull(), parse_volume(r["volume"])).alias("volume"),
        _more(r, PRICE_FIELDS).alias("more"))


def bars_of(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("reason").isNull()).select("localDate", "id", *PRICE_FIELDS[1:])


def quarantine_of(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("reason").isNotNull()).select("id", "rcode", "code", "reason", "payload")


def decode_price_payloads(landed: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(bars, quarantine) of landed payloads; see :func:`routed_prices`."""
    routed = routed_prices(landed, strict)
    return bars_of(routed), quarantine_of(routed)


def article_keep() -> Column:
    """Keep news-pillar results (case-insensitive) with a non-blank body and
    all of id, pillarId, webTitle and fields.bodyText present."""
    return (F.col("id").isNotNull() & F.col("pillar").isNotNull() & F.col("title").isNotNull()
            & F.col("body").isNotNull() & (F.lower("pillar") == C.PILLAR_NEWS)
            & F.col("body").rlike(f"[^{BLANK}]"))


def routed_pages(landed: DataFrame) -> DataFrame:
    """``landed(localDate, page, payload)`` -> one row for each page (``is_page``; ``pages`` is
    the number its response announces, ``reason`` and ``payload`` are set where it is
    undecodable) and one for each kept article, from one parse."""
    v, r = F.col("v"), F.col("r")
    p = landed.select("localDate", F.col("page").cast("long").alias("page"), "payload",
                      F.try_parse_json("payload").alias("v"))
    p = p.select("localDate", "page", "payload", _whole(v, "$.response.pages").alias("pages"),
                 F.try_variant_get(v, "$.response.results", "array<variant>").alias("results"))
    whole = F.col("pages").isNotNull() & F.col("results").isNotNull()
    page = F.array(F.lit(None).cast("variant"))
    p = p.select("localDate", "page", F.when(whole, F.col("pages")).alias("pages"),
                 F.when(~whole, "undecodable").alias("reason"),
                 F.when(~whole, F.col("payload")).alias("payload"),
                 F.posexplode(F.when(whole, F.concat(page, F.col("results"))).otherwise(page))
                 .alias("at", "r"))
    get = lambda path: F.try_variant_get(r, path, "string")
    p = p.select("localDate", "page", "pages", "reason", "payload", (F.col("at") == 0).alias("is_page"),
                 get("$.id").alias("id"), get("$.pillarId").alias("pillar"),
                 get("$.webTitle").alias("title"), get("$.fields.bodyText").alias("body"),
                 _more(F.try_variant_get(r, "$", _MAP), ARTICLE_FIELDS).alias("more"))
    return p.where(F.col("is_page") | article_keep())


def articles_of(routed: DataFrame) -> DataFrame:
    return routed.where(~F.col("is_page")).select("localDate", "id", "title", "body")


def page_quarantine_of(routed: DataFrame) -> DataFrame:
    """(localDate, page, reason, payload): landed pages that cannot be decoded,
    and pages that a day's responses announce but that did not land."""
    pages = routed.where("is_page")
    bad = pages.where(F.col("reason").isNotNull()).select("localDate", "page", "reason", "payload")
    due = (pages.groupBy("localDate").agg(F.max("pages").alias("n"))
           .filter("n > 0").select("localDate", F.explode(F.sequence(
               F.lit(1).cast("long"), F.col("n").cast("long"))).alias("page")))
    gone = due.join(pages.select("localDate", "page"), ["localDate", "page"], "left_anti")
    return bad.unionByName(gone.select("localDate", "page", F.lit("missing_page").alias("reason"),
                                       F.lit(None).cast("string").alias("payload")))


def decode_news_payloads(landed: DataFrame) -> DataFrame:
    """``landed(localDate, page, payload)`` -> articles(localDate, id, title,
    body) of every page that decodes; :func:`news_quarantine` has the rest."""
    return articles_of(routed_pages(landed))


def news_quarantine(landed: DataFrame) -> DataFrame:
    return page_quarantine_of(routed_pages(landed))


def symbol_alias(symbol: Column, aliases=C.SYMBOL_ALIASES) -> Column:
    """Ticker the quote API expects: renamed tickers (case-insensitive), else
    '.' escaped as the API's separator."""
    expr = F.replace(symbol, F.lit("."), F.lit(C.SYMBOL_DOT_ESCAPE))
    for old, new in reversed(aliases):
        expr = F.when(F.upper(symbol) == old.upper(), F.lit(new)).otherwise(expr)
    return expr
