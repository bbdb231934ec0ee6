"""Landed payload decoding, numeric cleaning, dates, aliases, filters."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import numeric as N
from tidemark.sources import payloads as PL


def _price(spark, payloads):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in payloads], "id string, payload string")


def test_decode_price_payloads(spark):
    ok = {"status": {"rCode": 200}, "data": {"totalRecords": 2, "tradesTable": {"rows": [
        {"date": "11/21/2025", "close": "$1,234.50", "high": "$1,240.00", "low": "$1,200.25",
         "open": "$1,210.00", "volume": "12,345"},
        {"date": "11/20/2025", "close": "$10.00", "high": "$11.00", "low": "$9.00",
         "open": "$9.50", "volume": "N/A"}]}}}
    empty = {"status": {"rCode": 200}, "data": {"totalRecords": 0, "tradesTable": {"rows": []}}}
    missing = {"status": {"rCode": 400, "bCodeMessage": [{"code": 1001}]}, "data": None}
    broken = {"status": {"rCode": 400, "bCodeMessage": [{"code": 42}]}, "data": None}
    bars, q = PL.decode_price_payloads(_price(spark, [("A", ok), ("B", empty), ("C", missing),
                                                      ("D", broken)]))
    rows = {r.localDate: r for r in bars.collect()}
    assert rows[dt.date(2025, 11, 21)].close == 1234.5 and rows[dt.date(2025, 11, 21)].volume == 12345
    assert rows[dt.date(2025, 11, 20)].volume == 0
    assert {(r.id, r.reason) for r in q.collect()} == {("C", "symbol_not_found"), ("D", "failure")}


def test_bad_price_fails(spark):
    bad = {"status": {"rCode": 200}, "data": {"totalRecords": 1, "tradesTable": {"rows": [
        {"date": "11/21/2025", "close": "abc", "high": "1", "low": "1", "open": "1", "volume": "1"}]}}}
    bars, _ = PL.decode_price_payloads(_price(spark, [("A", bad)]))
    with pytest.raises(Exception):
        bars.collect()


def test_symbol_alias(spark):
    df = spark.createDataFrame([("fi",), ("FI",), ("BF.B",), ("MSFT",)], "s string")
    got = [r[0] for r in df.select(PL.symbol_alias(F.col("s"))).collect()]
    assert got == ["FISV", "FISV", "BF%25sl%25B", "MSFT"]


def test_news_filter(spark):
    res = [{"id": "1", "pillarId": "pillar/news", "webTitle": "t1", "fields": {"bodyText": "b"}},
           {"id": "2", "pillarId": "Pillar/NEWS", "webTitle": "t2", "fields": {"bodyText": " x "}},
           {"id": "3", "pillarId": "pillar/sport", "webTitle": "t3", "fields": {"bodyText": "b"}},
           {"id": "4", "pillarId": "pillar/news", "webTitle": "t4", "fields": {"bodyText": " \t"}},
           {"id": "5", "pillarId": "pillar/news", "fields": {"bodyText": "b"}},
           {"id": "6", "pillarId": "pillar/news", "webTitle": "t6"}]
    landed = spark.createDataFrame([(dt.date(2024, 1, 1), 1, json.dumps({"response": {
        "pages": 1, "results": res}}))], "localDate date, page int, payload string")
    assert sorted(r.id for r in PL.decode_news_payloads(landed).collect()) == ["1", "2"]


def test_numbers_and_dates(spark):
    df = spark.createDataFrame([("$1,234.56", "N/A", "03/07/2024", dt.date(2024, 1, 5))],
                               "p string, v string, d string, day date")
    r = df.select(N.parse_price(F.col("p")).alias("p"), N.parse_volume(F.col("v")).alias("v"),
                  D.parse_us_date(F.col("d")).alias("d"),
                  D.next_weekday(F.col("day")).alias("fri_next"),
                  D.next_weekday(F.date_add(F.col("day"), 1)).alias("sat_next"),
                  N.scale_clip(F.lit(12.0)).alias("clip"), N.sign(F.lit(-0.0)).alias("z")).first()
    assert (r.p, r.v, r.d) == (1234.56, 0, dt.date(2024, 3, 7))
    assert r.fri_next == dt.date(2024, 1, 8) and r.sat_next == dt.date(2024, 1, 8)
    assert r.clip == 10000.0 and r.z == 0


def test_undecodable_prices_are_quarantined(spark):
    whole = json.dumps({"status": {"rCode": 200}, "data": {"totalRecords": 2, "tradesTable": {
        "rows": [{"date": "11/21/2025", "close": "1", "high": "1", "low": "1", "open": "1",
                  "volume": "1"}] * 2}}})
    rows = [("ok", whole), ("cut", whole[:-30]), ("html", "<html>502</html>"), ("null", None),
            ("empty", ""), ("no_total", '{"status":{"rCode":200},"data":{}}'),
            ("no_data", '{"status":{"rCode":200},"data":null}'), ("no_status", '{"data":null}'),
            ("no_rows", '{"status":{"rCode":200},"data":{"totalRecords":3}}')]
    df = spark.createDataFrame(rows, "id string, payload string")
    for strict in (True, False):
        bars, q = PL.decode_price_payloads(df, strict)
        assert [r.id for r in bars.collect()] == ["ok", "ok"]
        assert {(r.id, r.payload) for r in q.collect()} == set(rows[1:])
        assert {r.reason for r in q.collect()} == {"undecodable"}


def test_news_pages_are_all_accounted_for(spark):
    page = lambda n, k: json.dumps({"response": {"pages": n, "results": [
        {"id": f"{k}", "pillarId": "pillar/news", "webTitle": "t", "fields": {"bodyText": "b"}}]}})
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    landed = spark.createDataFrame(
        [(d1, 1, page(4, 1)), (d1, 3, "{"), (d1, 4, page(4, 4)), (d2, 1, page(1, 9))],
        "localDate date, page int, payload string")
    assert sorted(r.id for r in PL.decode_news_payloads(landed).collect()) == ["1", "4", "9"]
    assert {tuple(r) for r in PL.news_quarantine(landed).collect()} == {
        (d1, 2, "missing_page", None), (d1, 3, "undecodable", "{")}


def test_unicode_blank_bodies_are_dropped(spark):
    res = [{"id": k, "pillarId": "pillar/news", "webTitle": "t", "fields": {"bodyText": b}}
           for k, b in (("blank", "\u2003\u2028"), ("nbsp", "\u00a0"), ("text", "\u2003x"))]
    landed = spark.createDataFrame([(dt.date(2024, 1, 1), 1, json.dumps({"response": {
        "pages": 1, "results": res}}))], "localDate date, page int, payload string")
    assert sorted(r.id for r in PL.decode_news_payloads(landed).collect()) == ["nbsp", "text"]


def test_unknown_fields_stay_with_their_row(spark):
    rows = [{"date": "11/21/2025", "close": 1.5, "high": "2", "low": "1", "open": "1", "volume": 7,
             "split": {"by": 2}}, {"date": "11/20/2025"}]
    price = {"status": {"rCode": 200, "note": "x"}, "data": {"totalRecords": 2, "tradesTable": {
        "rows": rows}}}
    got = PL.routed_prices(_price(spark, [("A", price)])).orderBy("localDate").collect()
    assert [(r.close, r.volume, r.more) for r in got] == [
        (None, 0, None), (1.5, 7, {"split": '{"by":2}'})]
    page = {"response": {"pages": 1, "results": [
        {"id": 5, "pillarId": "pillar/news", "webTitle": "t", "fields": {"bodyText": "b"}, "tone": "z"}]}}
    landed = spark.createDataFrame([(dt.date(2024, 1, 1), 1, json.dumps(page))],
                                   "localDate date, page int, payload string")
    got = PL.routed_pages(landed).where("not is_page").collect()
    assert [(r.id, r.more) for r in got] == [("5", {"tone": "z"})]


def test_fields_of_another_type_are_undecodable(spark):
    ok = '{"status":{"rCode":200},"data":{"totalRecords":1,"tradesTable":{"rows":%s}}}'
    rows = [("text", '{"status":{"rCode":"200"},"data":null}'), ("half", ok.replace("200", "200.5") % "[]"),
            ("null_row", ok % "[null]"), ("number_row", ok % "[1]"), ("no_list", ok % '"x"'),
            ("twice", '{"status":{"rCode":200,"rCode":400},"data":null}'),
            ("total", ok.replace(":1,", ':"1",') % "[]")]
    _, q = PL.decode_price_payloads(spark.createDataFrame(rows, "id string, payload string"))
    assert {(r.id, r.reason) for r in q.collect()} == {(k, "undecodable") for k, _ in rows}
    days = [(dt.date(2024, 1, 1), k, p) for k, p in enumerate(
        ['{"response":{"pages":"1","results":[]}}', '{"response":{"pages":1,"results":{}}}', None])]
    q = PL.news_quarantine(spark.createDataFrame(days, "localDate date, page int, payload string"))
    assert {(r.page, r.reason) for r in q.collect()} == {(k, "undecodable") for k in range(3)}


def test_one_scan_routes_bars_and_quarantine(spark):
    df = spark.createDataFrame([], "id string, payload string")
    bars, q = PL.decode_price_payloads(df)
    assert bars.count() == 0 and q.count() == 0
    for routed in (PL.routed_prices(df), PL.routed_pages(df.selectExpr(
            "current_date() AS localDate", "1 AS page", "payload"))):
        plan = routed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == 1 and plan.count("LogicalRDD") == 1
