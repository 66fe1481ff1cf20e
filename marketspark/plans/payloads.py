"""Raw payloads in the shape the feeds deliver them, derived from the tables.

Pages hold at most ``PAGE`` listing rows or one month of prices, so every
collected list is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import views

PAGE = 50


def listing(spark, sf) -> DataFrame:
    """Supplier rows with market and the numbers a market listing shows."""
    supplier = views.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("symbol"), "s_suppkey", "s_acctbal")
    return views.symbols(spark, sf).join(supplier, "symbol").withColumn("page", F.floor(F.col("s_suppkey") / PAGE))


def snapshot_pages(spark, sf) -> DataFrame:
    rows = listing(spark, sf)
    key, bal = F.col("s_suppkey"), F.col("s_acctbal")
    item = F.struct(
        F.concat(F.lit("A"), F.lpad("symbol", 6, "0")).alias("symbolCode"), "name",
        F.when(bal >= 0, bal).alias("tradePrice"),
        F.element_at(F.array(F.lit("RISE"), F.lit("FALL"), F.lit("EVEN"), F.lit("HALT")), (key % 4 + 1).cast("int")).alias("change"),
        F.when(key % 7 != 0, key * 10).alias("changePrice"),
        (key % 700 / 10000.0).alias("changeRate"),
        (key * 1000003).alias("accTradeVolume"),
        (key * 1000003 * 50).alias("accTradePrice"),
        (key % 97 / 1000.0).alias("foreignRatio"),
    )
    return rows.groupBy("market", "page").agg(
        F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("body"))


def _page(rows_html, css_class: str):
    return F.concat(
        F.lit(f'<html><body><div>head</div><table class="{css_class}"><tr><th>x</th></tr>'),
        F.array_join(rows_html, "\n"), F.lit("</table><table class=\"other\"><tr><td>1</td></tr></table></body></html>"))


def _cell(x):
    return F.concat(F.lit('<td class="number">'), x, F.lit("</td>"))


def ranking_pages(spark, sf) -> DataFrame:
    """HTML market ranking: a spacer row without link and short rows included."""
    rows = listing(spark, sf)
    key = F.col("s_suppkey")
    link = F.concat(
        F.lit('<td><a href="/item/main.nhn?code='), F.lpad("symbol", 6, "0"), F.lit('&amp;page=1" class="tltle"> '),
        F.col("name"), F.lit(" &amp; Co </a></td>"))
    cells = [
        _cell(F.col("symbol")), link, _cell(F.format_number(key * 1234, 0)), _cell(F.lit("<span>1,000</span>")),
        _cell(F.concat(F.when(key % 3 == 0, "+").otherwise("-"), F.format_number(key % 31 / 4.0, 2), F.lit("%"))),
        _cell(F.lit("500")), _cell(F.format_number(key * 99, 0)), _cell(F.lit("7")), _cell(F.lit("8")),
        _cell(F.when(key % 11 == 0, "N/A").otherwise(F.format_number(key * 777, 0))),
    ]
    full = F.concat(F.lit("<tr onmouseover=\"x()\">"), *cells, F.lit("</tr>"))
    short = F.concat(F.lit("<tr>"), *cells[:5], F.lit("</tr>"))
    row = F.when(key % 13 == 5, short).otherwise(full)
    return rows.groupBy("market", "page").agg(_page(F.collect_list(row), "type_2").alias("body"))


def price_pages(spark, sf) -> DataFrame:
    """HTML price history, one page per symbol and month."""
    bars = views.daily_bars(spark, sf)
    number = lambda c: F.format_number(F.floor(F.col(c)), 0)
    row = F.concat(
        F.lit("<tr>"), _cell(F.date_format("date", "yyyy.MM.dd")), _cell(number("close")), _cell(F.lit("<img/> 10")),
        _cell(number("open")), _cell(number("high")),
        _cell(F.when(F.dayofmonth("date") == 13, "").otherwise(number("low"))), _cell(number("volume")),
        F.lit('</tr><tr><td colspan="7"></td></tr>'))
    return bars.groupBy("symbol", F.trunc("date", "month").alias("month")).agg(
        _page(F.collect_list(row), "type2").alias("body"))


def info_pages(spark, sf) -> DataFrame:
    """Company pages; every seventh was not fetched, every third lacks the rate."""
    rows = listing(spark, sf)
    key = F.col("s_suppkey")
    body = F.concat(
        F.lit('<div class="wrap_company"><h2><a href="#">'), F.col("name"), F.lit('</a></h2></div><p class="no_today"><em><span class="blind">'),
        F.format_number(key * 1234, 0), F.lit('</span></em></p><p class="no_exday"><em><span class="blind">'),
        F.format_number(key * 12, 0), F.lit("</span></em>"),
        F.when(key % 3 != 0, F.concat(F.lit('<em class="nv01"><span class="blind">'), F.format_number(key / 8.0, 3), F.lit("</span></em>"))).otherwise(""),
        F.lit("</p>"))
    return rows.select(F.col("symbol").alias("ticker"), F.when(key % 7 != 0, body).alias("body"))


def macro_payloads(spark, sf) -> DataFrame:
    """Statistics responses per code and year; one priority answers with an error."""
    rows = views.macro(spark, sf).withColumn("year", F.substring("time", 1, 4))
    item = F.struct(
        F.lit("order value").alias("STAT_NAME"), F.col("stat_code").alias("ITEM_CODE1"), F.lit("").alias("ITEM_NAME1"),
        F.col("cycle").alias("CYCLE"), F.col("time").alias("TIME"),
        F.when(F.col("time").endswith("12"), "").otherwise(F.col("value").cast("string")).alias("DATA_VALUE"),
        F.lit("won").alias("UNIT_NAME"))
    good = F.to_json(F.struct(F.struct(F.collect_list(item).alias("row")).alias("StatisticSearch")))
    error = F.lit('{"RESULT":{"CODE":"INFO-200","MESSAGE":"no data"}}')
    return rows.groupBy("stat_code", "year").agg(good.alias("good")).select(
        "stat_code", F.when(F.col("stat_code") == "5-LOW", error).otherwise(F.col("good")).alias("body"))


def tick_messages(spark, sf) -> DataFrame:
    """Keyed JSON tick messages with partition and offset; some are damaged."""
    ticks = views.ticks(spark, sf)
    event = ticks.select(
        "event_id", "symbol", "name", "market", "price", "open", "high", "low", "close", "volume", "change_pct",
        F.lit(0.0).alias("change_price"), F.lit(0.0).alias("foreign_ratio"), F.lit("sim").alias("source"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"))
    body = F.to_json(F.struct(*[c for c in event.columns if c != "event_id"]))
    key = F.col("event_id")
    value = (
        F.when(key % 50 == 7, F.expr("substring(body, 1, length(body) - 3)"))
        .when(key % 50 == 8, F.replace(F.col("body"), F.lit('"market":"SIM",'), F.lit("")))
        .when(key % 50 == 9, F.replace(F.col("body"), F.lit('"market":"SIM",'), F.lit('"market":"SIM","extra":1,')))
        .otherwise(F.col("body"))
    )
    return event.withColumn("body", body).select(
        F.col("symbol").alias("key"), value.alias("value"), (key % 6).cast("int").alias("partition"),
        F.floor(key / 6).alias("offset"))


def damaged_messages(spark, sf) -> DataFrame:
    """Keyed tick messages with event time and place, of which some are cut short, have an unknown field, a text for a price, no symbol or no time."""
    key = F.col("event_id")
    event = views.ticks(spark, sf).select(
        key, "event_time", F.col("symbol").alias("key"), F.when(key % 50 != 10, F.col("symbol")).alias("symbol"), "name", "market",
        F.when(key % 50 == 9, "abc").otherwise(F.col("price").cast("string")).alias("price"), "volume", "change_pct",
        F.when(key % 50 == 11, "garbage").otherwise(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("timestamp"))
    body = F.to_json(F.struct("symbol", "name", "market", "price", "volume", "change_pct", "timestamp"), {"ignoreNullFields": "false"})
    # Prices are numbers in the messages; only the text stays quoted.
    body = F.regexp_replace(body, '"price":"([0-9.E]+)"', '"price":$1')
    value = (
        F.when(key % 50 == 7, F.expr("substring(body, 1, length(body) - 3)"))
        .when(key % 50 == 8, F.replace(F.col("body"), F.lit('"market":"SIM",'), F.lit('"market":"SIM","extra":1,')))
        .otherwise(F.col("body")))
    return event.withColumn("body", body).select(
        "event_time", "key", value.alias("value"), (key % 6).cast("int").alias("partition"), F.floor(key / 6).alias("offset"))


def field_messages(spark, sf) -> DataFrame:
    """Listing rows as JSON of either source, a few cut short or of unknown origin."""
    rows = listing(spark, sf)
    key = F.col("s_suppkey")
    a = F.to_json(F.struct(
        F.lpad("symbol", 6, "0").alias("symbol_code"), "name", (key * 10).alias("trade_price"),
        (key % 100 / 4.0).alias("change_rate"), (key * 7).alias("acc_trade_volume"), "market"))
    b = F.to_json(F.struct(
        F.lpad("symbol", 6, "0").alias("code"), "name", (key * 10).alias("current_price"),
        (key % 100 / 4.0).alias("change_rate"), (key * 7).alias("volume"), "market"))
    text = F.when(key % 2 == 0, a).otherwise(b)
    return rows.select(
        "symbol",
        F.when(key % 23 == 4, "feed").when(key % 2 == 0, "daum").otherwise("naver").alias("source"),
        F.when(key % 17 == 3, F.substring(text, 1, 20)).otherwise(text).alias("value"))
