"""Queries over raw payloads, messages, canonical events and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schemas import TICK
from ..sources import canonical, ingest, messages, panel, views
from . import payloads
from .registry import BARS, MACRO, SYMBOLS, TICKS, query, with_ctes

LISTING = """listing AS (SELECT s.symbol, s.name, s.market, s_suppkey AS k, s_acctbal AS bal
  FROM symbols s JOIN supplier p ON s.symbol = CAST(p.s_suppkey AS VARCHAR))"""
_SNAP = """snap AS (SELECT lpad(symbol, 6, '0') AS symbol_code, name, market, CAST(trunc(bal) AS BIGINT) AS trade_price,
  CASE k % 4 WHEN 0 THEN '상승' WHEN 1 THEN '하락' WHEN 2 THEN '보합' ELSE 'HALT' END AS change,
  CASE WHEN k % 7 = 0 THEN 0 ELSE k * 10 END AS change_price,
  round((k % 700) / CAST(10000 AS DOUBLE) * 100, 4) AS change_rate, k * 1000003 AS acc_trade_volume,
  k * 1000003 * 50 AS acc_trade_price, round((k % 97) / CAST(1000 AS DOUBLE) * 100, 4) AS foreign_ratio
  FROM listing WHERE bal >= 0)"""


@query("s6_snapshot_json", with_ctes(SYMBOLS, LISTING, _SNAP, body="SELECT * FROM snap"))
def s6(spark, sf):
    return ingest.snapshot_json(payloads.snapshot_pages(spark, sf))


_RANK = """ranking AS (SELECT lpad(symbol, 6, '0') AS code, name || ' & Co' AS name, market, k * 1234 AS current_price,
  (CASE WHEN k % 3 = 0 THEN 1 ELSE -1 END) * round((k % 31) / CAST(4 AS DOUBLE), 2) + 0 AS change_rate,
  CASE WHEN k % 11 = 0 THEN 0 ELSE k * 777 END AS volume, k * 99 AS market_cap FROM listing WHERE k % 13 <> 5)"""


@query("s7_snapshot_html", with_ctes(SYMBOLS, LISTING, _RANK, body="SELECT * FROM ranking"))
def s7(spark, sf):
    rows = ingest.snapshot_html(payloads.ranking_pages(spark, sf))
    return rows.withColumn("change_rate", F.col("change_rate") + 0.0)


_PRICES = """prices AS (SELECT symbol, "date", floor(open) AS open, floor(high) AS high, floor(low) AS low,
  floor("close") AS "close", CAST(volume AS DOUBLE) AS volume FROM bars WHERE day("date") <> 13)"""


@query("s8_daily_price_html", with_ctes(BARS, _PRICES, body="SELECT * FROM prices"))
def s8(spark, sf):
    return ingest.daily_prices_html(payloads.price_pages(spark, sf))


@query("p6_date_range", with_ctes(BARS, body="""
SELECT symbol, "date", "close" FROM bars WHERE "date" BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"""))
def p6(spark, sf):
    bars = views.daily_bars(spark, sf).select("symbol", "date", "close")
    return ingest.between_dates(bars, "1997-01-01", "1998-12-31")


@query("s9_market_list_html", with_ctes(SYMBOLS, LISTING, body="""
SELECT name || ' & Co' AS name, lpad(symbol, 6, '0') AS ticker, CAST(k * 1234 AS VARCHAR) AS price, '1000' AS change,
       '500' AS volume, CAST(k * 99 AS VARCHAR) AS market_cap, upper(market) AS market FROM listing WHERE k % 13 <> 5"""))
def s9(spark, sf):
    pages = payloads.ranking_pages(spark, sf).withColumn("body", F.replace("body", F.lit("&amp;page=1"), F.lit("")))
    return ingest.market_list_html(pages).drop("change_rate")


@query("s10_stock_info_html", with_ctes(SYMBOLS, LISTING, body="""
SELECT symbol AS ticker, CASE WHEN k % 7 <> 0 THEN name ELSE '' END AS name,
       CASE WHEN k % 7 <> 0 THEN CAST(k * 1234 AS VARCHAR) ELSE '' END AS price,
       CASE WHEN k % 7 <> 0 THEN CAST(k * 12 AS VARCHAR) ELSE '' END AS change,
       CASE WHEN k % 7 <> 0 AND k % 3 <> 0 THEN format('{:,.3f}', k / CAST(8 AS DOUBLE)) ELSE '' END AS rate,
       CASE WHEN k % 7 = 0 THEN 'page not fetched' END AS error FROM listing"""))
def s10(spark, sf):
    return ingest.stock_info_html(payloads.info_pages(spark, sf))


@query("s11_macro_events", with_ctes(MACRO, body="""
SELECT stat_code, 'order value' AS stat_name, stat_code AS item_code1, '' AS item_name1, cycle, "time",
       CASE WHEN "time" LIKE '%12' THEN 0 ELSE value END AS value, 'won' AS unit_name, 'ecos' AS source
FROM macro WHERE stat_code <> '5-LOW'"""))
def s11(spark, sf):
    return ingest.macro_json(payloads.macro_payloads(spark, sf))


_CANON_A = """event_a AS (SELECT symbol_code AS symbol, name, market, CAST(trade_price AS DOUBLE) AS price,
  CAST(trade_price AS DOUBLE) AS open, CAST(trade_price AS DOUBLE) AS high, CAST(trade_price AS DOUBLE) AS low,
  CAST(trade_price AS DOUBLE) AS "close", acc_trade_volume AS volume, change_rate AS change_pct,
  CAST(change_price AS DOUBLE) AS change_price, foreign_ratio, 'daum' AS source FROM snap)"""
_CANON_B = """event_b AS (SELECT code AS symbol, name, market, CAST(current_price AS DOUBLE) AS price,
  CAST(current_price AS DOUBLE) AS open, CAST(current_price AS DOUBLE) AS high, CAST(current_price AS DOUBLE) AS low,
  CAST(current_price AS DOUBLE) AS "close", volume, change_rate AS change_pct,
  CAST(0 AS DOUBLE) AS change_price, CAST(0 AS DOUBLE) AS foreign_ratio, 'naver' AS source FROM ranking)"""


@query("s12_canonical_snapshot_json", with_ctes(SYMBOLS, LISTING, _SNAP, _CANON_A, body="SELECT * FROM event_a"))
def s12(spark, sf):
    return canonical.from_snapshot_json(s6(spark, sf))


@query("s13_canonical_snapshot_html", with_ctes(SYMBOLS, LISTING, _RANK, _CANON_B, body="SELECT * FROM event_b"))
def s13(spark, sf):
    return canonical.from_snapshot_html(s7(spark, sf))


@query("u1_union_of_markets", with_ctes(SYMBOLS, LISTING, _SNAP, _RANK, _CANON_A, _CANON_B, body="""
SELECT * FROM event_a UNION ALL SELECT * FROM event_b"""))
def u1(spark, sf):
    return s12(spark, sf).unionByName(s13(spark, sf))


@query("u2_all_pages", with_ctes(SYMBOLS, LISTING, body="""
SELECT market, count(*) AS n FROM listing WHERE bal >= 0 GROUP BY market"""))
def u2(spark, sf):
    return s6(spark, sf).groupBy("market").agg(F.count("*").alias("n"))


_QUOTES = """quotes AS (SELECT symbol, "close" AS price, prev AS prev_close, open, high, low, volume FROM (
  SELECT *, lag("close") OVER (PARTITION BY symbol ORDER BY "date") AS prev,
         row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) AS age FROM bars) WHERE age = 1)"""


def quotes(spark, sf):
    """Quote documents of the newest day; one suffix of symbols lacks its open."""
    from ..functions.rolling import by_symbol

    rows = views.daily_bars(spark, sf).withColumn("prev", F.lag("close").over(by_symbol()))
    cells = F.struct("open", "high", "low", "close", "prev", "volume")
    last = rows.groupBy("symbol").agg(F.max_by(cells, "date").alias("l"))
    return last.select(
        "symbol", F.lit(None).cast("string").alias("shortName"), F.lit(None).cast("string").alias("exchange"),
        F.col("l.close").alias("regularMarketPrice"),
        F.when(~F.col("symbol").endswith("3"), F.col("l.open")).alias("regularMarketOpen"),
        F.col("l.high").alias("regularMarketDayHigh"), F.col("l.low").alias("regularMarketDayLow"),
        F.col("l.prev").alias("regularMarketPreviousClose"), F.col("l.volume").alias("regularMarketVolume"),
        F.lit(None).cast("double").alias("regularMarketChangePercent"), F.lit(None).cast("double").alias("regularMarketChange"))


_QUOTE_EVENT = """symbol, symbol AS name, 'NASDAQ' AS market, price,
  CASE WHEN symbol LIKE '%3' THEN 0 ELSE open END AS open, high, low, coalesce(prev_close, 0) AS "close", volume,
  CAST(0 AS DOUBLE) AS foreign_ratio, 'yfinance' AS source"""


@query("s14_canonical_quote", with_ctes(BARS, _QUOTES, body=f"""
SELECT {_QUOTE_EVENT}, CAST(0 AS DOUBLE) AS change_pct, CAST(0 AS DOUBLE) AS change_price FROM quotes"""))
def s14(spark, sf):
    return canonical.from_quote(quotes(spark, sf))


@query("s15_derived_change", with_ctes(BARS, _QUOTES, body=f"""
SELECT {_QUOTE_EVENT},
       CASE WHEN prev_close <> 0 AND price <> 0 THEN round((price - prev_close) / prev_close * 100, 4) + 0 ELSE 0 END AS change_pct,
       CASE WHEN prev_close <> 0 AND price <> 0 THEN round(price - prev_close, 4) + 0 ELSE 0 END AS change_price FROM quotes"""))
def s15(spark, sf):
    return canonical.with_derived_change(s14(spark, sf))


_FIELDS = """fields AS (SELECT symbol, CASE WHEN k % 23 = 4 THEN 'feed' WHEN k % 2 = 0 THEN 'daum' ELSE 'naver' END AS source,
  k % 17 = 3 AS broken, lpad(symbol, 6, '0') AS code, name, k, market FROM listing)"""


@query("s16_field_extraction", with_ctes(SYMBOLS, LISTING, _FIELDS, body="""
SELECT symbol, source, CASE WHEN NOT broken AND source <> 'feed' THEN code END AS stock_symbol,
       CASE WHEN NOT broken AND source <> 'feed' THEN name END AS stock_name,
       CASE WHEN NOT broken AND source <> 'feed' THEN CAST(k * 10 AS VARCHAR) END AS stock_price,
       CASE WHEN NOT broken AND source <> 'feed' THEN CAST(k * 7 AS VARCHAR) END AS stock_volume,
       CASE WHEN NOT broken AND source <> 'feed' THEN market END AS stock_market,
       CASE WHEN broken THEN 'malformed JSON' END AS processing_error FROM fields"""))
def s16(spark, sf):
    return canonical.extract_fields(payloads.field_messages(spark, sf)).select(
        "symbol", "source", "stock_symbol", "stock_name", "stock_price", "stock_volume", "stock_market", "processing_error")


@query("k13_topic_routing", with_ctes(SYMBOLS, LISTING, _FIELDS, body="""
SELECT 'stock.raw.prices' AS topic, count(*) FILTER (NOT broken AND source <> 'feed') AS success,
       count(*) FILTER (broken OR source = 'feed') AS failure, count(*) AS total FROM fields"""))
def k13(spark, sf):
    stamped = canonical.stamp(canonical.extract_fields(payloads.field_messages(spark, sf)))
    return canonical.delivery_tally(canonical.route(stamped))


@query("p15_constant_attributes", with_ctes(SYMBOLS, LISTING, body="""
SELECT symbol, '1.0' AS pipeline_version, 'nifi-etl' AS pipeline_stage, 'stock.raw.prices' AS destination_topic,
       true AS stamped FROM listing"""))
def p15(spark, sf):
    rows = canonical.stamp(payloads.field_messages(spark, sf))
    return rows.select("symbol", "pipeline_version", "pipeline_stage", "destination_topic",
                       F.col("processed_at").isNotNull().alias("stamped"))


@query("s3_json_decode", with_ctes("""raw AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""", body="""
SELECT event_id, k FROM raw"""))
def s3(spark, sf):
    from pyspark.sql import types as T

    raw = views.table(spark, sf, "events").select("event_id", F.col("props").alias("value"))
    return messages.decode(raw, T.StructType([T.StructField("k", T.LongType())]), "event_id")


_GOOD = "event_id % 50 NOT IN (7, 8, 9)"


@query("s4_consumer_scan", with_ctes(TICKS, body=f"""
SELECT symbol, price, volume, round(change_pct, 4) + 0 AS change_pct, CAST(event_id % 6 AS INTEGER) AS _kafka_partition,
       event_id // 6 AS _kafka_offset FROM ticks WHERE {_GOOD}"""))
def s4(spark, sf):
    good, _ = messages.split_good_bad(payloads.tick_messages(spark, sf), TICK)
    return good.select("symbol", "price", "volume", F.round("change_pct", 4).alias("change_pct"),
                       "_kafka_partition", "_kafka_offset")


@query("g12_dead_letters", with_ctes(TICKS, body="""
SELECT CASE event_id % 50 WHEN 7 THEN 'malformed' WHEN 8 THEN 'missing field' ELSE 'unknown field' END AS error,
       symbol AS key, count(*) AS n FROM ticks WHERE event_id % 50 IN (7, 8, 9) GROUP BY 1, 2"""))
def g12(spark, sf):
    _, bad = messages.split_good_bad(payloads.tick_messages(spark, sf), TICK)
    return bad.groupBy("error", "key").agg(F.count("*").alias("n"))


@query("f12_json_round_trip", with_ctes(TICKS, body="""
SELECT symbol, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume, round(sum(price), 2) AS price FROM ticks GROUP BY symbol"""))
def f12(spark, sf):
    ticks = views.ticks(spark, sf).select("symbol", "price", "volume")
    back = messages.decode(messages.encode(ticks, "symbol"), TICK)
    return back.groupBy("symbol").agg(
        F.count("*").alias("n"), F.sum("volume").alias("volume"), F.round(F.sum("price"), 2).alias("price"))


@query("s17_clean_panel", with_ctes(BARS, body="""
SELECT symbol, "date", open, high, low, "close", volume FROM bars"""))
def s17(spark, sf):
    return panel.clean_bars(views.daily_bars(spark, sf))


@query("s18_missing_symbols", with_ctes(BARS, body="""
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS symbol, 'no data' AS error FROM customer
WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT symbol FROM bars)"""))
def s18(spark, sf):
    requested = views.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    return panel.missing_symbols(requested, views.daily_bars(spark, sf))


@query("p7_six_digit_tickers", with_ctes("""codes AS (
  SELECT CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS ticker FROM customer)""", body="""
SELECT ticker FROM codes WHERE regexp_full_match(ticker, '[0-9]{6}')"""))
def p7(spark, sf):
    key = F.col("c_custkey").cast("string")
    codes = views.table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 5 == 0, key).otherwise(F.lpad(key, 6, "0")).alias("ticker"))
    return ingest.six_digit(codes)


@query("y4_rows_from_pages", with_ctes(BARS, SYMBOLS, LISTING, _PRICES, _SNAP, _RANK, body="""
SELECT 'json listing' AS feed, count(*) AS n FROM snap UNION ALL SELECT 'html listing', count(*) FROM ranking
UNION ALL SELECT 'html prices', count(*) FROM prices"""))
def y4(spark, sf):
    """Row-to-many parsing stays in the JVM for every feed."""
    feeds = {"json listing": s6(spark, sf), "html listing": s7(spark, sf), "html prices": s8(spark, sf)}
    parts = [df.agg(F.count("*").alias("n")).withColumn("feed", F.lit(name)) for name, df in feeds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
