"""Queries over document collections, their changes and file exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rolling import by_symbol
from ..operators import documents as doc
from ..runtime import shared_dir
from ..schemas import ML20
from ..sources import views, writers
from .bar_queries import training_set
from .bar_sql import ML_SQL
from .bar_queries import TRAINING
from .ingest_queries import LISTING, _SNAP, s6
from .registry import BARS, MACRO, SYMBOLS, query, with_ctes

CRAWLS = """crawls AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS ticker,
  o_orderpriority AS market, CAST(o_orderkey % 120 + 1 AS INTEGER) AS pages,
  CAST(floor(o_totalprice) AS BIGINT) AS ohlcv_rows, o_orderdate AS created_at, o_orderdate AS updated_at FROM orders)"""
USERS = """users AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS username, md5(c_name) AS password_hash,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL WHEN 'MACHINERY' THEN false ELSE true END AS active FROM customer)"""
CHANGES = """changes AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN o_orderstatus = 'F' THEN 'KOSDAQ' END AS market, CASE WHEN o_orderstatus <> 'P' THEN 7 END AS pages
  FROM orders WHERE o_orderpriority = '1-URGENT')"""


def crawls(spark, sf):
    return views.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("ticker"),
        F.col("o_orderpriority").alias("market"), (F.col("o_orderkey") % 120 + 1).cast("int").alias("pages"),
        F.floor("o_totalprice").alias("ohlcv_rows"), F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"))


def users(spark, sf):
    segment = F.col("c_mktsegment")
    return views.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("username"), F.md5("c_name").alias("password_hash"),
        F.when(segment == "HOUSEHOLD", None).when(segment == "MACHINERY", False).otherwise(True).alias("active"))


def changes(spark, sf):
    status = F.col("o_orderstatus")
    return views.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").cast("string").alias("id"), F.when(status == "F", "KOSDAQ").alias("market"),
        F.when(status != "P", 7).alias("pages"))


def analyses(spark, sf):
    """Analyses over one ticker (even parts) or three (odd parts)."""
    key = F.col("p_partkey")
    name = lambda x: x.cast("string")
    return views.table(spark, sf, "part").select(
        name(key).alias("id"), F.col("p_type").alias("analysis_type"),
        F.when(key % 2 == 0, name(key % 50)).alias("ticker"),
        F.when(key % 2 == 1, F.array(name(key % 50), name(key % 7), name(key % 11))).alias("tickers"))


_NOW = "TIMESTAMP '2030-01-01 00:00:00'"


def _now():
    return F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")


@query("k8_document_insert", with_ctes(CRAWLS, body=f"""
SELECT id, ticker, pages, created_at, updated_at FROM crawls UNION ALL
SELECT 'n' || CAST(p_partkey AS VARCHAR), p_name, p_size, {_NOW}, {_NOW} FROM part"""))
def k8(spark, sf):
    new = views.table(spark, sf, "part").select(
        F.concat(F.lit("n"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("ticker"),
        F.col("p_size").alias("pages"))
    return doc.insert(crawls(spark, sf), new, _now()).select("id", "ticker", "pages", "created_at", "updated_at")


@query("k9_document_update", with_ctes(CRAWLS, CHANGES, body=f"""
SELECT c.id, c.ticker, coalesce(u.market, c.market) AS market, coalesce(u.pages, c.pages) AS pages, c.ohlcv_rows,
       c.created_at, CASE WHEN u.id IS NOT NULL THEN {_NOW} ELSE c.updated_at END AS updated_at
FROM crawls c LEFT JOIN changes u ON c.id = u.id"""))
def k9(spark, sf):
    return doc.update(crawls(spark, sf), changes(spark, sf), _now())


@query("k10_document_delete", with_ctes(CRAWLS, CHANGES, body="""
SELECT id, ticker FROM crawls WHERE id NOT IN (SELECT id FROM changes)"""))
def k10(spark, sf):
    return doc.delete(crawls(spark, sf), changes(spark, sf)).select("id", "ticker")


@query("j6_target_match", with_ctes(CRAWLS, CHANGES, body="""
SELECT id, ticker FROM crawls WHERE id IN (SELECT id FROM changes)"""))
def j6(spark, sf):
    return doc.matched(crawls(spark, sf), changes(spark, sf)).select("id", "ticker")


@query("j5_uniqueness_check", with_ctes(USERS, """candidates AS (
  SELECT DISTINCT 'Customer#' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS username FROM orders)""", body="""
SELECT username, username IN (SELECT username FROM users) AS taken FROM candidates"""))
def j5(spark, sf):
    key = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    candidates = views.table(spark, sf, "orders").select(F.concat(F.lit("Customer#"), key).alias("username"))
    free, taken = doc.new_and_conflicting(candidates, users(spark, sf), "username")
    return free.withColumn("taken", F.lit(False)).unionByName(taken.withColumn("taken", F.lit(True)))


@query("j7_crawl_analysis_relation", with_ctes(CRAWLS, """named AS (SELECT DISTINCT id AS analysis_id, ticker FROM (
  SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_partkey % 50 AS VARCHAR) AS ticker FROM part UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CAST(p_partkey % 7 AS VARCHAR) FROM part WHERE p_partkey % 2 = 1 UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CAST(p_partkey % 11 AS VARCHAR) FROM part WHERE p_partkey % 2 = 1))""", body="""
SELECT c.id AS crawl_id, c.ticker, analysis_id FROM crawls c JOIN named a ON c.ticker = a.ticker"""))
def j7(spark, sf):
    return doc.analyses_of_crawls(crawls(spark, sf), analyses(spark, sf)).select("crawl_id", "ticker", "analysis_id")


@query("p11_public_users", with_ctes(USERS, body="SELECT id, username, active FROM users"))
def p11(spark, sf):
    return doc.public(users(spark, sf))


@query("p12_active_users", with_ctes(USERS, body="SELECT id, username FROM users WHERE coalesce(active, true)"))
def p12(spark, sf):
    return doc.active(users(spark, sf)).select("id", "username")


@query("p13_stock_search", with_ctes(SYMBOLS, body="""
SELECT symbol AS ticker, name, market FROM symbols WHERE contains(lower(symbol), '1') OR contains(lower(name), '1')
ORDER BY symbol LIMIT 15"""))
def p13(spark, sf):
    return doc.search(views.symbols(spark, sf).withColumnRenamed("symbol", "ticker"), " 1 ")


@query("p16_set_fields", with_ctes(CHANGES, body="""
SELECT id, CASE WHEN market IS NULL THEN 0 ELSE 1 END + CASE WHEN pages IS NULL THEN 0 ELSE 1 END AS fields,
       market, CAST(pages AS VARCHAR) AS pages FROM changes"""))
def p16(spark, sf):
    document = F.create_map(F.lit("market"), F.col("market"), F.lit("pages"), F.col("pages").cast("string"))
    kept = changes(spark, sf).select("id", doc.set_fields(document).alias("m"))
    return kept.select("id", F.size("m").alias("fields"), F.col("m")["market"].alias("market"), F.col("m")["pages"].alias("pages"))


@query("p17_lookup_by_id", with_ctes(CRAWLS, body="SELECT id, ticker, pages FROM crawls WHERE id = '42'"))
def p17(spark, sf):
    return doc.find(crawls(spark, sf), "42").select("id", "ticker", "pages")


@query("p18_without_display_fields", """
SELECT p_partkey, p_type AS analysis_type FROM part""")
def p18(spark, sf):
    rows = views.table(spark, sf, "part").select(
        "p_partkey", F.col("p_type").alias("analysis_type"), F.col("p_name").alias("summary"), F.col("p_brand").alias("notes"),
        F.col("p_size").alias("charts"))
    return doc.without_display(rows)


@query("t4_newest_documents", with_ctes(CRAWLS, body="""
SELECT id, ticker, created_at FROM crawls ORDER BY created_at DESC, id LIMIT 50"""))
def t4(spark, sf):
    return doc.newest(crawls(spark, sf), 50).select("id", "ticker", "created_at")


@query("t5_head_sample", with_ctes(SYMBOLS, body="SELECT symbol, name, market FROM symbols ORDER BY name LIMIT 10"))
def t5(spark, sf):
    return views.symbols(spark, sf).orderBy("name").limit(10)


@query("f23_document_serialisation", with_ctes(CRAWLS, body="""
SELECT id, ticker, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS created_at FROM crawls"""))
def f23(spark, sf):
    rows = crawls(spark, sf).select(F.col("id").alias("_id"), "ticker", "created_at")
    out = doc.serialize(rows)
    return out.select("id", F.get_json_object("body", "$.ticker").alias("ticker"), F.get_json_object("body", "$.created_at").alias("created_at"))


@query("k3_partitioned_bronze", with_ctes(MACRO, body="""
SELECT stat_code, cycle, "time", value, true AS ingested FROM macro"""))
def k3(spark, sf):
    path = shared_dir(spark, "bronze")
    writers.append_partitioned(views.macro(spark, sf), path, ["stat_code"])
    back = spark.read.parquet(path)
    return back.select("stat_code", "cycle", "time", "value", F.col("ingested_at").isNotNull().alias("ingested"))


@query("s20_bronze_read_back", with_ctes(MACRO, body="""
SELECT cycle, "time", value FROM macro WHERE stat_code = '2-HIGH'"""))
def s20(spark, sf):
    path = shared_dir(spark, "bronze")
    writers.append_partitioned(views.macro(spark, sf), path, ["stat_code"])
    return spark.read.parquet(path).filter("stat_code = '2-HIGH'").select("cycle", "time", "value")


@query("k5_json_export", with_ctes(SYMBOLS, LISTING, _SNAP, body="""
SELECT symbol_code, name, trade_price, t.total_count FROM snap, (SELECT count(*) AS total_count FROM snap) t"""))
def k5(spark, sf):
    path = shared_dir(spark, "export-json")
    rows = s6(spark, sf)
    writers.export_json(rows, path, "daum")
    total = spark.read.schema("source string, total_count bigint").json(f"{path}/envelope")
    stocks = spark.read.schema("symbol_code string, name string, trade_price bigint").json(f"{path}/stocks")
    return stocks.withColumn("total_count", total.select("total_count").scalar())


@query("k6_xml_export", with_ctes(SYMBOLS, LISTING, _SNAP, body="""
SELECT symbol_code AS code, name AS "Name", trade_price AS "TradePrice", change AS "Change" FROM snap"""))
def k6(spark, sf):
    path = shared_dir(spark, "export-xml")
    rows = s6(spark, sf).select(
        F.col("symbol_code").alias("_code"), F.col("name").alias("Name"), F.col("market").alias("Market"),
        F.col("trade_price").alias("TradePrice"), F.col("change").alias("Change"))
    writers.export_xml(rows, path)
    schema = "_code string, Name string, Market string, TradePrice bigint, Change string"
    back = spark.read.format("xml").option("rowTag", "Stock").schema(schema).load(path)
    return back.select(F.col("_code").alias("code"), "Name", "TradePrice", "Change")


_EXPORTED = f"""exported AS (SELECT symbol, "date", {', '.join(f'{s} AS "{n}"' for n, s in ML_SQL.items())},
  CASE WHEN ahead > 0.01 THEN 'BUY' WHEN ahead < -0.01 THEN 'SELL' ELSE 'HOLD' END AS "Signal",
  CASE WHEN rn <= floor(CAST(n_rows AS DOUBLE) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM training)"""


def _exported(spark, sf):
    path = shared_dir(spark, "training-csv")
    rows = training_set(spark, sf)
    writers.export_training_csv(rows, path)
    kinds = {"symbol": "string", "date": "date", "Signal": "string"}
    names = [c for c in rows.columns if c != "split"]
    return writers.read_training_csv(spark, path, ", ".join(f"{c} {kinds.get(c, 'double')}" for c in names) + ", split string")


@query("k7_training_csv_export", with_ctes(*TRAINING, _EXPORTED, body="""
SELECT split, "Signal", count(*) AS n, round(avg("RSI14"), 6) AS mean_rsi, round(avg("MA5_Ratio"), 6) AS mean_ma5
FROM exported GROUP BY 1, 2"""))
def k7(spark, sf):
    return _exported(spark, sf).groupBy("split", "Signal").agg(
        F.count("*").alias("n"), F.round(F.avg("RSI14"), 6).alias("mean_rsi"), F.round(F.avg("MA5_Ratio"), 6).alias("mean_ma5"))


@query("s19_training_csv_read_back", with_ctes(*TRAINING, _EXPORTED, body="""
SELECT symbol, "date", "Signal", round("Returns", 8) + 0 AS "Returns" FROM exported WHERE split = 'test'"""))
def s19(spark, sf):
    return _exported(spark, sf).filter("split = 'test'").select(
        "symbol", "date", "Signal", F.round("Returns", 8).alias("Returns"))


@query("u3_append_without_duplicates", with_ctes(BARS, body="""
SELECT symbol, "date", "close" FROM bars"""))
def u3(spark, sf):
    """Accumulated set plus a re-run that overlaps it: one row per symbol and day."""
    bars = views.daily_bars(spark, sf).select("symbol", "date", "close")
    return bars.unionByName(bars.filter("date >= '1998-01-01'")).dropDuplicates(["symbol", "date"])


@query("u4_row_maximum", with_ctes(BARS, body="""
SELECT symbol, "date", greatest(high - low, abs(high - prev), abs(low - prev)) AS widest
FROM (SELECT *, lag("close") OVER (PARTITION BY symbol ORDER BY "date") AS prev FROM bars)"""))
def u4(spark, sf):
    """True range: the widest of the day's span and its distances from the previous close; a symbol's first day has its span alone."""
    prev = F.lag("close").over(by_symbol())
    return views.daily_bars(spark, sf).select("symbol", "date", F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev)).alias("widest"))


@query("k3_bars_by_market", with_ctes(BARS, SYMBOLS, body="""
SELECT s.market, b.symbol, "date", open, high, low, "close", volume FROM bars b JOIN symbols s ON b.symbol = s.symbol"""))
def k3_bars(spark, sf):
    """Bars landed in a table by market, and read back."""
    path = shared_dir(spark, "bars-by-market")
    listed = views.symbols(spark, sf).select("symbol", "market")
    writers.append_partitioned(views.daily_bars(spark, sf).join(listed, "symbol"), path, ["market"])
    return spark.read.parquet(path).select("market", "symbol", "date", "open", "high", "low", "close", "volume")
