"""Queries over signals, trades, snapshots and risk; semantics are our own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trades as tr
from ..runtime import shared_dir
from ..sources import views, writers
from .bar_sql import EWM1, LAYER1, W
from .registry import BARS, SYMBOLS, TRADES, query, with_ctes

_CROSS = f"""flags AS (SELECT symbol, "date", "close", ma5, ma20, ma5 > ma20 AS above, lag(ma5 > ma20) OVER ({W}) AS was FROM l1),
crosses AS (SELECT *, CASE WHEN above AND NOT was THEN 'BUY' WHEN NOT above AND was THEN 'SELL' ELSE 'HOLD' END AS signal
  FROM flags WHERE ma20 IS NOT NULL)"""
_AMOUNT = "amounts AS (SELECT *, round(qty * price, 4) AS amount FROM trades)"
_SNAPS = """days AS (SELECT broker, "date" AS snapshot_date, sum(CASE WHEN side = 'BUY' THEN amount ELSE -amount END) AS flow,
    count(*) AS trade_count FROM amounts GROUP BY 1, 2),
totals AS (SELECT *, sum(flow) OVER (PARTITION BY broker ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS value FROM days),
snaps AS (SELECT *, lag(value) OVER (PARTITION BY broker ORDER BY snapshot_date) AS prev,
    max(value) OVER (PARTITION BY broker ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS peak FROM totals)"""


def trades(spark, sf):
    return tr.trade_rows(views.trades(spark, sf))


def snapshots(spark, sf):
    return tr.portfolio_snapshots(trades(spark, sf))


@query("c1_cross_signals", with_ctes(BARS, LAYER1, _CROSS, body="""
SELECT symbol, "date", round(ma5, 4) AS ma_fast, round(ma20, 4) AS ma_slow, signal FROM crosses"""))
def c1(spark, sf):
    rows = tr.cross_signals(views.daily_bars(spark, sf))
    return rows.select("symbol", "date", F.round("ma_fast", 4).alias("ma_fast"), F.round("ma_slow", 4).alias("ma_slow"), "signal")


@query("c2_rsi_signals", with_ctes(BARS, LAYER1, EWM1, body="""
SELECT l1.symbol, l1."date", round(rsi, 7) AS rsi, CASE WHEN rsi < 30 THEN 'BUY' WHEN rsi > 70 THEN 'SELL' ELSE 'HOLD' END AS signal
FROM l1 JOIN ewm2 e ON l1.symbol = e.symbol AND l1.pos = e.pos WHERE rsi IS NOT NULL"""))
def c2(spark, sf):
    return tr.rsi_signals(views.daily_bars(spark, sf)).withColumn("rsi", F.round("rsi", 7))


@query("c3_trade_rows", with_ctes(TRADES, _AMOUNT, body="""
SELECT symbol, "date", count(*) AS n, round(sum(amount), 2) AS amount FROM amounts GROUP BY 1, 2"""))
def c3(spark, sf):
    return trades(spark, sf).groupBy("symbol", "date").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query("c4_select_trades", with_ctes(TRADES, body="""
SELECT symbol, "date", side, qty, price FROM trades WHERE "date" >= DATE '1999-06-01' AND broker = 'O' AND symbol = '5'"""))
def c4(spark, sf):
    return tr.select_trades(views.trades(spark, sf), "1999-06-01", "5", "O").select("symbol", "date", "side", "qty", "price")


@query("c5_daily_trade_stats", with_ctes(TRADES, _AMOUNT, body="""
SELECT "date", side, count(*) AS trades, sum(qty) AS qty, round(sum(amount), 2) AS amount FROM amounts GROUP BY 1, 2"""))
def c5(spark, sf):
    return tr.daily_trade_stats(trades(spark, sf)).withColumn("amount", F.round("amount", 2))


@query("c6_portfolio_snapshots", with_ctes(TRADES, _AMOUNT, _SNAPS, body="""
SELECT broker, snapshot_date, round(value, 2) AS portfolio_value, round(coalesce(value - prev, 0), 2) + 0 AS daily_pnl,
       round(coalesce((value - peak) / peak, 0), 6) + 0 AS mdd, trade_count FROM snaps
QUALIFY row_number() OVER (PARTITION BY broker ORDER BY snapshot_date DESC) <= 365"""))
def c6(spark, sf):
    rows = tr.newest_snapshots(snapshots(spark, sf), 365)
    return rows.select("broker", "snapshot_date", F.round("portfolio_value", 2).alias("portfolio_value"),
                       F.round("daily_pnl", 2).alias("daily_pnl"), F.round("mdd", 6).alias("mdd"), "trade_count")


@query("c7_trade_csv_export", with_ctes(TRADES, _AMOUNT, body="""
SELECT broker, side, count(*) AS n, round(sum(amount), 0) AS amount FROM amounts GROUP BY 1, 2"""))
def c7(spark, sf):
    path = shared_dir(spark, "trades-csv")
    rows = trades(spark, sf)
    rows.write.option("header", True).csv(path)
    back = spark.read.schema(rows.schema).option("header", True).csv(path)
    return back.groupBy("broker", "side").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 0).alias("amount"))


@query("c8_risk_flags", with_ctes(TRADES, _AMOUNT, _SNAPS, body="""
SELECT broker, snapshot_date, coalesce((value - prev) / prev, 0) <= -0.02 AS loss_breach,
       coalesce((value - peak) / peak, 0) <= -0.10 AS drawdown_breach, trade_count > 50 AS trade_breach FROM snaps"""))
def c8(spark, sf):
    return tr.risk_flags(snapshots(spark, sf)).select(
        "broker", "snapshot_date", "loss_breach", "drawdown_breach", "trade_breach")


@query("c8_position_flags", with_ctes(TRADES, _AMOUNT, """held AS (SELECT broker AS owner, symbol, sum(amount) AS value FROM amounts GROUP BY 1, 2),
weights AS (SELECT *, value / nullif(sum(value) OVER (PARTITION BY owner), 0) AS weight FROM held)""", body="""
SELECT owner, symbol, round(weight, 8) AS weight, coalesce(weight > 0.20, false) AS position_breach FROM weights"""))
def c8_positions(spark, sf):
    held = trades(spark, sf).groupBy(F.col("broker").alias("owner"), "symbol").agg(F.sum("amount").alias("value"))
    return tr.position_flags(held).select("owner", "symbol", F.round("weight", 8).alias("weight"), "position_breach")


@query("c9_watchlist_scan", with_ctes(BARS, SYMBOLS, LAYER1, _CROSS, body="""
SELECT symbol, "date", "close", round(ma5, 4) AS ma_fast, round(ma20, 4) AS ma_slow, signal, CASE signal WHEN 'BUY' THEN 'fast average crossed above slow'
       WHEN 'SELL' THEN 'fast average crossed below slow' ELSE 'no cross' END AS reason
FROM crosses WHERE symbol IN (SELECT symbol FROM symbols WHERE market = 'ASIA')
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) = 1"""))
def c9(spark, sf):
    watchlist = views.symbols(spark, sf).filter("market = 'ASIA'")
    return tr.watchlist_scan(views.daily_bars(spark, sf), watchlist).select(
        "symbol", "date", "close", F.round("ma_fast", 4).alias("ma_fast"), F.round("ma_slow", 4).alias("ma_slow"), "signal", "reason")


@query("c10_resampled_bars", with_ctes(BARS, """recent AS (SELECT * FROM bars WHERE "date" >= (SELECT max("date") FROM bars) - 365)""", body="""
SELECT symbol, CAST(time_bucket(INTERVAL '7 days', "date", DATE '1970-01-01') AS DATE) AS start,
       arg_min(open, "date") AS open, max(high) AS high, min(low) AS low, arg_max("close", "date") AS "close",
       CAST(sum(volume) AS BIGINT) AS volume FROM recent GROUP BY 1, 2"""))
def c10(spark, sf):
    rows = tr.resample(views.daily_bars(spark, sf), "7 days", 365)
    return rows.withColumn("start", F.col("start").cast("date"))


@query("c11_system_events", """
SELECT event_type AS type, count(*) AS n FROM events GROUP BY 1""")
def c11(spark, sf):
    path = shared_dir(spark, "system-events")
    events = views.table(spark, sf, "events")
    writers.log_events(events, path, type=F.col("event_type"), message=F.lit("logged"), detail=F.col("props"))
    return spark.read.parquet(path).groupBy("type").agg(F.count("*").alias("n"))


@query("c12_position_size", with_ctes(BARS, body="""
SELECT symbol, "date", CAST(floor(CAST(1000000 AS DOUBLE) * least((volume % 40) / CAST(100 AS DOUBLE), CAST(0.20 AS DOUBLE)) / "close") AS BIGINT) AS shares FROM bars"""))
def c12(spark, sf):
    bars = views.daily_bars(spark, sf)
    return tr.position_size(bars, F.lit(1000000.0), F.col("volume") % 40 / 100.0).select("symbol", "date", "shares")
