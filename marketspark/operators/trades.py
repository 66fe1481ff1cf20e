"""Signals, trade log, portfolio snapshots and risk flags.

Only the interface of these is public; the rules below are this library's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rolling import by_symbol, full
from .indicators import rsi, with_ewm


def cross_signals(bars: DataFrame, fast: int = 5, slow: int = 20) -> DataFrame:
    """BUY where the fast average rises above the slow one, SELL where it falls
    below, HOLD otherwise; rows without both averages are left out."""
    close = F.col("close")
    rows = bars.select("symbol", "date", "close", full(F.avg, close, fast).alias("ma_fast"), full(F.avg, close, slow).alias("ma_slow"))
    above = F.col("ma_fast") > F.col("ma_slow")
    rows = rows.withColumn("above", above).withColumn("was_above", F.lag("above").over(by_symbol()))
    signal = (
        F.when(F.col("above") & (F.col("was_above") == F.lit(False)), "BUY")
        .when(~F.col("above") & F.col("was_above"), "SELL")
        .otherwise("HOLD")
    )
    return rows.filter("ma_slow is not null").select("symbol", "date", "close", "ma_fast", "ma_slow", signal.alias("signal"))


def rsi_signals(bars: DataFrame, oversold: float = 30, overbought: float = 70) -> DataFrame:
    rows = with_ewm(bars.select("symbol", "date", "close")).withColumn("rsi", rsi()).filter("rsi is not null and not isnan(rsi)")
    signal = F.when(F.col("rsi") < oversold, "BUY").when(F.col("rsi") > overbought, "SELL").otherwise("HOLD")
    return rows.select("symbol", "date", "rsi", signal.alias("signal"))


def trade_rows(requests: DataFrame) -> DataFrame:
    return requests.withColumns({"side": F.upper("side"), "amount": F.round(F.col("qty") * F.col("price"), 4)})


def select_trades(trades: DataFrame, since: str | None = None, symbol: str | None = None, broker: str | None = None) -> DataFrame:
    if since is not None:
        trades = trades.filter(F.col("date") >= F.to_date(F.lit(since)))
    if symbol is not None:
        trades = trades.filter(F.col("symbol") == symbol)
    if broker is not None:
        trades = trades.filter(F.col("broker") == broker)
    return trades


def daily_trade_stats(trades: DataFrame) -> DataFrame:
    return trades.groupBy("date", "side").agg(
        F.count("*").alias("trades"), F.sum("qty").alias("qty"), F.sum("amount").alias("amount"))


def portfolio_snapshots(trades: DataFrame) -> DataFrame:
    """One snapshot per broker and day: cumulative net buying as value, change
    to the previous day, drawdown from the running peak, trade count."""
    signed = F.when(F.col("side") == "BUY", F.col("amount")).otherwise(-F.col("amount"))
    days = trades.groupBy("broker", F.col("date").alias("snapshot_date")).agg(
        F.sum(signed).alias("flow"), F.count("*").alias("trade_count"))
    w = Window.partitionBy("broker").orderBy("snapshot_date")
    total = F.sum("flow").over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = days.withColumn("portfolio_value", total).withColumn("prev", F.lag("portfolio_value").over(w))
    rows = rows.withColumn("peak", F.max("portfolio_value").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pnl = F.col("portfolio_value") - F.col("prev")
    return rows.select(
        "broker", "snapshot_date", "portfolio_value", F.coalesce(pnl, F.lit(0.0)).alias("daily_pnl"),
        F.coalesce(F.try_divide(pnl, F.col("prev")), F.lit(0.0)).alias("daily_pnl_pct"),
        F.coalesce(F.try_divide(F.col("portfolio_value") - F.col("peak"), F.col("peak")), F.lit(0.0)).alias("mdd"),
        "trade_count",
    )


def newest_snapshots(snapshots: DataFrame, days: int) -> DataFrame:
    newest = Window.partitionBy("broker").orderBy(F.desc("snapshot_date"))
    return snapshots.withColumn("r", F.row_number().over(newest)).filter(F.col("r") <= days).drop("r")


# Default limits.
MAX_DAILY_LOSS, MAX_DRAWDOWN, MAX_POSITION, MAX_TRADES = 0.02, 0.10, 0.20, 50


def position_flags(positions: DataFrame) -> DataFrame:
    """Which positions (owner, value) take more than the limit of their owner's total."""
    total = F.sum("value").over(Window.partitionBy("owner"))
    share = F.try_divide(F.col("value"), total)
    return positions.withColumn("weight", share).withColumn("position_breach", F.coalesce(share > MAX_POSITION, F.lit(False)))


def risk_flags(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumns({
        "loss_breach": F.col("daily_pnl_pct") <= -MAX_DAILY_LOSS,
        "drawdown_breach": F.col("mdd") <= -MAX_DRAWDOWN,
        "trade_breach": F.col("trade_count") > MAX_TRADES,
    })


def position_size(prices: DataFrame, value: Column, target: Column) -> DataFrame:
    """Whole shares for a target weight, never above the position limit."""
    weight = F.least(target, F.lit(MAX_POSITION))
    return prices.withColumn("shares", F.floor(F.try_divide(value * weight, F.col("close"))).cast("bigint"))


def watchlist_scan(bars: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Newest signal of the listed symbols with the numbers behind it."""
    listed = bars.join(watchlist.select("symbol"), "symbol", "left_semi")
    cells = F.struct("date", "close", "ma_fast", "ma_slow", "signal")
    newest = cross_signals(listed).groupBy("symbol").agg(F.max_by(cells, "date").alias("l")).select("symbol", "l.*")
    reason = F.when(F.col("signal") == "BUY", "fast average crossed above slow").when(
        F.col("signal") == "SELL", "fast average crossed below slow").otherwise("no cross")
    return newest.withColumn("reason", reason)


def resample(bars: DataFrame, timeframe: str, last_days: int | None = None) -> DataFrame:
    """Coarser bars over a time frame, optionally of the newest days only."""
    if last_days is not None:
        newest = bars.agg(F.max("date")).scalar()
        bars = bars.filter(F.col("date") >= F.date_sub(newest, last_days))
    grouped = bars.groupBy("symbol", F.window(F.col("date").cast("timestamp"), timeframe)["start"].alias("start"))
    return grouped.agg(
        F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "date").alias("close"), F.sum("volume").alias("volume"))
