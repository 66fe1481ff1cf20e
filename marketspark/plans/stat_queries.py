"""Queries over per-symbol statistics, correlations, forecasts and backtests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rolling import change
from ..operators import backtest as bt
from ..operators import correlation as cor
from ..operators import indicators as ind
from ..operators import stats as st
from ..runtime import materialize
from ..sources import views
from .bar_sql import DASH_ROWS, EWM1, LAYER1, NATIVE, W, change as sql_change
from .registry import BARS, SYMBOLS, query, with_ctes

_DASH = (*NATIVE, DASH_ROWS)


def dash(spark, sf):
    return ind.feature_frame(views.daily_bars(spark, sf), "dash")


_PROFILE = (BARS, LAYER1, EWM1, f"""rsi AS (SELECT symbol, avg(rsi) AS rsi_mean FROM ewm2 GROUP BY symbol),
grow AS (SELECT symbol, "date", "close", volume, ret, pos,
    CASE WHEN ret IS NOT NULL THEN "close" / first_value("close") OVER ({W}) END AS growth FROM l1),
dd AS (SELECT *, max(growth) OVER ({W} ROWS UNBOUNDED PRECEDING) AS peak,
    row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) AS age,
    count(*) OVER (PARTITION BY symbol) AS n_bars, lag("close", 20) OVER ({W}) AS close20 FROM grow),
profile AS (SELECT d.symbol, any_value(n_bars) AS n_bars, avg(ret) * 252 AS ann_return,
    stddev_samp(ret) * sqrt(252) AS ann_vol, min((growth - peak) / (peak + 1e-9)) AS max_dd,
    any_value(r.rsi_mean) AS rsi_mean,
    CASE WHEN any_value(n_bars) > 20 THEN max(CASE WHEN age = 1 THEN "close" / close20 - 1 END) ELSE 0 END AS momentum_20,
    CASE WHEN any_value(n_bars) > 20 AND sum(volume) > 0
      THEN avg(CASE WHEN age <= 5 THEN volume END) / (avg(CASE WHEN age <= 20 THEN volume END) + 1e-9) ELSE 1 END AS vol_ratio,
    skewness(ret) AS skewness
  FROM dd d JOIN rsi r ON d.symbol = r.symbol GROUP BY d.symbol HAVING any_value(n_bars) >= 20),
profile8 AS (SELECT symbol, round(ann_return, 4) + 0 AS ann_return, round(ann_vol, 4) + 0 AS ann_vol,
    round(ann_return / (ann_vol + 1e-9), 4) + 0 AS sharpe, round(max_dd, 4) + 0 AS max_dd,
    round(rsi_mean, 4) + 0 AS rsi_mean, round(momentum_20, 4) + 0 AS momentum_20,
    round(vol_ratio, 4) + 0 AS vol_ratio, round(skewness, 4) + 0 AS skewness FROM profile)""")


def profile(spark, sf):
    return st.history_profile(views.daily_bars(spark, sf))


def _profile_query(name, *columns):
    @query(name, with_ctes(*_PROFILE, body=f"SELECT symbol, {', '.join(columns)} FROM profile8"))
    def run(spark, sf):
        return profile(spark, sf).select("symbol", *columns)


_profile_query("a5_annual_return", "ann_return")
_profile_query("a6_annual_volatility", "ann_vol")
_profile_query("a7_sharpe", "sharpe")
_profile_query("a8_max_drawdown", "max_dd")
_profile_query("a9_mean_rsi", "rsi_mean")
_profile_query("a10_momentum_20", "momentum_20")
_profile_query("a11_recent_volume_ratio", "vol_ratio")
_profile_query("a12_return_skewness", "skewness")
_profile_query("a29_history_profile", "ann_return", "ann_vol", "sharpe", "max_dd", "rsi_mean", "momentum_20",
               "vol_ratio", "skewness")


@query("a14_weekday_effect", with_ctes(*_DASH, body="""
SELECT s.symbol, CAST(d.i AS INTEGER) AS weekday, round(coalesce(avg(ret), 0), 8) + 0 AS mean_ret
FROM (SELECT DISTINCT symbol FROM dash) s JOIN range(5) d(i) ON true
LEFT JOIN dash ON dash.symbol = s.symbol AND isodow("date") - 1 = d.i GROUP BY 1, 2"""))
def a14(spark, sf):
    return st.weekday_effect(dash(spark, sf)).withColumn("mean_ret", F.round("mean_ret", 8))


@query("a15_month_effect", with_ctes(*_DASH, body="""
SELECT s.symbol, CAST(d.i AS INTEGER) AS "month", round(coalesce(avg(ret), 0), 8) + 0 AS mean_ret
FROM (SELECT DISTINCT symbol FROM dash) s JOIN range(1, 13) d(i) ON true
LEFT JOIN dash ON dash.symbol = s.symbol AND month("date") = d.i GROUP BY 1, 2"""))
def a15(spark, sf):
    return st.month_effect(dash(spark, sf)).withColumn("mean_ret", F.round("mean_ret", 8))


@query("a16_monthly_average_close", with_ctes(*_DASH, body="""
SELECT symbol, y AS "year", m AS "month", avg_close FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY y DESC, m DESC) AS r FROM (
    SELECT symbol, CAST(year("date") AS INTEGER) AS y, CAST(month("date") AS INTEGER) AS m,
           round(avg("close"), 6) AS avg_close FROM dash GROUP BY 1, 2, 3)) WHERE r <= 24"""))
def a16(spark, sf):
    return st.monthly_close(dash(spark, sf)).withColumn("avg_close", F.round("avg_close", 6))


@query("a17_return_summary", with_ctes(*_DASH, body="""
SELECT symbol, count(ret) AS n, round(avg(ret), 8) + 0 AS mean_ret,
       round(stddev_samp(ret) * sqrt(252), 8) AS ann_vol,
       round(avg(CAST(ret > 0 AS INTEGER)), 8) AS up_ratio FROM dash GROUP BY symbol"""))
def a17(spark, sf):
    rows = st.return_summary(dash(spark, sf))
    return rows.withColumns({c: F.round(c, 8) for c in ("mean_ret", "ann_vol", "up_ratio")})


@query("a18_autocorrelation", with_ctes(*_DASH, f"""lagged AS (
  SELECT symbol, ret, k, lag(ret, CAST(k AS INTEGER)) OVER (PARTITION BY symbol, k ORDER BY "date") AS past
  FROM dash, range(1, 11) r(k))""", body="""
SELECT symbol, CAST(k AS INTEGER) AS lag, round(corr(ret, past), 8) + 0 AS acf,
       round(2 / sqrt(count(ret)), 8) AS band FROM lagged GROUP BY 1, 2"""))
def a18(spark, sf):
    rows = st.autocorrelation(dash(spark, sf))
    return rows.withColumns({"acf": F.round("acf", 8), "band": F.round("band", 8)})


_MARKET = f"""market AS (SELECT market AS symbol, "date", avg("close") AS "close"
  FROM bars JOIN symbols USING (symbol) GROUP BY 1, 2),
market_ret AS (SELECT symbol, "date", {sql_change('"close"')} AS ret FROM market),
full_dates AS (SELECT "date" FROM market_ret WHERE ret IS NOT NULL GROUP BY 1
  HAVING count(*) = (SELECT count(*) FROM region)),
aligned AS (SELECT m.* FROM market_ret m JOIN full_dates USING ("date")),
matrix AS (SELECT x.symbol AS a, y.symbol AS b, CASE WHEN x.symbol = y.symbol THEN 1 ELSE corr(x.ret, y.ret) END AS corr,
    count(*) AS n_dates FROM aligned x JOIN aligned y ON x."date" = y."date" GROUP BY 1, 2)"""
_MATRIX = (BARS, SYMBOLS, _MARKET)


def market_returns(spark, sf):
    """Daily returns of the market averages; the listing is the smaller side."""
    joined = views.daily_bars(spark, sf).join(views.symbols(spark, sf), "symbol")
    index = joined.groupBy(F.col("market").alias("symbol"), "date").agg(F.avg("close").alias("close"))
    return index.withColumn("ret", change(F.col("close")))


def market_names(spark, sf) -> list[str]:
    # The ticker list a user would pass; the region table holds five rows at any scale.
    return sorted(r["r_name"] for r in views.table(spark, sf, "region").select("r_name").collect())


def matrix(spark, sf):
    names = market_names(spark, sf)
    return st.correlation_matrix(st.aligned_returns(market_returns(spark, sf), names), names)


@query("j1_aligned_returns", with_ctes(*_MATRIX, body="""
SELECT "date", symbol, round(ret, 8) + 0 AS ret FROM aligned"""))
def j1(spark, sf):
    names = market_names(spark, sf)
    wide = st.aligned_returns(market_returns(spark, sf), names)
    cells = F.array(*[F.struct(F.lit(n).alias("symbol"), F.round(F.col(f"`{n}`"), 8).alias("ret")) for n in names])
    return wide.select("date", F.explode(cells).alias("c")).select("date", "c.*")


@query("j2_symbol_pairs", with_ctes(*_MATRIX, body="""
SELECT a, b, round(corr, 8) + 0 AS corr, n_dates FROM matrix WHERE a < b"""))
def j2(spark, sf):
    return st.pair_correlations(matrix(spark, sf)).withColumn("corr", F.round("corr", 8))


@query("a19_correlation_matrix", with_ctes(*_MATRIX, body="""
SELECT a, b, round(corr, 4) + 0 AS corr FROM matrix"""))
def a19(spark, sf):
    return matrix(spark, sf).select("a", "b", F.round("corr", 4).alias("corr"))


@query("a20_most_correlated_pair", with_ctes(*_MATRIX, body="""
SELECT a, b, round(corr, 8) + 0 AS corr FROM matrix WHERE a < b ORDER BY matrix.corr DESC, a, b LIMIT 1"""))
def a20(spark, sf):
    return st.most_correlated(matrix(spark, sf)).select("a", "b", F.round("corr", 8).alias("corr"))


_TICKERS = """top AS (SELECT symbol FROM bars GROUP BY symbol ORDER BY sum("close" * volume) DESC, symbol LIMIT 100),
monthly AS (SELECT symbol, CAST(date_trunc('month', "date") AS DATE) AS "date", arg_max("close", "date") AS "close" FROM bars GROUP BY 1, 2),
month_ret AS (SELECT symbol, "date", "close" / lag("close") OVER (PARTITION BY symbol ORDER BY "date") - 1 AS ret FROM monthly WHERE symbol IN (SELECT symbol FROM top)),
month_all AS (SELECT "date" FROM month_ret WHERE ret IS NOT NULL GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM top)),
together AS (SELECT m.* FROM month_ret m JOIN month_all USING ("date")),
ticker_matrix AS (SELECT x.symbol AS a, y.symbol AS b, CASE WHEN x.symbol = y.symbol THEN 1 ELSE corr(x.ret, y.ret) END AS corr,
    count(*) AS n_dates FROM together x JOIN together y ON x."date" = y."date" GROUP BY 1, 2)"""
_TICKER_MATRIX = (BARS, _TICKERS)


def ticker_returns(spark, sf):
    """Monthly returns of the hundred most traded symbols, in the months in which all have one."""
    bars = views.daily_bars(spark, sf)
    month = F.trunc("date", "month").alias("date")
    monthly = bars.groupBy("symbol", month).agg(F.max_by("close", F.datediff("date", F.lit("1970-01-01"))).alias("close"))
    return cor.aligned(monthly.withColumn("ret", change(F.col("close"))), cor.most_traded(bars))


def ticker_matrix(spark, sf):
    return cor.correlation_matrix(materialize(ticker_returns(spark, sf), "ticker-returns"))


@query("j1_ticker_returns", with_ctes(*_TICKER_MATRIX, body="""
SELECT "date", symbol, round(ret, 8) + 0 AS ret FROM together"""))
def j1_tickers(spark, sf):
    return ticker_returns(spark, sf).select("date", "symbol", F.round("ret", 8).alias("ret"))


@query("j2_ticker_pairs", with_ctes(*_TICKER_MATRIX, body="""
SELECT a, b, round(corr, 8) + 0 AS corr, n_dates FROM ticker_matrix WHERE a < b"""))
def j2_tickers(spark, sf):
    return st.pair_correlations(ticker_matrix(spark, sf)).withColumn("corr", F.round("corr", 8))


@query("a19_ticker_correlations", with_ctes(*_TICKER_MATRIX, body="""
SELECT a, b, round(corr, 4) + 0 AS corr FROM ticker_matrix"""))
def a19_tickers(spark, sf):
    return ticker_matrix(spark, sf).select("a", "b", F.round("corr", 4).alias("corr"))


@query("a20_ticker_pair", with_ctes(*_TICKER_MATRIX, body="""
SELECT a, b, round(corr, 8) + 0 AS corr, n_dates FROM ticker_matrix WHERE a < b ORDER BY ticker_matrix.corr DESC, a, b LIMIT 1"""))
def a20_tickers(spark, sf):
    return st.most_correlated(ticker_matrix(spark, sf)).withColumn("corr", F.round("corr", 8))


_LAST = f"""lasts AS (SELECT symbol, "date", "close", volume,
  max("close") OVER y AS hi, min("close") OVER y AS lo,
  coalesce(lag("close") OVER ({W}), "close") AS prev,
  stddev_samp(ret) OVER t AS vol, count(ret) OVER (PARTITION BY symbol) AS n_ret,
  avg("close") OVER ({W} ROWS 4 PRECEDING) AS ma5, avg("close") OVER t AS ma20,
  row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) AS age FROM l1
  WINDOW y AS ({W} ROWS 251 PRECEDING), t AS ({W} ROWS 19 PRECEDING)),
last1 AS (SELECT * FROM lasts WHERE age = 1)"""


@query("a21_range_52_weeks", with_ctes(BARS, LAYER1, _LAST, body="""
SELECT symbol, "close", hi AS high_52w, lo AS low_52w,
       round(CASE WHEN hi > lo THEN ("close" - lo) * 100 / (hi - lo) ELSE 50 END, 6) AS position_52w FROM last1"""))
def a21(spark, sf):
    return st.range_52w(views.daily_bars(spark, sf)).withColumn("position_52w", F.round("position_52w", 6))


@query("x33_last_bar_change", with_ctes(BARS, LAYER1, _LAST, body="""
SELECT symbol, "date", "close", round("close" - prev, 4) + 0 AS change,
       round(("close" - prev) / prev * 100, 6) + 0 AS change_pct FROM last1"""))
def x33(spark, sf):
    return st.last_change(views.daily_bars(spark, sf)).withColumns(
        {"change": F.round("change", 4), "change_pct": F.round("change_pct", 6)})


@query("a27_row_counts", with_ctes(BARS, body="""
SELECT symbol, count(*) AS ohlcv_rows FROM bars GROUP BY symbol"""))
def a27(spark, sf):
    return views.daily_bars(spark, sf).groupBy("symbol").agg(F.count("*").alias("ohlcv_rows"))


@query("p14_minimum_history", with_ctes(BARS, body="""
SELECT symbol, count(*) AS n, count(*) >= 530 AS kept FROM bars GROUP BY symbol"""))
def p14(spark, sf):
    kept, short = st.with_minimum_history(views.daily_bars(spark, sf), 530)
    good = kept.groupBy("symbol").agg(F.count("*").alias("n")).withColumn("kept", F.lit(True))
    return good.unionByName(short.select("symbol", F.col("rows").alias("n"), F.lit(False).alias("kept")))


@query("p9_finite_or_zero", with_ctes(*NATIVE, body="""
SELECT symbol, "date", round(coalesce(obv_change, 0), 8) + 0 AS obv_change,
       round(coalesce(vol20, 0), 8) AS vol20 FROM l3"""))
def p9(spark, sf):
    rows = ind.native_indicators(views.daily_bars(spark, sf)).select("symbol", "date", "obv_change", "vol20")
    return st.finite_or_zero(rows, ["obv_change", "vol20"]).withColumns(
        {c: F.round(c, 8) for c in ("obv_change", "vol20")})


@query("f9_next_business_day", with_ctes(BARS, body="""
SELECT symbol, "date", CAST("date" + CASE isodow("date") WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS next_day FROM bars"""))
def f9(spark, sf):
    from ..functions.dates import next_business_day

    return views.daily_bars(spark, sf).select("symbol", "date", next_business_day(F.col("date")).alias("next_day"))


@query("f13_safe_percent", with_ctes(BARS, LAYER1, body="""
SELECT symbol, "date", round(CAST(ret AS DOUBLE) * 100, 2) + 0 AS pct FROM l1 WHERE ret IS NOT NULL"""))
def f13(spark, sf):
    from ..functions.text import safe_percent

    rows = views.daily_bars(spark, sf).withColumn("ret", change(F.col("close"))).filter("ret is not null")
    return rows.select("symbol", "date", safe_percent(F.col("ret")).alias("pct"))


_FORECAST = """forecast AS (SELECT *, CASE WHEN n_ret > 1 THEN vol ELSE 0.01 END AS recent_vol,
  (ma5 - ma20) / ma20 AS trend, "close" * (1 + (ma5 - ma20) / ma20 * 0.3) AS center FROM last1)"""


@query("m25_forecast_band", with_ctes(BARS, SYMBOLS, LAYER1, _LAST, _FORECAST, body="""
SELECT f.symbol, name, "date" AS base_date,
       CAST("date" + CASE isodow("date") WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS target_date,
       "close" AS latest_close, round("close" - prev, 4) + 0 AS change,
       round(("close" - prev) / prev * 100, 6) + 0 AS change_pct, hi AS high_52w, lo AS low_52w,
       round(CASE WHEN hi > lo THEN ("close" - lo) * 100 / (hi - lo) ELSE 50 END, 6) AS position_52w,
       volume AS latest_volume,
       round(center - "close" * recent_vol * 1.5, 4) AS predicted_lower,
       round(center + "close" * recent_vol * 1.5, 4) AS predicted_upper,
       round(center, 4) AS predicted_center, round(center * 0.995, 4) AS center_low,
       round(center * 1.005, 4) AS center_high, round(recent_vol * 100, 6) AS recent_volatility_pct,
       CASE WHEN trend > 0.005 THEN '높음' WHEN trend < -0.005 THEN '낮음' ELSE '중간' END AS up_scenario
FROM forecast f JOIN symbols s ON f.symbol = s.symbol"""))
def m25(spark, sf):
    band = st.forecast_band(views.daily_bars(spark, sf), views.symbols(spark, sf))
    four = ("change", "predicted_lower", "predicted_upper", "predicted_center", "center_low", "center_high")
    six = ("change_pct", "position_52w", "recent_volatility_pct")
    return band.withColumns({c: F.round(c, 4) for c in four} | {c: F.round(c, 6) for c in six})


@query("j4_name_lookup", with_ctes(BARS, SYMBOLS, body="""
SELECT b.symbol, coalesce(s.name, b.symbol) AS name, count(*) AS n
FROM bars b LEFT JOIN (SELECT * FROM symbols WHERE market <> 'ASIA') s ON b.symbol = s.symbol GROUP BY 1, 2"""))
def j4(spark, sf):
    counts = views.daily_bars(spark, sf).groupBy("symbol").agg(F.count("*").alias("n"))
    return st.with_names(counts, views.symbols(spark, sf).filter("market <> 'ASIA'"))


@query("m26_crawl_summary", with_ctes(BARS, SYMBOLS, """heads AS (
  SELECT market, string_agg(symbol, '|' ORDER BY symbol) AS sample FROM (
    SELECT *, row_number() OVER (PARTITION BY market ORDER BY symbol) AS r FROM symbols) WHERE r <= 10 GROUP BY market)""", body="""
SELECT b.symbol, name, s.market, count(*) AS ohlcv_rows, max("date") AS latest_date,
       arg_max(open, "date") AS latest_open, arg_max(high, "date") AS latest_high, arg_max(low, "date") AS latest_low,
       arg_max("close", "date") AS latest_close, arg_max(volume, "date") AS latest_volume, any_value(sample) AS sample
FROM bars b JOIN symbols s ON b.symbol = s.symbol JOIN heads h ON s.market = h.market GROUP BY 1, 2, 3"""))
def m26(spark, sf):
    rows = st.crawl_summary(views.daily_bars(spark, sf), views.symbols(spark, sf))
    return rows.select("symbol", "name", "market", "ohlcv_rows", *[F.col(f"latest.{c}").alias(f"latest_{c}") for c in ("date", "open", "high", "low", "close", "volume")],
                       F.concat_ws("|", "sample").alias("sample"))


@query("t1_sorted_bars", with_ctes(BARS, body="""
SELECT symbol, "date", "close" FROM bars ORDER BY symbol, "date" """))
def t1(spark, sf):
    return views.daily_bars(spark, sf).select("symbol", "date", "close").orderBy("symbol", "date")


@query("t2_latest_bar", with_ctes(BARS, body="""
SELECT symbol, max("date") AS "date", arg_max(open, "date") AS open, arg_max("close", "date") AS "close",
       arg_max(volume, "date") AS volume FROM bars GROUP BY symbol"""))
def t2(spark, sf):
    return st.latest_bar(views.daily_bars(spark, sf)).select(
        "symbol", "latest.date", "latest.open", "latest.close", "latest.volume")


@query("t3_newest_rows", with_ctes(BARS, body="""
SELECT * FROM (SELECT symbol, "date", "close",
  CAST(row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) AS INTEGER) AS age FROM bars) WHERE age <= 30"""))
def t3(spark, sf):
    return st.newest_rows(views.daily_bars(spark, sf).select("symbol", "date", "close"), 30)


@query("m22_timeseries_report", with_ctes(*_DASH, f"""lagged AS (SELECT symbol, ret, lag(ret) OVER ({W}) AS past FROM dash),
acf AS (SELECT symbol, corr(ret, past) AS acf1 FROM lagged GROUP BY symbol),
tail AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) AS age FROM dash)""", body="""
SELECT t.symbol, count(*) AS n, round(avg(ret), 8) + 0 AS mean_ret, round(stddev_samp(ret) * sqrt(252), 8) AS ann_vol,
       round(avg(CAST(ret > 0 AS INTEGER)), 8) AS up_ratio, round(any_value(acf1), 8) + 0 AS acf1,
       round(2 / sqrt(count(*)), 8) AS band,
       round(coalesce(avg(CASE WHEN isodow("date") = 1 THEN ret END), 0), 8) + 0 AS monday_ret,
       round(coalesce(avg(CASE WHEN month("date") = 1 THEN ret END), 0), 8) + 0 AS january_ret,
       round(sum(CASE WHEN age <= 120 THEN ma20 END), 4) AS tail_ma20_sum
FROM tail t JOIN acf a ON t.symbol = a.symbol GROUP BY t.symbol"""))
def m22(spark, sf):
    from .reports import timeseries_report

    rows = timeseries_report(dash(spark, sf))
    tail = F.aggregate("tail", F.lit(0.0), lambda acc, x: acc + x["ma20"])
    return rows.select(
        "symbol", "n", *[F.round(c, 8).alias(c) for c in ("mean_ret", "ann_vol", "up_ratio")],
        F.round(F.col("acf")[0], 8).alias("acf1"), F.round("band", 8).alias("band"),
        F.round(F.col("weekday")[0], 8).alias("monday_ret"), F.round(F.col("month")[0], 8).alias("january_ret"),
        F.round(tail, 4).alias("tail_ma20_sum"))


_LAGS = ", ".join(f"lag(ret, {k}) OVER ({W}) AS r{k}" for k in range(1, 11))
_PARTS = " UNION ALL ".join([
    *[f"SELECT symbol, 'summary' AS part, '{n}' AS name, CAST({x} AS DOUBLE) AS value FROM lags GROUP BY symbol" for n, x in (
        ("n", "count(ret)"), ("mean_ret", "avg(ret)"), ("ann_vol", "stddev_samp(ret) * sqrt(252)"), ("up_ratio", "avg(CAST(ret > 0 AS INTEGER))"), ("band", "2 / sqrt(count(ret))"))],
    *[f"SELECT symbol, 'acf', '{k}', corr(ret, r{k}) FROM lags GROUP BY symbol" for k in range(1, 11)],
    *[f"""SELECT symbol, 'weekday', '{i}', coalesce(avg(CASE WHEN isodow("date") = {i + 1} THEN ret END), 0) FROM lags GROUP BY symbol""" for i in range(5)],
    *[f"""SELECT symbol, 'month', '{i}', coalesce(avg(CASE WHEN month("date") = {i} THEN ret END), 0) FROM lags GROUP BY symbol""" for i in range(1, 13)],
    *[f"""SELECT symbol, '{c}', strftime("date", '%Y-%m-%d'), "{c}" FROM tailed WHERE age <= 120""" for c in ("close", "ma20", "ma60")],
    """SELECT symbol, 'month close', strftime(m, '%Y-%m'), c FROM (SELECT symbol, date_trunc('month', "date") AS m, avg("close") AS c,
         row_number() OVER (PARTITION BY symbol ORDER BY date_trunc('month', "date") DESC) AS r FROM dash GROUP BY 1, 2) WHERE r <= 24"""])


@query("m22_timeseries_details", with_ctes(*_DASH, f"""lags AS (SELECT symbol, "date", ret, {_LAGS} FROM dash),
tailed AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) AS age FROM dash)""", body=f"""
SELECT symbol, part, name, round(value, 7) + 0 AS value FROM ({_PARTS})"""))
def m22_details(spark, sf):
    """Every number of the report as a row: summary, ten lags, weekdays, months, the chart and the newest months' closes."""
    from .reports import timeseries_details

    return timeseries_details(dash(spark, sf)).withColumn("value", F.round("value", 7))


_CURVE = f"""signals AS (SELECT symbol, "date", ret, stoch_k / 100 AS p FROM l3 WHERE ret IS NOT NULL AND stoch_k IS NOT NULL),
daily AS (SELECT *, CASE WHEN p >= 0.55 THEN ret ELSE 0 END AS d, p >= 0.55 AS held FROM signals),
logs AS (SELECT *, sum(ln(1 + d)) OVER ({W} ROWS UNBOUNDED PRECEDING) AS le,
  sum(ln(1 + ret)) OVER ({W} ROWS UNBOUNDED PRECEDING) AS lb FROM daily),
curve AS (SELECT *, greatest(0, max(le) OVER ({W} ROWS UNBOUNDED PRECEDING)) AS lp FROM logs)"""


def signals(spark, sf):
    rows = ind.native_indicators(views.daily_bars(spark, sf))
    return rows.select("symbol", "date", "ret", (F.col("stoch_k") / 100).alias("p")).filter(
        "ret is not null and p is not null")


@query("x32_drawdown_curve", with_ctes(*NATIVE, _CURVE, body="""
SELECT symbol, "date", held, round(le, 6) + 0 AS log_equity, round(lp, 6) + 0 AS log_peak,
       round(exp(le - lp) - 1, 6) + 0 AS drawdown FROM curve"""))
def x32(spark, sf):
    curve = bt.equity_curve(signals(spark, sf))
    return curve.select(
        "symbol", "date", "held", F.round(F.ln("equity"), 6).alias("log_equity"),
        F.round(F.ln("peak"), 6).alias("log_peak"), F.round("drawdown", 6).alias("drawdown"))


@query("m23_backtest", with_ctes(*NATIVE, _CURVE, body="""
SELECT symbol, count(*) AS n_days, round(arg_max(le, "date"), 6) + 0 AS log_equity,
       round(arg_max(lb, "date"), 6) + 0 AS log_buy_hold,
       round(least(0, min(exp(le - lp) - 1)) * 100, 2) + 0 AS mdd_pct,
       round(avg(d) / (stddev_pop(d) + 1e-9) * sqrt(252), 3) + 0 AS sharpe, count(*) FILTER (held) AS trades
FROM curve GROUP BY symbol"""))
def m23(spark, sf):
    metrics = bt.backtest_metrics(bt.equity_curve(signals(spark, sf)))
    shown = bt.display_metrics(metrics).select("symbol", "mdd_pct", "sharpe", "trades")
    logs = metrics.select(
        "symbol", "n_days", F.round(F.log1p("total_return"), 6).alias("log_equity"),
        F.round(F.log1p("buy_hold_return"), 6).alias("log_buy_hold"))
    return logs.join(shown, "symbol")
