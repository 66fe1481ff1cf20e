"""Return statistics, calendar effects, correlations and the forecast band.

Inputs are daily bars or feature rows, at most one row per symbol and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import next_business_day
from ..functions.rolling import EPS, by_symbol, change, last_n, so_far
from .indicators import rsi, with_ewm

TRADING_DAYS = 252
# Minimum history of the per-symbol analyses.
MIN_ROWS = {"cluster": 20, "timeseries": 30, "sequence": 120, "transformer": 60, "patch": 70, "training": 75}


def adjusted_skewness(x: Column) -> Column:
    """Bias-adjusted sample skewness; null below three values."""
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def annual_return(ret: Column) -> Column:
    return F.avg(ret) * TRADING_DAYS


def annual_volatility(ret: Column) -> Column:
    return F.stddev_samp(ret) * F.sqrt(F.lit(float(TRADING_DAYS)))


def history_profile(bars: DataFrame, digits: int = 4) -> DataFrame:
    """The eight clustering features of every symbol with at least 20 bars.

    Window columns first, then the smoothing for the RSI, then one aggregation
    whose partials are a few numbers per symbol.
    """
    close, volume = F.col("close"), F.col("volume")
    rows = (
        bars.select("symbol", "date", "close", "volume")
        .withColumns(
            {
                "ret": change(close),
                "growth": F.try_divide(close, F.first(close).over(so_far())),
                "close_20_ago": F.lag(close, 20).over(by_symbol()),
                "volume5": F.avg(volume).over(last_n(5)),
                "volume20": F.avg(volume).over(last_n(20)),
            }
        )
        .withColumn("growth", F.when(F.col("ret").isNotNull(), F.col("growth")))
        .withColumn("peak", F.max("growth").over(so_far()))
        .withColumn("drawdown", (F.col("growth") - F.col("peak")) / (F.col("peak") + EPS))
        .select("symbol", "date", "close", "volume", "ret", "drawdown", "close_20_ago", "volume5", "volume20")
    )
    ret = F.col("ret")
    last = F.max_by(F.struct("close", "close_20_ago", "volume5", "volume20"), "date")
    out = (
        with_ewm(rows)
        .withColumn("rsi", rsi())
        .groupBy("symbol")
        .agg(
            F.count("*").alias("n_bars"),
            annual_return(ret).alias("ann_return"),
            annual_volatility(ret).alias("ann_vol"),
            F.min("drawdown").alias("max_dd"),
            F.avg("rsi").alias("rsi_mean"),
            adjusted_skewness(ret).alias("skewness"),
            F.sum("volume").alias("total_volume"),
            last.alias("last"),
        )
        .filter(F.col("n_bars") >= MIN_ROWS["cluster"])
    )
    long_enough = F.col("n_bars") > 20
    out = out.withColumns(
        {
            "sharpe": F.col("ann_return") / (F.col("ann_vol") + EPS),
            "momentum_20": F.when(
                long_enough, F.try_divide(F.col("last.close"), F.col("last.close_20_ago")) - 1
            ).otherwise(0.0),
            "vol_ratio": F.when(
                long_enough & (F.col("total_volume") > 0), F.col("last.volume5") / (F.col("last.volume20") + EPS)
            ).otherwise(1.0),
        }
    )
    names = ["ann_return", "ann_vol", "sharpe", "max_dd", "rsi_mean", "momentum_20", "vol_ratio", "skewness"]
    return out.select("symbol", *[F.round(c, digits).alias(c) for c in names])


def finite_or_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls, NaN and infinities become 0."""
    inf = float("inf")
    return df.withColumns(
        {c: F.when(F.isnan(c) | F.abs(c).eqNullSafe(inf) | F.col(c).isNull(), 0.0).otherwise(F.col(c)) for c in columns}
    )


def _long(wide: DataFrame, keys: list[str], cells: list[tuple], names: tuple[str, str]) -> DataFrame:
    """Turn named columns of one row into (name, value) rows."""
    structs = [F.struct(F.lit(k).alias(names[0]), v.alias(names[1])) for k, v in cells]
    return wide.select(*keys, F.explode(F.array(*structs)).alias("cell")).select(*keys, "cell.*")


def weekday_effect(rows: DataFrame) -> DataFrame:
    """Mean return per symbol on Monday (0) to Friday (4); 0 where none fell."""
    aggs = [
        F.coalesce(F.avg(F.when(F.weekday("date") == i, F.col("ret"))), F.lit(0.0)).alias(f"d{i}") for i in range(5)
    ]
    wide = rows.groupBy("symbol").agg(*aggs)
    return _long(wide, ["symbol"], [(i, F.col(f"d{i}")) for i in range(5)], ("weekday", "mean_ret"))


def month_effect(rows: DataFrame) -> DataFrame:
    aggs = [
        F.coalesce(F.avg(F.when(F.month("date") == i, F.col("ret"))), F.lit(0.0)).alias(f"m{i}") for i in range(1, 13)
    ]
    wide = rows.groupBy("symbol").agg(*aggs)
    return _long(wide, ["symbol"], [(i, F.col(f"m{i}")) for i in range(1, 13)], ("month", "mean_ret"))


def monthly_close(rows: DataFrame, last: int = 24) -> DataFrame:
    """Average close of the newest ``last`` calendar months of each symbol."""
    months = rows.groupBy("symbol", F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.avg("close").alias("avg_close")
    )
    newest = Window.partitionBy("symbol").orderBy(F.desc("year"), F.desc("month"))
    return months.withColumn("r", F.row_number().over(newest)).filter(F.col("r") <= last).drop("r")


def return_summary(rows: DataFrame) -> DataFrame:
    ret = F.col("ret")
    return rows.groupBy("symbol").agg(
        F.count(ret).alias("n"),
        F.avg(ret).alias("mean_ret"),
        annual_volatility(ret).alias("ann_vol"),
        F.avg((ret > 0).cast("int")).alias("up_ratio"),
    )


def autocorrelation(rows: DataFrame, lags: int = 10) -> DataFrame:
    """Autocorrelation of returns at lags 1..n with its 2/sqrt(n) band."""
    ret = F.col("ret")
    shifted = rows.withColumns({f"r{k}": F.lag(ret, k).over(by_symbol()) for k in range(1, lags + 1)})
    wide = shifted.groupBy("symbol").agg(
        F.count(ret).alias("n"), *[F.corr(ret, F.col(f"r{k}")).alias(f"c{k}") for k in range(1, lags + 1)]
    )
    out = _long(wide, ["symbol", "n"], [(k, F.col(f"c{k}")) for k in range(1, lags + 1)], ("lag", "acf"))
    return out.select("symbol", "lag", "acf", (F.lit(2.0) / F.sqrt(F.col("n").cast("double"))).alias("band"))


def range_52w(bars: DataFrame, window: int = TRADING_DAYS) -> DataFrame:
    """High, low and position of the newest close within the last 252 bars."""
    close = F.col("close")
    out = newest_rows(bars, window).groupBy("symbol").agg(
        F.max_by("close", "date").alias("close"), F.max("close").alias("hi"), F.min("close").alias("lo"))
    span = F.col("hi") - F.col("lo")
    return out.select(
        "symbol", "close", F.col("hi").alias("high_52w"), F.col("lo").alias("low_52w"),
        F.when(span > 0, F.try_divide((close - F.col("lo")) * 100, span)).otherwise(50.0).alias("position_52w"),
    )


def at_age(column: str, age: int) -> Column:
    """Aggregate: the value of the row that many bars before the end (1 = newest)."""
    return F.max(F.when(F.col("age") == age, F.col(column)))


def last_change(bars: DataFrame) -> DataFrame:
    """Change of the newest bar against the one before; 0 without one."""
    out = newest_rows(bars, 2).groupBy("symbol").agg(
        at_age("date", 1).alias("date"), at_age("close", 1).alias("close"),
        F.coalesce(at_age("close", 2), at_age("close", 1)).alias("prev"))
    diff = F.col("close") - F.col("prev")
    return out.select(
        "symbol", "date", "close", diff.alias("change"),
        F.coalesce(F.try_divide(diff, F.col("prev")) * 100, F.lit(0.0)).alias("change_pct"),
    )


def aligned_returns(returns: DataFrame, tickers: list[str]) -> DataFrame:
    """One row per date with a return column per ticker; dates on which any of
    them has none are left out.  The explicit list keeps this one aggregation."""
    return returns.groupBy("date").pivot("symbol", tickers).agg(F.first("ret")).na.drop()


def correlation_matrix(aligned: DataFrame, tickers: list[str]) -> DataFrame:
    """Correlation of every ordered pair, computed as aggregates over the aligned
    rows: no join and no pair rows before the final k x k result."""
    pairs = [(a, b) for i, a in enumerate(tickers) for b in tickers[i + 1:]]
    wide = aligned.agg(
        F.count("*").alias("n_dates"),
        *[F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
    )
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells += [(a, b, F.col(f"c{i}")), (b, a, F.col(f"c{i}"))]
    cells += [(t, t, F.lit(1.0)) for t in tickers]
    structs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("corr")) for a, b, v in cells]
    return wide.select("n_dates", F.explode(F.array(*structs)).alias("c")).select("c.*", "n_dates")


def pair_correlations(matrix: DataFrame) -> DataFrame:
    return matrix.filter(F.col("a") < F.col("b"))


def most_correlated(matrix: DataFrame) -> DataFrame:
    return pair_correlations(matrix).orderBy(F.desc("corr"), "a", "b").limit(1)


# Parameters and scenario words of the forecast band.
TREND_WEIGHT, VOLATILITY_MULTIPLIER, CENTER_BAND, TREND_THRESHOLD = 0.3, 1.5, 0.005, 0.005
SCENARIO = {"up": "높음", "down": "낮음", "flat": "중간"}


def forecast_band(bars: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Next-day band of every symbol from its newest bars.

    Only the newest 253 bars matter.  The ranking that picks them is cut off
    before the shuffle, and the band needs no sliding frame after it.
    """
    close, age = F.col("close"), F.col("age")
    before = F.lead("close").over(Window.partitionBy("symbol").orderBy("age"))
    recent = newest_rows(bars.select("symbol", "date", "close", "volume"), TRADING_DAYS + 1)
    recent = recent.withColumn("ret", F.try_divide(close, before) - 1)
    last = recent.groupBy("symbol").agg(
        at_age("date", 1).alias("date"), at_age("close", 1).alias("close"), at_age("volume", 1).alias("volume"),
        F.coalesce(at_age("close", 2), at_age("close", 1)).alias("prev"),
        F.max(F.when(age <= TRADING_DAYS, close)).alias("hi"), F.min(F.when(age <= TRADING_DAYS, close)).alias("lo"),
        F.stddev_samp(F.when(age <= 20, F.col("ret"))).alias("vol"), F.count("ret").alias("n_ret"),
        F.avg(F.when(age <= 5, close)).alias("ma5"), F.avg(F.when(age <= 20, close)).alias("ma20"),
    )
    trend = F.coalesce(F.try_divide(F.col("ma5") - F.col("ma20"), F.col("ma20")), F.lit(0.0))
    out = (
        last.withColumn("recent_vol", F.when(F.col("n_ret") > 1, F.col("vol")).otherwise(0.01))
        .withColumn("trend", trend)
        .withColumn("center", close * (F.lit(1.0) + F.col("trend") * TREND_WEIGHT))
        .withColumn("delta", close * F.col("recent_vol") * VOLATILITY_MULTIPLIER)
    )
    change_now = close - F.col("prev")
    span = F.col("hi") - F.col("lo")
    result = out.select(
        "symbol",
        F.col("date").alias("base_date"),
        next_business_day(F.col("date")).alias("target_date"),
        close.alias("latest_close"),
        change_now.alias("change"),
        F.coalesce(F.try_divide(change_now, F.col("prev")) * 100, F.lit(0.0)).alias("change_pct"),
        F.col("hi").alias("high_52w"),
        F.col("lo").alias("low_52w"),
        F.when(span > 0, F.try_divide((close - F.col("lo")) * 100, span)).otherwise(50.0).alias("position_52w"),
        F.col("volume").alias("latest_volume"),
        (F.col("center") - F.col("delta")).alias("predicted_lower"),
        (F.col("center") + F.col("delta")).alias("predicted_upper"),
        F.col("center").alias("predicted_center"),
        (F.col("center") * (1 - CENTER_BAND)).alias("center_low"),
        (F.col("center") * (1 + CENTER_BAND)).alias("center_high"),
        (F.col("recent_vol") * 100).alias("recent_volatility_pct"),
        F.when(F.col("trend") > TREND_THRESHOLD, SCENARIO["up"])
        .when(F.col("trend") < -TREND_THRESHOLD, SCENARIO["down"])
        .otherwise(SCENARIO["flat"]).alias("up_scenario"),
    )
    return with_names(result, names) if names is not None else result


def with_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Attach display names; a symbol without one is shown by its code, one with several by the first."""
    known = names.groupBy("symbol").agg(F.min("name").alias("_name"))
    return df.join(known, "symbol", "left").withColumn("name", F.coalesce("_name", "symbol")).drop("_name")


def latest_bar(bars: DataFrame) -> DataFrame:
    cells = F.struct("date", "open", "high", "low", "close", "volume")
    return bars.groupBy("symbol").agg(F.max_by(cells, "date").alias("latest"), F.count("*").alias("ohlcv_rows"))


def newest_rows(bars: DataFrame, n: int) -> DataFrame:
    newest = Window.partitionBy("symbol").orderBy(F.desc("date"))
    return bars.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= n)


def with_minimum_history(bars: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Bars of symbols with enough history, and the symbols left out."""
    sized = bars.withColumn("history", F.count("*").over(Window.partitionBy("symbol")))
    kept = sized.filter(F.col("history") >= rows).drop("history")
    counts = bars.groupBy("symbol").agg(F.count("*").alias("rows"))
    short = counts.filter(F.col("rows") < rows).withColumn("error", F.lit(f"fewer than {rows} rows"))
    return kept, short


def market_sample(listing: DataFrame, n: int = 10) -> DataFrame:
    """The first n codes of every market as one array per market."""
    first = Window.partitionBy("market").orderBy("symbol")
    top = listing.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= n)
    return top.groupBy("market").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "symbol", "name"))), lambda s: s["symbol"]).alias("sample")
    )


def crawl_summary(bars: DataFrame, listing: DataFrame, sample: int = 10) -> DataFrame:
    """Row count, newest bar, listing entry and market sample of every symbol."""
    facts = latest_bar(bars).join(listing, "symbol", "left").withColumn("name", F.coalesce("name", F.lit("")))
    return facts.join(market_sample(listing, sample), "market", "left")
