"""Technical indicators over a panel of daily bars (symbol, date, open, high,
low, close, volume) with one row per symbol and day.

All row windows share one spec, hence one exchange and one sort.  The only
step outside the JVM is the exponential smoothing, a first-order recursion per
symbol; it runs last, on the partitioning the windows already made.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rolling import EPS, by_symbol, change, full, last_n, so_far
from ..schemas import DASH, DL20, ML20

EWM_COLUMNS = ["ema12", "ema26", "macd", "macd_signal", "avg_gain", "avg_loss"]


def ohlcv_defaults(df: DataFrame) -> DataFrame:
    """High and low fall back to the close, volume to 1."""
    have = set(df.columns)
    for name in ("high", "low"):
        if name not in have:
            df = df.withColumn(name, F.col("close"))
    if "volume" not in have:
        df = df.withColumn("volume", F.lit(1.0))
    return df


def moving_averages(bars: DataFrame, *lengths: int) -> DataFrame:
    return bars.withColumns({f"ma{n}": full(F.avg, F.col("close"), n) for n in lengths})


def true_range() -> Column:
    """Largest of the day's range and the two gaps to the previous close; the
    gaps are null, hence skipped, on the first bar."""
    previous = F.lag("close").over(by_symbol())
    return F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - previous), F.abs(F.col("low") - previous)
    )


def on_balance_step() -> Column:
    return F.signum(F.col("close") - F.lag("close").over(by_symbol())) * F.col("volume")


def native_indicators(bars: DataFrame) -> DataFrame:
    """Every indicator that needs no recursion, under neutral names.

    Catalyst drops the window expressions a caller does not select.
    """
    df = ohlcv_defaults(bars)
    close, volume = F.col("close"), F.col("volume")
    df = df.withColumns(
        {
            "ret": change(close),
            "log_ret": F.ln(F.try_divide(close, F.lag(close).over(by_symbol()))),
            "ret_5": change(close, 5),
            "ret_20": change(close, 20),
            "ma5": full(F.avg, close, 5),
            "ma20": full(F.avg, close, 20),
            "ma60": full(F.avg, close, 60),
            "std20": full(F.stddev_samp, close, 20),
            "low14": full(F.min, F.col("low"), 14),
            "high14": full(F.max, F.col("high"), 14),
            "tr": true_range(),
            "obv_step": on_balance_step(),
            "volume_change": change(volume),
            "vol_mean5": full(F.avg, volume, 5),
            "vol_mean10": full(F.avg, volume, 10),
            "vol_mean20": full(F.avg, volume, 20),
        }
    )
    span = F.col("high14") - F.col("low14") + EPS
    df = df.withColumns(
        {
            "stoch_k": (close - F.col("low14")) * 100 / span,
            "williams_r": (F.col("high14") - close) * -100 / span,
            "atr14": full(F.avg, F.col("tr"), 14) / (close + EPS),
            "vol20": full(F.stddev_samp, F.col("ret"), 20),
            "volatility5": full(F.stddev_samp, F.col("ret"), 5),
            "obv": F.when(F.col("obv_step").isNotNull(), F.sum("obv_step").over(so_far())),
        }
    )
    band = F.col("std20") * 4
    return df.withColumns(
        {
            "ma5_ratio": close / (F.col("ma5") + EPS),
            "ma20_ratio": close / (F.col("ma20") + EPS),
            "ma60_ratio": close / (F.col("ma60") + EPS),
            "stoch_d": full(F.avg, F.col("stoch_k"), 3),
            "bb_width": band / (F.col("ma20") + EPS),
            "bb_position": (close - (F.col("ma20") - F.col("std20") * 2)) / (band + EPS),
            "obv_change": change(F.col("obv")),
            "vol_ratio5": volume / (F.col("vol_mean5") + EPS),
            "vol_ratio10": volume / (F.col("vol_mean10") + EPS),
            "vol_ratio20": volume / (F.col("vol_mean20") + EPS),
            "ma_cross": (F.col("ma5") > F.col("ma20")).cast("int"),
        }
    )


def _smooth(values: np.ndarray, **decay: float) -> np.ndarray:
    return pd.Series(values).ewm(adjust=False, **decay).mean().to_numpy()


def with_ewm(df: DataFrame) -> DataFrame:
    """Add the exponentially smoothed columns.

    One grouped map per symbol over Arrow columns; a group is bounded by the
    trading calendar.  Columns other than date and close pass through untouched.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.DoubleType()) for c in EWM_COLUMNS])

    def per_symbol(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("date")
        close = rows["close"].to_numpy()
        step = np.diff(close, prepend=np.nan)
        fast, slow = _smooth(close, span=12), _smooth(close, span=26)
        macd = (fast - slow) / (close + EPS)
        added = [
            fast, slow, macd, _smooth(macd, span=9),
            _smooth(np.maximum(step, 0.0), alpha=1 / 14), _smooth(np.maximum(-step, 0.0), alpha=1 / 14),
        ]
        for name, values in zip(EWM_COLUMNS, added):
            rows = rows.append_column(name, pa.array(values, from_pandas=True))
        return rows

    return df.groupBy("symbol").applyInArrow(per_symbol, schema)


def rsi() -> Column:
    return F.lit(100) - F.lit(100) / (F.col("avg_gain") / (F.col("avg_loss") + EPS) + 1)


# Contract column -> neutral column of native_indicators.
_ML_NATIVE = {
    "Returns": "ret", "MA5_Ratio": "ma5_ratio", "MA20_Ratio": "ma20_ratio", "MA60_Ratio": "ma60_ratio",
    "Stoch_K": "stoch_k", "Stoch_D": "stoch_d", "Williams_R": "williams_r", "BB_Width": "bb_width",
    "BB_Position": "bb_position", "ATR14": "atr14", "Volatility": "vol20",
    "Volume_Change": "volume_change", "Volume_MA_Ratio": "vol_ratio20", "OBV_Change": "obv_change",
    "Momentum_5": "ret_5", "Momentum_20": "ret_20",
}
_DL_NATIVE = {
    "MA5_r": "ma5_ratio", "MA20_r": "ma20_ratio", "MA60_r": "ma60_ratio", "Stoch_K": "stoch_k",
    "Stoch_D": "stoch_d", "Williams_R": "williams_r", "BB_W": "bb_width", "BB_P": "bb_position",
    "ATR": "atr14", "Vol20": "vol20", "Vol_R": "vol_ratio5", "Vol_MA20_R": "vol_ratio20",
    "OBV_R": "obv_change", "Ret1": "ret", "Ret5": "ret_5", "Mom20": "ret_20",
}
_DASH_NATIVE = {name: name for name in DASH} | {"vol_ratio": "vol_ratio10", "volatility": "volatility5"}
_PROFILES = {
    "ml20": (ML20, _ML_NATIVE, {"MACD": "macd", "MACD_Signal": "macd_signal", "RSI14": None}, "MACD_Hist"),
    "dl20": (DL20, _DL_NATIVE, {"MACD": "macd", "MACD_S": "macd_signal", "RSI": None}, "MACD_H"),
    "dash": (DASH, _DASH_NATIVE, {}, None),
}


def contract(profile: str) -> list[str]:
    return list(_PROFILES[profile][0])


def feature_frame(
    bars: DataFrame,
    profile: str,
    *,
    targets: dict[str, Column] | None = None,
    rank: bool = False,
    keep: tuple[str, ...] = (),
    labelled: bool = True,
) -> DataFrame:
    """Feature rows of one profile in contract order, incomplete rows dropped.

    ``targets`` are columns over the bars (forward labels and the like); a row
    whose target is null is dropped too, unless ``labelled`` is off.  With ``rank`` the result also carries
    ``rn`` (1-based position) and ``n_rows`` per symbol, counted over the rows
    that stay, for ordered splits and folds.  Both are computed before the
    smoothing step so that they cost no further exchange.
    """
    columns, native, recursive, histogram = _PROFILES[profile]
    targets = targets or {}
    df = native_indicators(bars).select(
        "symbol", "date", "close", *keep,
        *[F.col(src).alias(name) for name, src in native.items()],
        *[expr.alias(name) for name, expr in targets.items()],
    )
    needed = [F.col(name).isNotNull() for name in [*native, *(targets if labelled else ())]]
    complete = needed[0]
    for condition in needed[1:]:
        complete = complete & condition
    df = df.withColumn("complete", complete)
    if rank:
        flag = F.col("complete").cast("int")
        df = df.withColumns(
            {
                "rn": F.sum(flag).over(so_far()),
                "n_rows": F.sum(flag).over(by_symbol().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            }
        )
    extra = (["rn", "n_rows"] if rank else [])
    if recursive:
        df = with_ewm(df).filter("complete")
        filled = {name: (F.col(src) if src else rsi()) for name, src in recursive.items()}
        filled[histogram] = F.col("macd") - F.col("macd_signal")
    else:
        df = df.filter("complete")
        filled = {}
    return df.select(
        "symbol", "date", "close", *keep,
        *[filled[c].alias(c) if c in filled else F.col(c) for c in columns],
        *targets, *extra,
    )


def latest_features(bars: DataFrame, profile: str = "ml20") -> DataFrame:
    """The newest complete feature row of every symbol."""
    rows = feature_frame(bars, profile)
    cells = F.struct("date", "close", *contract(profile))
    return rows.groupBy("symbol").agg(F.max_by(cells, "date").alias("r")).select("symbol", "r.*")
