"""DuckDB text of the indicator layers, built from window snippets."""

from __future__ import annotations

from .registry import BARS

W = 'PARTITION BY symbol ORDER BY "date"'


def full(agg: str, x: str, n: int) -> str:
    frame = f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {frame} = {n} THEN {agg}({x}) OVER {frame} END"


def lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER ({W})"


def change(x: str, n: int = 1) -> str:
    return f"(CAST({x} AS DOUBLE) / nullif({lag(x, n)}, 0) - 1)"


LAYER1 = f"""l1 AS (SELECT symbol, "date", open, high, low, "close", volume,
  row_number() OVER ({W}) AS pos,
  {change('"close"')} AS ret, ln("close" / nullif({lag('"close"')}, 0)) AS log_ret,
  {change('"close"', 5)} AS ret_5, {change('"close"', 20)} AS ret_20,
  {full('avg', '"close"', 5)} AS ma5, {full('avg', '"close"', 20)} AS ma20, {full('avg', '"close"', 60)} AS ma60,
  {full('stddev_samp', '"close"', 20)} AS std20, {full('min', 'low', 14)} AS low14, {full('max', 'high', 14)} AS high14,
  greatest(high - low, abs(high - {lag('"close"')}), abs(low - {lag('"close"')})) AS tr,
  sign("close" - {lag('"close"')}) * volume AS obv_step,
  {change('volume')} AS volume_change, {full('avg', 'volume', 5)} AS vol_mean5,
  {full('avg', 'volume', 10)} AS vol_mean10, {full('avg', 'volume', 20)} AS vol_mean20
  FROM bars)"""

LAYER2 = f"""l2 AS (SELECT *,
  100 * ("close" - low14) / (high14 - low14 + 1e-9) AS stoch_k,
  -100 * (high14 - "close") / (high14 - low14 + 1e-9) AS williams_r,
  {full('avg', 'tr', 14)} / ("close" + 1e-9) AS atr14, {full('stddev_samp', 'ret', 20)} AS vol20,
  {full('stddev_samp', 'ret', 5)} AS volatility5,
  CASE WHEN obv_step IS NOT NULL THEN sum(obv_step) OVER ({W} ROWS UNBOUNDED PRECEDING) END AS obv
  FROM l1)"""

LAYER3 = f"""l3 AS (SELECT *,
  "close" / (ma5 + 1e-9) AS ma5_ratio, "close" / (ma20 + 1e-9) AS ma20_ratio, "close" / (ma60 + 1e-9) AS ma60_ratio,
  {full('avg', 'stoch_k', 3)} AS stoch_d, 4 * std20 / (ma20 + 1e-9) AS bb_width,
  ("close" - (ma20 - 2 * std20)) / (4 * std20 + 1e-9) AS bb_position, {change('obv')} AS obv_change,
  volume / (vol_mean5 + 1e-9) AS vol_ratio5, volume / (vol_mean10 + 1e-9) AS vol_ratio10,
  volume / (vol_mean20 + 1e-9) AS vol_ratio20, CAST(ma5 > ma20 AS INTEGER) AS ma_cross
  FROM l2)"""

NATIVE = (BARS, LAYER1, LAYER2, LAYER3)


def _ewm(value: str, alpha: str, first: int) -> str:
    """y1 = x1, y = (1-a) y' + a x as one running sum: each x is divided by its decay, the sum multiplied by the row's.

    At most some 2,500 days stand in a row, so the powers stay far inside the range of a double.
    """
    weight = f"CASE WHEN pos = {first} THEN 1.0 ELSE {alpha} END * power(1.0 - {alpha}, -pos)"
    running = "OVER (PARTITION BY symbol ORDER BY pos ROWS UNBOUNDED PRECEDING)"
    return f"power(1.0 - {alpha}, pos) * sum(CASE WHEN pos >= {first} THEN {value} * {weight} END) {running}"


EWM1 = f"""deltas AS (SELECT symbol, pos, "close",
    greatest("close" - lag("close") OVER (PARTITION BY symbol ORDER BY pos), 0) AS up,
    greatest(lag("close") OVER (PARTITION BY symbol ORDER BY pos) - "close", 0) AS down FROM l1),
ewm1 AS (SELECT symbol, pos, "close",
    {_ewm('"close"', '(2.0 / 13)', 1)} AS ema12, {_ewm('"close"', '(2.0 / 27)', 1)} AS ema26,
    {_ewm('up', '(1.0 / 14)', 2)} AS avg_gain, {_ewm('down', '(1.0 / 14)', 2)} AS avg_loss
  FROM deltas),
ewm2 AS (SELECT *, (ema12 - ema26) / ("close" + 1e-9) AS macd,
    CASE WHEN pos > 1 THEN 100 - 100 / (1 + avg_gain / (avg_loss + 1e-9)) END AS rsi FROM ewm1)"""
EWM2 = f"""ewm3 AS (SELECT symbol, pos, ema12, ema26, macd, rsi, avg_gain, avg_loss, {_ewm('macd', '(2.0 / 10)', 1)} AS macd_signal FROM ewm2),
l4 AS (SELECT l3.*, e.ema12, e.ema26, e.macd, e.macd_signal, e.rsi
  FROM l3 JOIN ewm3 e ON l3.symbol = e.symbol AND l3.pos = e.pos)"""
RECURSIVE = (*NATIVE, EWM1, EWM2)

ML_SQL = {
    "Returns": "ret", "MA5_Ratio": "ma5_ratio", "MA20_Ratio": "ma20_ratio", "MA60_Ratio": "ma60_ratio",
    "MACD": "macd", "MACD_Signal": "macd_signal", "MACD_Hist": "macd - macd_signal", "RSI14": "rsi",
    "Stoch_K": "stoch_k", "Stoch_D": "stoch_d", "Williams_R": "williams_r", "BB_Width": "bb_width",
    "BB_Position": "bb_position", "ATR14": "atr14", "Volatility": "vol20", "Volume_Change": "volume_change",
    "Volume_MA_Ratio": "vol_ratio20", "OBV_Change": "obv_change", "Momentum_5": "ret_5", "Momentum_20": "ret_20",
}
DL_SQL = {
    "MA5_r": "ma5_ratio", "MA20_r": "ma20_ratio", "MA60_r": "ma60_ratio", "MACD": "macd", "MACD_S": "macd_signal",
    "MACD_H": "macd - macd_signal", "RSI": "rsi", "Stoch_K": "stoch_k", "Stoch_D": "stoch_d",
    "Williams_R": "williams_r", "BB_W": "bb_width", "BB_P": "bb_position", "ATR": "atr14", "Vol20": "vol20",
    "Vol_R": "vol_ratio5", "Vol_MA20_R": "vol_ratio20", "OBV_R": "obv_change", "Ret1": "ret", "Ret5": "ret_5",
    "Mom20": "ret_20",
}
DASH_SQL = {
    "ret": "ret", "log_ret": "log_ret", "ret_5": "ret_5", "ret_20": "ret_20", "ma5": "ma5", "ma20": "ma20",
    "ma60": "ma60", "vol_ratio": "vol_ratio10", "volatility": "volatility5", "ma_cross": "ma_cross",
}


def digits(column: str) -> int:
    """Decimals that leave room for summation order at the column's scale."""
    if column.startswith("ma") and column[2:].isdigit():
        return 4
    return 7 if column in ("RSI14", "RSI", "Stoch_K", "Stoch_D", "Williams_R") else 8


def rounded(mapping: dict[str, str]) -> str:
    return ", ".join(
        f"{src} AS {name}" if name == "ma_cross" else f"round({src}, {digits(name)}) + 0 AS {name}"
        for name, src in mapping.items()
    )


def not_null(mapping: dict[str, str], *more: str) -> str:
    return " AND ".join(f"({src}) IS NOT NULL" for src in [*mapping.values(), *more])


DASH_ROWS = f"""dash AS (SELECT symbol, "date", "close", {', '.join(f'{s} AS {n}' for n, s in DASH_SQL.items())}
  FROM l3 WHERE {not_null(DASH_SQL)})"""
