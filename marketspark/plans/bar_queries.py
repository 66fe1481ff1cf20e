"""Queries over daily bars: indicators, feature frames, labels, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rolling import change
from ..operators import indicators as ind
from ..operators import labels as lab
from ..schemas import DASH, DL20, ML20
from ..sources import views
from .bar_sql import (
    DASH_ROWS, DASH_SQL, DL_SQL, EWM1, EWM2, LAYER1, ML_SQL, NATIVE, RECURSIVE, W, digits, not_null, rounded,
)
from .registry import BARS, query, with_ctes


def rounds(df, *columns):
    return df.withColumns({c: F.round(c, digits(c)) for c in columns if c != "ma_cross"})


def _native(name, columns: dict[str, tuple[str, int]]):
    """Register selected columns of the native layer, incomplete rows kept."""
    body = ", ".join(f"round({src}, {d}) + 0 AS {c}" for c, (src, d) in columns.items())

    @query(name, with_ctes(*NATIVE, body=f'SELECT symbol, "date", {body} FROM l3'))
    def run(spark, sf):
        rows = ind.native_indicators(views.daily_bars(spark, sf))
        return rows.select("symbol", "date", *[F.round(F.expr(src), d).alias(c) for c, (src, d) in columns.items()])

    return run


@query("x3_moving_averages", with_ctes(BARS, LAYER1, body="""
SELECT symbol, "date", "close", round(ret, 8) + 0 AS ret, round(ma5, 4) AS ma5, round(ma20, 4) AS ma20,
       round(ma60, 4) AS ma60 FROM l1"""))
def x3(spark, sf):
    rows = ind.moving_averages(views.daily_bars(spark, sf), 5, 20, 60)
    return rows.select(
        "symbol", "date", "close", F.round(change(F.col("close")), 8).alias("ret"),
        *[F.round(c, 4).alias(c) for c in ("ma5", "ma20", "ma60")])


_native("x1_simple_returns", {"ret": ("ret", 8), "ret_5": ("ret_5", 8), "ret_20": ("ret_20", 8)})
_native("x2_log_return", {"log_ret": ("log_ret", 8)})
_native("x4_price_to_average", {"ma5_ratio": ("ma5_ratio", 8), "ma20_ratio": ("ma20_ratio", 8), "ma60_ratio": ("ma60_ratio", 8)})
_native("x9_low_high_14", {"low14": ("low14", 4), "high14": ("high14", 4)})
_native("x10_stochastic", {"stoch_k": ("stoch_k", 7), "stoch_d": ("stoch_d", 7)})
_native("x11_williams_r", {"williams_r": ("williams_r", 7)})
_native("x12_bollinger", {"bb_width": ("bb_width", 8), "bb_position": ("bb_position", 8)})
_native("x13_true_range", {"tr": ("tr", 4)})
_native("x14_average_true_range", {"atr14": ("atr14", 8)})
_native("x15_volatility", {"vol20": ("vol20", 8), "volatility5": ("volatility5", 8)})
_native("x16_volume_change", {"volume_change": ("volume_change", 8)})
_native("x17_volume_ratio", {"vol_ratio5": ("vol_ratio5", 8), "vol_ratio10": ("vol_ratio10", 8), "vol_ratio20": ("vol_ratio20", 8)})
_native("x18_on_balance_volume", {"obv": ("CAST(obv AS DOUBLE)", 2)})
_native("x19_obv_change", {"obv_change": ("obv_change", 8)})
_native("x20_ma_cross", {"ma_cross": ("ma_cross", 0)})


@query("x21_missing_column_defaults", with_ctes(BARS, body="""
SELECT symbol, "date", "close", "close" AS high, "close" AS low, CAST(1 AS DOUBLE) AS volume FROM bars"""))
def x21(spark, sf):
    return ind.ohlcv_defaults(views.daily_bars(spark, sf).select("symbol", "date", "close"))


def _ewm(name, sql_columns, pick):
    """Register smoothed columns for every bar."""
    body = ", ".join(f"round({src}, {d}) + 0 AS {c}" for c, (src, d) in sql_columns.items())

    @query(name, with_ctes(BARS, LAYER1, EWM1, EWM2.split(",\nl4")[0], body=f"""
SELECT l1.symbol, l1."date", {body} FROM l1 JOIN ewm3 e ON l1.symbol = e.symbol AND l1.pos = e.pos"""))
    def run(spark, sf):
        bars = views.daily_bars(spark, sf).select("symbol", "date", "close")
        rows = ind.with_ewm(bars)
        return rows.select("symbol", "date", *[
            F.round(expr, sql_columns[c][1]).alias(c) for c, expr in pick().items()])

    return run


_ewm("x5_exponential_averages", {"ema12": ("ema12", 4), "ema26": ("ema26", 4)},
     lambda: {"ema12": F.col("ema12"), "ema26": F.col("ema26")})
_ewm("x6_macd", {"macd": ("macd", 8)}, lambda: {"macd": F.col("macd")})
_ewm("x7_macd_signal", {"macd_signal": ("macd_signal", 8), "macd_hist": ("macd - macd_signal", 8)},
     lambda: {"macd_signal": F.col("macd_signal"), "macd_hist": F.col("macd") - F.col("macd_signal")})
_ewm("y1_smoothing_kernel", {"gain_share": ('avg_gain / "close"', 8), "loss_share": ('avg_loss / "close"', 8), "macd": ("macd", 8)},
     lambda: {"gain_share": F.col("avg_gain") / F.col("close"), "loss_share": F.col("avg_loss") / F.col("close"), "macd": F.col("macd")})
_ewm("x8_rsi", {"rsi": ("rsi", 7)}, lambda: {"rsi": ind.rsi()})


def _frame(name, profile, columns, mapping, ctes, last):
    @query(name, with_ctes(*ctes, body=f"""
SELECT symbol, "date", "close", {rounded(mapping)} FROM {last} WHERE {not_null(mapping)}"""))
    def run(spark, sf):
        return rounds(ind.feature_frame(views.daily_bars(spark, sf), profile), *columns)

    return run


_frame("x22_ml_feature_frame", "ml20", ML20, ML_SQL, RECURSIVE, "l4")
_frame("x23_dl_feature_frame", "dl20", DL20, DL_SQL, RECURSIVE, "l4")
_frame("x24_dashboard_frame", "dash", DASH, DASH_SQL, NATIVE, "l3")

_FWD = f"""fwd AS (SELECT *, lead("close", 5) OVER ({W}) / "close" - 1 AS ahead FROM bars),
labelled AS (SELECT *, CASE WHEN ahead > 0.01 THEN 1 WHEN ahead < -0.01 THEN -1 ELSE 0 END AS label
  FROM fwd WHERE ahead IS NOT NULL)"""


@query("x25_forward_label", with_ctes(BARS, _FWD, body="""
SELECT symbol, "date", label FROM labelled"""))
def x25(spark, sf):
    return views.daily_bars(spark, sf).select("symbol", "date", lab.direction().alias("label")).filter(
        "label is not null")


@query("x26_text_label", with_ctes(BARS, _FWD, body="""
SELECT symbol, "date", CASE label WHEN 1 THEN 'BUY' WHEN -1 THEN 'SELL' ELSE 'HOLD' END AS signal FROM labelled"""))
def x26(spark, sf):
    return views.daily_bars(spark, sf).select("symbol", "date", lab.direction_text().alias("signal")).filter(
        "signal is not null")


@query("a22_label_distribution", with_ctes(BARS, _FWD, body="""
SELECT CASE label WHEN 1 THEN 'BUY' WHEN -1 THEN 'SELL' ELSE 'HOLD' END AS signal, count(*) AS n
FROM labelled GROUP BY 1"""))
def a22(spark, sf):
    return x26(spark, sf).groupBy("signal").agg(F.count("*").alias("n"))


@query("x27_next_day_up", with_ctes(BARS, body=f"""
SELECT symbol, "date", CAST(lead("close") OVER ({W}) > "close" AS INTEGER) AS up FROM bars
QUALIFY lead("close") OVER ({W}) IS NOT NULL"""))
def x27(spark, sf):
    return views.daily_bars(spark, sf).select("symbol", "date", lab.next_day_up().alias("up")).filter(
        "up is not null")


@query("x28_next_return_up", with_ctes(BARS, LAYER1, body=f"""
SELECT * FROM (SELECT symbol, "date", CAST(lead(ret) OVER ({W}) > 0 AS INTEGER) AS up FROM l1) WHERE up IS NOT NULL"""))
def x28(spark, sf):
    rows = views.daily_bars(spark, sf).withColumn("ret", change(F.col("close")))
    return rows.select("symbol", "date", lab.next_return_up(F.col("ret")).alias("up")).filter("up is not null")


_RANKED = f"""ranked AS (SELECT symbol, "date", row_number() OVER ({W}) AS rn,
  count(*) OVER (PARTITION BY symbol) AS n_rows FROM (
    SELECT *, lead("close", 5) OVER ({W}) AS ahead FROM l3) WHERE {not_null(DASH_SQL, 'ahead')})"""


def _ranked(spark, sf):
    return ind.feature_frame(
        views.daily_bars(spark, sf), "dash", targets={"label": lab.direction()}, rank=True)


@query("x30_ordered_split", with_ctes(*NATIVE, _RANKED, body="""
SELECT symbol, "date", CASE WHEN rn <= floor(CAST(n_rows AS DOUBLE) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
FROM ranked"""))
def x30(spark, sf):
    return lab.ordered_split(_ranked(spark, sf)).select("symbol", "date", "split")


@query("x31_walk_forward_folds", with_ctes(*NATIVE, _RANKED, """
placed AS (SELECT symbol, "date", fold, rn - 1 AS p, n_rows // 6 AS size,
  n_rows - (n_rows // 6) * (5 - fold + 1) AS start FROM ranked, range(1, 6) f(fold))""", body="""
SELECT symbol, "date", CAST(fold AS INTEGER) AS fold,
       CASE WHEN p < start - 5 THEN 'train' ELSE 'test' END AS role
FROM placed WHERE p < start - 5 OR (p >= start AND p < start + size)"""))
def x31(spark, sf):
    return lab.walk_forward(_ranked(spark, sf)).select("symbol", "date", "fold", "role")


@query("p8_drop_null_rows", with_ctes(*NATIVE, DASH_ROWS, body="""
SELECT symbol, count(*) AS n FROM dash GROUP BY symbol"""))
def p8(spark, sf):
    rows = ind.native_indicators(views.daily_bars(spark, sf))
    wanted = ["ret", "log_ret", "ret_5", "ret_20", "ma5", "ma20", "ma60", "vol_ratio10", "volatility5", "ma_cross"]
    return rows.na.drop(subset=wanted).groupBy("symbol").agg(F.count("*").alias("n"))


def _latest(name):
    @query(name, with_ctes(*RECURSIVE, body=f"""
SELECT symbol, "date", "close", {rounded(ML_SQL)} FROM l4 WHERE {not_null(ML_SQL)}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) = 1"""))
    def run(spark, sf):
        return rounds(ind.latest_features(views.daily_bars(spark, sf)), *ML20)

    return run


_latest("m27_latest_feature_vector")


@query("f22_feature_csv_line", with_ctes(*RECURSIVE, body=f"""
SELECT symbol, concat_ws(',', {', '.join(f"printf('%.6f', {src} + 0)" for src in ML_SQL.values())}) AS line
FROM l4 WHERE {not_null(ML_SQL)}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) = 1"""))
def f22(spark, sf):
    from ..functions.serving import csv_line

    return ind.latest_features(views.daily_bars(spark, sf)).select("symbol", csv_line(ML20, 6).alias("line"))


_TRAINING_SQL = f"""training AS (SELECT *, row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY symbol) AS n_rows
  FROM (SELECT *, lead("close", 5) OVER ({W}) / "close" - 1 AS ahead FROM l4)
  WHERE {not_null(ML_SQL, 'ahead')})"""
TRAINING = (*RECURSIVE, _TRAINING_SQL)
TRAINING_COLUMNS = f"""symbol, "date", {rounded(ML_SQL)},
  CASE WHEN ahead > 0.01 THEN 'BUY' WHEN ahead < -0.01 THEN 'SELL' ELSE 'HOLD' END AS "Signal",
  CASE WHEN rn <= floor(CAST(n_rows AS DOUBLE) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split"""


def training_set(spark, sf):
    ranked = ind.feature_frame(
        views.daily_bars(spark, sf), "ml20", targets={"Signal": lab.direction_text()}, rank=True)
    return lab.ordered_split(ranked).select("symbol", "date", *ML20, "Signal", "split")


@query("m28_training_set", with_ctes(*TRAINING, body=f"SELECT {TRAINING_COLUMNS} FROM training"))
def m28(spark, sf):
    return rounds(training_set(spark, sf), *ML20)


@query("j8_features_with_labels", with_ctes(*TRAINING, body="""
SELECT symbol, count(*) AS n, sum(CASE WHEN ahead > 0.01 THEN 1 WHEN ahead < -0.01 THEN -1 ELSE 0 END)::BIGINT AS label_sum,
       round(avg(ret), 8) + 0 AS mean_ret FROM training GROUP BY symbol"""))
def j8(spark, sf):
    rows = ind.feature_frame(views.daily_bars(spark, sf), "ml20", targets={"label": lab.direction()})
    return rows.groupBy("symbol").agg(
        F.count("*").alias("n"), F.sum("label").alias("label_sum"),
        F.round(F.avg("Returns"), 8).alias("mean_ret"))


@query("p10_feature_contract", with_ctes(*RECURSIVE, body=f"""
SELECT column_name, pos, n FROM (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(ML20))}) c(column_name, pos),
  (SELECT count(*) AS n FROM l4 WHERE {not_null(ML_SQL)}) t"""))
def p10(spark, sf):
    rows = ind.feature_frame(views.daily_bars(spark, sf), "ml20")
    names = [c for c in rows.columns if c not in ("symbol", "date", "close")]
    counted = rows.agg(F.count("*").alias("n"))
    return counted.select(
        F.posexplode(F.array(*[F.lit(c) for c in names])).alias("pos", "column_name"), "n")
