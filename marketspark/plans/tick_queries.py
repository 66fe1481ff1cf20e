"""Queries over ticks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ticks as op
from ..sources import views
from .registry import TICKS, query, with_ctes

_RUN = """run AS (
  SELECT *, sum(volume) OVER w AS total, count(*) OVER w AS cnt
  FROM ticks WHERE volume > 0
  WINDOW w AS (PARTITION BY symbol ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING))"""
_ALERTS = """alerts AS (
  SELECT event_id, symbol, name, 'HIGH_VOLUME' AS alert_type, CAST(volume AS DOUBLE) AS current_value,
         CAST(total AS DOUBLE) / cnt * 2 AS threshold_value,
         CASE WHEN volume > CAST(total AS DOUBLE) / cnt * 4 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
         CAST(total AS DOUBLE) / cnt AS mean, volume
  FROM run WHERE volume > CAST(total AS DOUBLE) / cnt * 2 AND cnt > 3)"""


def _naive(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def alerts(spark, sf):
    return op.volume_alerts(op.running_volume(views.ticks(spark, sf)))


@query("p1_significant_moves", with_ctes(TICKS, body="""
SELECT event_id, symbol, name, market, price, change_pct, volume,
       CASE WHEN change_pct > 0 THEN 'SURGE' ELSE 'PLUNGE' END AS filter_reason,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS original_event_ts
FROM ticks WHERE abs(change_pct) >= 2.0"""))
def p1(spark, sf):
    return op.significant_moves(views.ticks(spark, sf))


@query("p2_positive_volume", with_ctes(TICKS, body="""
SELECT event_id, symbol, volume FROM ticks WHERE volume > 0"""))
def p2(spark, sf):
    return op.with_volume(views.ticks(spark, sf)).select("event_id", "symbol", "volume")


@query("p3_minimum_severity", with_ctes(TICKS, _RUN, _ALERTS, body="""
SELECT event_id, symbol, severity FROM alerts
WHERE CASE upper(severity) WHEN 'WARNING' THEN 1 WHEN 'CRITICAL' THEN 2 ELSE 0 END >= 1"""))
def p3(spark, sf):
    return op.at_least(alerts(spark, sf), "WARNING").select("event_id", "symbol", "severity")


@query("p4_critical_alerts", with_ctes(TICKS, _RUN, _ALERTS, body="""
SELECT event_id, symbol, current_value, round(threshold_value, 4) AS threshold_value
FROM alerts WHERE severity = 'CRITICAL'"""))
def p4(spark, sf):
    return op.critical(alerts(spark, sf)).select(
        "event_id", "symbol", "current_value", F.round("threshold_value", 4).alias("threshold_value"))


_ANOMALY = """stats AS (
  SELECT time_bucket(INTERVAL '6 hours', event_time) AS window_start, symbol, avg(volume) AS avg_volume,
         stddev_samp(volume) AS sd, max(volume) AS max_volume, count(*) AS sample_count
  FROM ticks GROUP BY 1, 2),
scored AS (
  SELECT *, CASE WHEN sd > 0 THEN (max_volume - avg_volume) / sd ELSE 0 END AS z_score FROM stats)"""


@query("p5_z_score_filter", with_ctes(TICKS, _ANOMALY, body="""
SELECT symbol, count(*) AS windows FROM scored WHERE z_score > 2.0 GROUP BY symbol"""))
def p5(spark, sf):
    return op.volume_anomalies(views.ticks(spark, sf), "6 hours").groupBy("symbol").agg(
        F.count("*").alias("windows"))


@query("a1_sliding_ohlcv", with_ctes(TICKS, """slots AS (
  SELECT t.*, time_bucket(INTERVAL '1 minute', event_time) - to_minutes(CAST(i AS BIGINT)) AS window_start
  FROM ticks t, range(5) r(i))""", body="""
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, symbol, name, market,
       arg_min(price, {'a': event_time, 'b': event_id}) AS open, max(high) AS high, min(low) AS low,
       arg_max(price, {'a': event_time, 'b': event_id}) AS "close", CAST(sum(volume) AS BIGINT) AS volume,
       round(avg(change_pct), 6) + 0 AS avg_change_pct, count(*) AS event_count
FROM slots GROUP BY window_start, symbol, name, market"""))
def a1(spark, sf):
    bars = op.window_bars(views.ticks(spark, sf), "5 minutes", "1 minute")
    return _naive(bars, "window_start", "window_end").withColumn(
        "avg_change_pct", F.round("avg_change_pct", 6))


@query("a2_volume_anomaly", with_ctes(TICKS, _ANOMALY, body="""
SELECT window_start, symbol, round(avg_volume, 4) AS avg_volume, max_volume,
       round(z_score, 6) AS z_score, sample_count FROM scored WHERE z_score > 2.0"""))
def a2(spark, sf):
    found = op.volume_anomalies(views.ticks(spark, sf), "6 hours")
    return _naive(found, "window_start").withColumns(
        {"avg_volume": F.round("avg_volume", 4), "z_score": F.round("z_score", 6)})


@query("a2_ten_minute_anomaly", with_ctes(TICKS, _ANOMALY.replace("6 hours", "10 minutes"), body="""
SELECT window_start, symbol, round(avg_volume, 4) AS avg_volume, max_volume,
       round(z_score, 6) AS z_score, sample_count FROM scored WHERE z_score > 0.7"""))
def a2_ten_minutes(spark, sf):
    """The operator's own window; sparse ticks need a lower bound than 2 to show any."""
    found = op.volume_anomalies(views.ticks(spark, sf), z=0.7)
    return _naive(found, "window_start").withColumns({"avg_volume": F.round("avg_volume", 4), "z_score": F.round("z_score", 6)})


def _tumbling(interval):
    return with_ctes(TICKS, body=f"""
SELECT time_bucket(INTERVAL '{interval}', event_time) AS window_start,
       time_bucket(INTERVAL '{interval}', event_time) + INTERVAL '{interval}' AS window_end,
       symbol, name, market, arg_min(price, {{'a': event_time, 'b': event_id}}) AS open,
       max(price) AS high, min(price) AS low, arg_max(price, {{'a': event_time, 'b': event_id}}) AS "close",
       CAST(sum(volume) AS BIGINT) AS volume, round(avg(change_pct), 4) + 0 AS avg_change_pct,
       count(*) AS event_count
FROM ticks GROUP BY 1, 2, 3, 4, 5""")


@query("a3_minute_ohlcv", _tumbling("1 minute"))
def a3(spark, sf):
    return _naive(op.minute_bars(views.ticks(spark, sf)), "window_start", "window_end")


@query("a4_running_volume_alerts", with_ctes(TICKS, _RUN, _ALERTS, body="""
SELECT event_id, symbol, name, alert_type, current_value, round(threshold_value, 4) AS threshold_value,
       severity FROM alerts"""))
def a4(spark, sf):
    return alerts(spark, sf).select(
        "event_id", "symbol", "name", "alert_type", "current_value",
        F.round("threshold_value", 4).alias("threshold_value"), "severity")


@query("f14_alert_message", with_ctes(TICKS, _RUN, _ALERTS, body="""
SELECT event_id, name || '(' || symbol || ') 거래량 급증: ' || format('{:,}', volume) || ' (평균 '
       || format('{:,.0f}', mean) || '의 ' || format('{:,.1f}', volume / mean) || '배)' AS message
FROM alerts"""))
def f14(spark, sf):
    return alerts(spark, sf).select("event_id", "message")


@query("f8_minute_truncation", with_ctes(TICKS, body="""
SELECT event_id, date_trunc('minute', event_time) AS minute FROM ticks"""))
def f8(spark, sf):
    from ..functions.dates import minute_start

    return _naive(views.ticks(spark, sf).select(
        "event_id", minute_start(F.col("event_time")).alias("minute")), "minute")
