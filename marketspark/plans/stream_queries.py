"""Streaming queries: each runs its stream until the input is used up and
returns what reached the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ticks as op
from ..runtime import shared_dir
from ..sources import views, writers
from ..schemas import ALERT, FILTERED, WINDOW_BAR
from ..schemas import MACRO as MACRO_SCHEMA
from ..streaming import jobs, sinks, sources, state
from . import payloads
from .registry import MACRO, TICKS, query, with_ctes
from .tick_queries import _ALERTS, _RUN, _naive

_CLOSED = "(SELECT max(event_time) - INTERVAL '2 minutes' FROM ticks)"
_BAR = """symbol, arg_min(price, {'a': event_time, 'b': event_id}) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, {'a': event_time, 'b': event_id}) AS "close", CAST(sum(volume) AS BIGINT) AS volume, count(*) AS event_count"""
_FIELD_BAR = _BAR.replace("max(price)", "max(high)").replace("min(price)", "min(low)")
_BAR_COLUMNS = ["symbol", "open", "high", "low", "close", "volume", "event_count"]


def _session(spark):
    return sources.state_session(spark, spark.sparkContext.defaultParallelism)


def _tick_stream(session, sf):
    events = sources.table_stream(session, f"{sf}/events.parquet", sources.EVENT_SCHEMA)
    return sources.with_event_time(views.ticks_from_events(events))


def _done(*queries):
    for q in queries:
        q.awaitTermination()


def _minute_sql(source="ticks", closed=True):
    having = f"HAVING time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' <= {_CLOSED}" if closed else ""
    return f"SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start, {_BAR} FROM {source} GROUP BY 1, 2 {having}"


@query("s1_tick_stream", with_ctes(TICKS, body="""
SELECT symbol, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM ticks GROUP BY symbol"""))
def s1(spark, sf):
    out = shared_dir(spark, "s1")
    _done(sinks.to_files(_tick_stream(spark, sf), f"{out}/rows", f"{out}/cp", once=True))
    return spark.read.parquet(f"{out}/rows").groupBy("symbol").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


_MID = "TIMESTAMP '2024-01-16 00:00:00'"


def _publish_ticks(spark, sf, path, condition):
    rows = views.ticks(spark, sf).filter(condition).withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    columns = ["symbol", "name", "market", "price", "open", "high", "low", "close", "volume", "change_pct", "timestamp"]
    writers.publish(rows.select(*columns), "symbol", "stock.raw.prices", fmt="parquet", path=path)


def _land(spark, topic, out, checkpoint):
    stream = sources.file_stream(spark, topic, sources.MESSAGE_SCHEMA)
    ticks = sources.parse_ticks(stream)
    _done(sinks.to_store(ticks.select("symbol", "event_time", "price", "volume"), out, checkpoint, once=True))


@query("s2_incremental_batch", with_ctes(TICKS, body=f"""
SELECT CAST(CASE WHEN event_time < {_MID} THEN 0 ELSE 1 END AS INTEGER) AS run, symbol, count(*) AS n FROM ticks GROUP BY 1, 2"""))
def s2(spark, sf):
    out = shared_dir(spark, "s2")
    for half in ("event_time < '2024-01-16'", "event_time >= '2024-01-16'"):
        _publish_ticks(spark, sf, f"{out}/topic", half)
        _land(spark, f"{out}/topic", f"{out}/rows", f"{out}/cp")
    stored = spark.read.parquet(f"{out}/rows")
    return stored.groupBy(F.col("batch").cast("int").alias("run"), "symbol").agg(F.count("*").alias("n"))


@query("s5_replay_from_beginning", with_ctes(TICKS, body="""
SELECT reader, symbol, count(*) AS n FROM ticks, (VALUES ('committed'), ('replay')) r(reader) GROUP BY 1, 2"""))
def s5(spark, sf):
    """A second run on the old checkpoint adds nothing; a new checkpoint starts over."""
    out = shared_dir(spark, "s5")
    _publish_ticks(spark, sf, f"{out}/topic", F.lit(True))
    _land(spark, f"{out}/topic", f"{out}/committed", f"{out}/cp")
    _land(spark, f"{out}/topic", f"{out}/committed", f"{out}/cp")
    _land(spark, f"{out}/topic", f"{out}/replay", f"{out}/cp-new")
    parts = [spark.read.parquet(f"{out}/{r}").withColumn("reader", F.lit(r)) for r in ("committed", "replay")]
    return parts[0].unionByName(parts[1]).groupBy("reader", "symbol").agg(F.count("*").alias("n"))


@query("g9_consumer_groups", with_ctes(TICKS, body="""
SELECT reader, count(*) AS n FROM ticks, (VALUES ('analytics'), ('alerts')) r(reader) GROUP BY 1"""))
def g9(spark, sf):
    out = shared_dir(spark, "g9")
    groups = ("analytics", "alerts")
    _done(*[sinks.to_files(_tick_stream(spark, sf), f"{out}/{g}", f"{out}/cp-{g}", once=True) for g in groups])
    parts = [spark.read.parquet(f"{out}/{g}").select(F.lit(g).alias("reader")) for g in groups]
    return parts[0].unionByName(parts[1]).groupBy("reader").agg(F.count("*").alias("n"))


@query("k4_keyed_publish", with_ctes(TICKS, body="""
SELECT symbol AS key, 'stock.raw.prices' AS topic, count(*) AS sent, CAST(sum(volume) AS BIGINT) AS volume FROM ticks GROUP BY 1"""))
def k4(spark, sf):
    out = shared_dir(spark, "k4")
    _publish_ticks(spark, sf, out, F.lit(True))
    rows = spark.read.parquet(out)
    return rows.groupBy("key", "topic").agg(
        F.count("*").alias("sent"), F.sum(F.get_json_object("value", "$.volume").cast("bigint")).alias("volume"))


@query("k11_micro_batch_store", with_ctes(TICKS, body="""
SELECT symbol, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM ticks GROUP BY symbol"""))
def k11(spark, sf):
    out = shared_dir(spark, "k11")
    _done(sinks.to_store(_tick_stream(spark, sf), f"{out}/rows", f"{out}/cp", once=True))
    return spark.read.parquet(f"{out}/rows").groupBy("symbol").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query("k1_named_update_query", with_ctes(TICKS, body="""
SELECT 'watch' AS query, time_bucket(INTERVAL '6 hours', event_time) AS window_start, symbol, count(*) AS event_count,
       CAST(sum(volume) AS BIGINT) AS volume FROM ticks GROUP BY 2, 3"""))
def k1(spark, sf):
    """What a named query in update mode has sent, in its newest version."""
    out = shared_dir(spark, "k1")
    bars = op.window_bars(_tick_stream(_session(spark), sf), "6 hours")
    q = sinks.to_store(bars, f"{out}/rows", f"{out}/cp", mode="update", once=True, name="watch")
    _done(q)
    rows = sinks.newest_version(spark.read.parquet(f"{out}/rows"), ["window_start", "symbol"])
    return _naive(rows, "window_start").select(F.lit(q.name).alias("query"), "window_start", "symbol", "event_count", "volume")


_SLIDING = with_ctes(TICKS, """slots AS (
  SELECT t.*, time_bucket(INTERVAL '1 minute', event_time) - to_minutes(CAST(i AS BIGINT)) AS window_start
  FROM ticks t, range(5) r(i))""", body=f"""
SELECT window_start, {_FIELD_BAR} FROM slots GROUP BY window_start, symbol HAVING window_start + INTERVAL '5 minutes' <= {_CLOSED}""")


def _files(spark, df, out):
    _done(sinks.to_files(df, f"{out}/rows", f"{out}/cp", once=True))
    return spark.read.parquet(f"{out}/rows")


@query("g2_sliding_window_stream", _SLIDING)
def g2(spark, sf):
    bars = op.window_bars(_tick_stream(_session(spark), sf), "5 minutes", "1 minute")
    return _naive(_files(spark, bars, shared_dir(spark, "g2")), "window_start").select("window_start", *_BAR_COLUMNS)


@query("k2_parquet_append_sink", with_ctes(TICKS, body=_minute_sql()))
def k2(spark, sf):
    bars = op.minute_bars(_tick_stream(_session(spark), sf))
    return _naive(_files(spark, bars, shared_dir(spark, "k2")), "window_start").select("window_start", *_BAR_COLUMNS)


@query("g3_tumbling_window_stream", with_ctes(TICKS, """stats AS (
  SELECT time_bucket(INTERVAL '6 hours', event_time) AS window_start, symbol, avg(volume) AS avg_volume,
         stddev_samp(volume) AS sd, max(volume) AS max_volume, count(*) AS sample_count FROM ticks GROUP BY 1, 2)""", body=f"""
SELECT window_start, symbol, max_volume, sample_count FROM stats
WHERE sd > 0 AND (max_volume - avg_volume) / sd > 2 AND window_start + INTERVAL '6 hours' <= {_CLOSED}"""))
def g3(spark, sf):
    found = op.volume_anomalies(_tick_stream(_session(spark), sf), "6 hours")
    return _naive(_files(spark, found, shared_dir(spark, "g3")), "window_start").select(
        "window_start", "symbol", "max_volume", "sample_count")


@query("g1_event_time_watermark", with_ctes(TICKS, body=f"""
SELECT symbol, count(*) AS windows FROM (SELECT symbol, time_bucket(INTERVAL '10 minutes', event_time) AS w FROM ticks GROUP BY 1, 2)
WHERE w + INTERVAL '10 minutes' <= {_CLOSED} GROUP BY symbol"""))
def g1(spark, sf):
    out = shared_dir(spark, "g1")
    _publish_ticks(spark, sf, f"{out}/topic", F.lit(True))
    stream = sources.parse_ticks(sources.file_stream(_session(spark), f"{out}/topic", sources.MESSAGE_SCHEMA))
    closed = stream.groupBy(F.window("event_time", "10 minutes"), "symbol").agg(F.count("*").alias("n"))
    return _files(spark, closed, out).groupBy("symbol").agg(F.count("*").alias("windows"))


_TOTALS = with_ctes(TICKS, body="""
SELECT symbol, CAST(sum(volume) AS BIGINT) AS total, count(*) AS "count" FROM ticks WHERE volume > 0 GROUP BY symbol""")


def _two_runs(spark, sf, out, start):
    """Deliver the ticks in two halves to the same checkpoint."""
    for half in ("ts < '2024-01-16'", "ts >= '2024-01-16'"):
        views.table(spark, sf, "events").filter(half).write.mode("append").parquet(f"{out}/in")
        events = sources.file_stream(_session(spark), f"{out}/in", sources.EVENT_SCHEMA)
        _done(start(sources.with_event_time(views.ticks_from_events(events))))


@query("g4_keyed_running_state", _TOTALS)
def g4(spark, sf):
    out = shared_dir(spark, "g4")
    _two_runs(spark, sf, out, lambda t: sinks.to_store(
        state.volume_totals(t), f"{out}/rows", f"{out}/cp", mode="update", once=True))
    return sinks.newest_version(spark.read.parquet(f"{out}/rows"), ["symbol"])


@query("y3_stateful_function", _TOTALS)
def y3(spark, sf):
    out = shared_dir(spark, "y3")
    _two_runs(spark, sf, out, lambda t: sinks.to_store(
        state.volume_state(t), f"{out}/rows", f"{out}/cp", mode="update", once=True))
    return sinks.newest_version(spark.read.parquet(f"{out}/rows"), ["symbol"])


@query("a4_alert_stream", with_ctes(TICKS, _RUN, _ALERTS, body="""
SELECT event_id, symbol, round(threshold_value, 4) AS threshold_value, severity FROM alerts"""))
def a4_stream(spark, sf):
    out = shared_dir(spark, "a4s")
    _two_runs(spark, sf, out, lambda t: state.alert_stream(t, f"{out}/v", f"{out}/cp", once=True))
    return spark.read.parquet(f"{out}/v/alerts").select(
        "event_id", "symbol", F.round("threshold_value", 4).alias("threshold_value"), "severity")


@query("g5_window_close", with_ctes(TICKS, body=_minute_sql()))
def g5(spark, sf):
    """A window left open by the first run is closed, once, by the second."""
    out = shared_dir(spark, "g5")
    _two_runs(spark, sf, out, lambda t: sinks.to_files(op.minute_bars(t), f"{out}/rows", f"{out}/cp", once=True))
    return _naive(spark.read.parquet(f"{out}/rows"), "window_start").select("window_start", *_BAR_COLUMNS)


@query("g10_restart_exactly_once", with_ctes(TICKS, body="SELECT event_id, count(*) AS copies FROM ticks GROUP BY 1"))
def g10(spark, sf):
    out = shared_dir(spark, "g10")
    _two_runs(spark, sf, out, lambda t: sinks.to_files(t.select("event_id", "symbol"), f"{out}/rows", f"{out}/cp", once=True))
    return spark.read.parquet(f"{out}/rows").groupBy("event_id").agg(F.count("*").alias("copies"))


@query("g6_update_mode", with_ctes(TICKS, body=_minute_sql(closed=False)))
def g6(spark, sf):
    """Update mode re-sends changed windows; the newest version of each is the
    full result, windows still open included."""
    out = shared_dir(spark, "g6")
    _two_runs(spark, sf, out, lambda t: sinks.to_store(
        op.minute_bars(t), f"{out}/rows", f"{out}/cp", mode="update", once=True))
    rows = sinks.newest_version(spark.read.parquet(f"{out}/rows"), ["window_start", "symbol"])
    return _naive(rows, "window_start").select("window_start", *_BAR_COLUMNS)


@query("g7_triggers", with_ctes(TICKS, body="""
SELECT "trigger", count(*) AS n FROM ticks, (VALUES ('available now'), ('processing time')) r("trigger") GROUP BY 1"""))
def g7(spark, sf):
    out = shared_dir(spark, "g7")
    _done(sinks.to_files(_tick_stream(spark, sf), f"{out}/once", f"{out}/cp1", once=True))
    q = sinks.to_files(_tick_stream(spark, sf), f"{out}/timed", f"{out}/cp2", trigger="1 second")
    q.processAllAvailable()
    q.stop()
    parts = [spark.read.parquet(f"{out}/{p}").select(F.lit(t).alias("trigger")) for p, t in
             (("once", "available now"), ("timed", "processing time"))]
    return parts[0].unionByName(parts[1]).groupBy("trigger").agg(F.count("*").alias("n"))


@query("g8_several_queries", with_ctes(TICKS, """slots AS (
  SELECT t.*, time_bucket(INTERVAL '1 minute', event_time) - to_minutes(CAST(i AS BIGINT)) AS window_start
  FROM ticks t, range(5) r(i)),
stats AS (SELECT time_bucket(INTERVAL '6 hours', event_time) AS w, symbol, (max(volume) - avg(volume)) / stddev_samp(volume) AS z
  FROM ticks GROUP BY 1, 2)""", body=f"""
SELECT 'bars' AS output, count(*) AS n FROM (SELECT DISTINCT window_start, symbol FROM slots) WHERE window_start + INTERVAL '5 minutes' <= {_CLOSED}
UNION ALL SELECT 'anomalies', count(*) FROM stats WHERE z > 2 AND w + INTERVAL '6 hours' <= {_CLOSED}"""))
def g8(spark, sf):
    out = shared_dir(spark, "g8")
    _done(*jobs.bars_and_anomalies(_tick_stream(_session(spark), sf), out, f"{out}/cp", once=True, anomaly_window="6 hours"))
    return _counts(spark, {"bars": f"{out}/bars", "anomalies": f"{out}/anomalies"})


def _counts(spark, outputs):
    parts = [spark.read.parquet(path).agg(F.count("*").alias("n")).withColumn("output", F.lit(name)) for name, path in outputs.items()]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


@query("k12_fan_out", with_ctes(TICKS, _RUN, _ALERTS, body=f"""
SELECT 'stock.filtered.significant' AS output, symbol AS key, count(*) AS n, round(sum(price), 2) AS total FROM ticks WHERE abs(change_pct) >= 2 GROUP BY 2
UNION ALL SELECT 'stock.alerts.high-volume', symbol, count(*), round(sum(current_value), 2) FROM alerts GROUP BY 2
UNION ALL SELECT 'stock.aggregated.ohlcv', symbol, count(*), round(sum(high - low), 2) FROM ({_minute_sql()}) GROUP BY 2"""))
def k12(spark, sf):
    out = shared_dir(spark, "k12")
    _done(*jobs.fan_out(_tick_stream(_session(spark), sf), out, f"{out}/cp", once=True))

    def messages(path, schema, value):
        rows = spark.read.parquet(path).select("topic", "key", F.from_json("value", schema).alias("m"))
        return rows.groupBy(F.col("topic").alias("output"), "key").agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total"))

    alerts = messages(f"{out}/volume/messages", ALERT, F.col("m.current_value"))
    filtered = messages(f"{out}/filtered", FILTERED, F.col("m.price"))
    return filtered.unionByName(alerts).unionByName(messages(f"{out}/bars", WINDOW_BAR, F.col("m.high") - F.col("m.low")))


@query("g13_downstream_tap", with_ctes(TICKS, body="""
SELECT CASE WHEN change_pct > 0 THEN 'SURGE' ELSE 'PLUNGE' END AS filter_reason, symbol, count(*) AS n
FROM ticks WHERE abs(change_pct) >= 2 GROUP BY 1, 2"""))
def g13(spark, sf):
    out = shared_dir(spark, "g13")
    filtered = op.significant_moves(_tick_stream(spark, sf))
    _done(sinks.to_files(filtered, f"{out}/filtered", f"{out}/cp1", once=True))
    schema = "event_id bigint, symbol string, change_pct double, price double, filter_reason string"
    tap = sources.file_stream(spark, f"{out}/filtered", schema)
    _done(sinks.to_files(tap, f"{out}/tap", f"{out}/cp2", once=True))
    return spark.read.parquet(f"{out}/tap").groupBy("filter_reason", "symbol").agg(F.count("*").alias("n"))


_LATE = "event_id % 10 = 0 AND event_time < TIMESTAMP '2024-01-10 00:00:00'"


@query("g11_late_data", with_ctes(TICKS, f"ontime AS (SELECT * FROM ticks WHERE NOT ({_LATE}))", body=_minute_sql("ontime")))
def g11(spark, sf):
    """Ticks held back until the watermark has passed them never reach a window."""
    out = shared_dir(spark, "g11")
    late = "event_id % 10 = 0 and ts < timestamp_ntz'2024-01-10 00:00:00'"
    for part in (f"not ({late})", late):
        views.table(spark, sf, "events").filter(part).write.mode("append").parquet(f"{out}/in")
        events = sources.file_stream(_session(spark), f"{out}/in", sources.EVENT_SCHEMA)
        ticks = sources.with_event_time(views.ticks_from_events(events))
        _done(sinks.to_files(op.minute_bars(ticks), f"{out}/rows", f"{out}/cp", once=True))
    return _naive(spark.read.parquet(f"{out}/rows"), "window_start").select("window_start", *_BAR_COLUMNS)


@query("k3_bronze_stream", with_ctes(MACRO, body='SELECT stat_code, cycle, "time", value FROM macro'))
def k3_stream(spark, sf):
    out = shared_dir(spark, "k3s")
    writers.publish(views.macro(spark, sf), "stat_code", "public.ecos.macro", fmt="parquet", path=f"{out}/topic")
    topic = sources.file_stream(spark, f"{out}/topic", sources.MESSAGE_SCHEMA)
    _done(sinks.to_bronze(topic, MACRO_SCHEMA, f"{out}/table", f"{out}/cp", ("stat_code",)))
    return spark.read.parquet(f"{out}/table").select("stat_code", "cycle", "time", "value")


@query("g12_dead_letter_stream", with_ctes(TICKS, body="""
SELECT coalesce(CASE event_id % 50 WHEN 7 THEN 'malformed' WHEN 8 THEN 'unknown field' WHEN 9 THEN 'wrong type' WHEN 10 THEN 'no key' WHEN 11 THEN 'no time' END, 'good') AS verdict,
       symbol AS key, count(*) AS n, count(DISTINCT event_id) AS messages FROM ticks GROUP BY 1, 2"""))
def g12_stream(spark, sf):
    """Two runs over a topic with five kinds of bad messages: what is decoded and what is kept aside are all of it, once."""
    out = shared_dir(spark, "g12s")
    schema = "key string, value string, partition int, offset bigint"
    for half in ("event_time < '2024-01-16'", "event_time >= '2024-01-16'"):
        payloads.damaged_messages(spark, sf).filter(half).drop("event_time").write.mode("append").parquet(f"{out}/topic")
        judged = sources.judged_ticks(sources.file_stream(spark, f"{out}/topic", schema))
        _done(sinks.to_good_and_bad(judged, sources.good_ticks, sources.bad_messages, f"{out}/ticks", f"{out}/dead", f"{out}/cp", once=True))
    good = spark.read.parquet(f"{out}/ticks").select(F.lit("good").alias("verdict"), F.col("symbol").alias("key"), "partition", "offset")
    dead = spark.read.parquet(f"{out}/dead").select(F.col("error").alias("verdict"), "key", "partition", "offset")
    return good.unionByName(dead).groupBy("verdict", "key").agg(F.count("*").alias("n"), F.countDistinct("partition", "offset").alias("messages"))


@query("y3_bars_by_timer", with_ctes(TICKS, body=_minute_sql()))
def y3_timers(spark, sf):
    """Bars kept in keyed state and sent by event-time timers, over two runs of one checkpoint."""
    out = shared_dir(spark, "y3t")
    for half in ("ts < '2024-01-16'", "ts >= '2024-01-16'"):
        views.table(spark, sf, "events").filter(half).write.mode("append").parquet(f"{out}/in")
        events = sources.file_stream(_session(spark), f"{out}/in", sources.EVENT_SCHEMA)
        ticks = views.ticks_from_events(events).withColumn("event_time", F.col("event_time").cast("timestamp"))
        _done(sinks.to_files(state.bars_by_timer(ticks), f"{out}/rows", f"{out}/cp", once=True))
    rows = spark.read.parquet(f"{out}/rows").withColumn("window_start", F.timestamp_millis("minute"))
    return _naive(rows, "window_start").select("window_start", *_BAR_COLUMNS)
