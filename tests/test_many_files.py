"""Streams and messages: tables of one or many files, decoded ticks, order keys beyond small numbers."""

import json

import duckdb
from pyspark.sql import functions as F

from marketspark.operators import documents, stats, ticks, trades
from marketspark.plans import QUERIES
from marketspark.schemas import TICK
from marketspark.sources import views, writers
from marketspark.streaming import sources

SF = "/root/testdata/sf0.001"


def test_a_table_of_many_files_streams_whole(spark, tmp_path):
    events = views.table(spark, SF, "events")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("s1_tick_stream", "g13_downstream_tap", "k12_fan_out"):
        one = sorted(map(str, QUERIES[name](spark, SF).collect()))
        many = sorted(map(str, QUERIES[name](spark, str(tmp_path)).collect()))
        assert one == many and one


def _messages(spark, with_place):
    rows = []
    for i in range(20):
        tick = {f.name: 1 if f.dataType.typeName() == "long" else 1.0 if f.dataType.typeName() == "double" else "x" for f in TICK.fields}
        tick |= {"symbol": "s", "price": float(i), "volume": 100 if i == 15 else 10, "timestamp": f"2024-01-01T00:00:{i // 2:02d}+00:00", "change_pct": 3.0}
        rows.append(("s", json.dumps(tick), 0, i))
    df = spark.createDataFrame([*rows, ("s", "{broken", 0, 20)], "key string, value string, partition int, offset long")
    return df if with_place else df.select("key", "value")


def test_decoded_ticks_feed_every_operator(spark):
    for with_place in (True, False):
        rows = sources.parse_ticks(_messages(spark, with_place))
        assert rows.count() == 20 and ticks.significant_moves(rows).count() == 20
        (bar,) = ticks.minute_bars(rows).collect()
        assert bar["event_count"] == 20 and (not with_place or (bar["open"], bar["close"]) == (0.0, 19.0))
        assert ticks.window_bars(rows, "5 minutes").count() == 1
        assert ticks.volume_alerts(ticks.running_volume(rows)).count() == 1
        (bad,) = sources.dead_letters(_messages(spark, with_place)).collect()
        assert bad["value"] == "{broken"


def test_order_key_of_large_numbers(spark, tmp_path):
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    rows = [(7_000_000_000, 9, 20_000_000_000, 1, 1.0, 10.0), (7_000_000_000, 10, 1, 1, 1.0, 20.0), (6_999_999_999, 99, 30_000_000_000, 1, 1.0, 30.0)]
    df = spark.createDataFrame(rows, schema.rpartition(",")[0]).withColumn("l_shipdate", F.lit("2024-01-01").cast("timestamp_ntz"))
    df.write.parquet(str(tmp_path / "lineitem.parquet"))
    (bar,) = views.daily_bars(spark, str(tmp_path)).collect()
    want = duckdb.sql(
        f"SELECT arg_min(l_extendedprice, o), arg_max(l_extendedprice, o) FROM (SELECT *, {{'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey}} AS o "
        f"FROM '{tmp_path}/lineitem.parquet/*.parquet')").fetchall()
    assert [(bar["open"], bar["close"])] == want == [(30.0, 20.0)]


def test_the_last_change_of_an_id_wins(spark):
    old = spark.createDataFrame([("a", "x", None), ("b", "y", None)], "id string, body string, updated_at timestamp")
    changes = spark.createDataFrame([("a", "one", 1), ("a", "two", 2), ("a", "zero", 0)], "id string, body string, changed_at int")
    assert {r["id"]: r["body"] for r in documents.update(old, changes).collect()} == {"a": "two", "b": "y"}
    assert documents.update(old, changes.drop("changed_at")).count() == 2


def test_a_doubled_name_adds_no_row(spark):
    names = spark.createDataFrame([("1", "B"), ("1", "A")], "symbol string, name string")
    bars = spark.createDataFrame([("1",), ("2",)], "symbol string")
    assert {r["symbol"]: r["name"] for r in stats.with_names(bars, names).collect()} == {"1": "A", "2": "2"}


def test_position_limit(spark):
    rows = spark.createDataFrame([("p", 10.0), ("p", 90.0), ("q", 0.0)], "owner string, value double")
    assert {(r["owner"], r["value"]): r["position_breach"] for r in trades.position_flags(rows).collect()} == {
        ("p", 10.0): False, ("p", 90.0): True, ("q", 0.0): False}


def test_publish_counts_what_it_sends(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "symbol string, price int")
    assert writers.publish(rows, "symbol", "t", fmt="parquet", path=str(tmp_path / "t")) == (2, 1)
    assert {r["key"] for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {"a", "b"}
