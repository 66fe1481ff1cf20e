"""Streams over damaged messages: what is decoded and what is kept aside are complements."""

import json

import pytest
from pyspark.sql import functions as F

from marketspark.schemas import MACRO, TICK
from marketspark.sources.messages import split_good_bad
from marketspark.streaming import sinks, sources

GOOD = {"symbol": "s", "price": 1.5, "volume": 3, "timestamp": "2024-01-01T00:00:00+00:00"}
CASES = [
    (json.dumps(GOOD), None), (json.dumps(GOOD | {"name": None}), None), ("{broken", "malformed"), ("[1]", "malformed"), (None, "malformed"), ("", "malformed"),
    (json.dumps(GOOD | {"more": 1}), "unknown field"), (json.dumps(GOOD | {"price": "abc"}), "wrong type"), (json.dumps(GOOD | {"volume": 1.5}), "wrong type"),
    (json.dumps(GOOD | {"symbol": None}), "no key"), (json.dumps({k: v for k, v in GOOD.items() if k != "symbol"}), "missing field"),
    (json.dumps(GOOD | {"timestamp": "garbage"}), "no time"), (json.dumps({k: v for k, v in GOOD.items() if k != "timestamp"}), "no time"),
]


def messages(spark, n=1):
    return spark.createDataFrame([("k", v, 0, i + 100 * j) for j in range(n) for i, (v, _) in enumerate(CASES)], "key string, value string, partition int, offset long")


def test_each_message_is_either_good_or_bad(spark):
    rows = messages(spark)
    good = {r["offset"] for r in sources.parse_ticks(rows).collect()}
    bad = {r["offset"]: r["error"] for r in sources.dead_letters(rows).collect()}
    assert bad == {i: e for i, (_, e) in enumerate(CASES) if e} and good == {i for i, (_, e) in enumerate(CASES) if not e}


def test_a_stream_outlives_bad_messages_and_keeps_them(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    for j in range(2):  # the second run goes on where the first ended
        messages(spark).withColumn("partition", F.lit(j)).write.mode("append").parquet(topic)
        stream = sources.file_stream(spark, topic, "key string, value string, partition int, offset long")
        sinks.to_good_and_bad(sources.judged_ticks(stream), sources.good_ticks, sources.bad_messages, f"{out}/ticks", f"{out}/dead", f"{out}/cp", once=True).awaitTermination()
    ticks, dead = spark.read.parquet(f"{out}/ticks"), spark.read.parquet(f"{out}/dead")
    assert ticks.count() == 2 * sum(e is None for _, e in CASES) and ticks.where("event_time IS NULL OR symbol IS NULL").count() == 0
    assert sorted((r["value"] or "", r["error"]) for r in dead.collect()) == sorted((v or "", e) for v, e in CASES if e for _ in range(2))
    assert {f.name for f in TICK.fields} <= set(ticks.columns)


def test_bronze_keeps_unreadable_messages(spark, tmp_path):
    topic, table = str(tmp_path / "topic"), str(tmp_path / "table")
    good = {"stat_code": "a", "value": 1.0}
    rows = [json.dumps(good), "{x", json.dumps({"value": 2.0}), json.dumps(good | {"value": "much"}), json.dumps({"stat_code": None})]
    spark.createDataFrame([("k", v, "t") for v in rows], sources.MESSAGE_SCHEMA).write.parquet(topic)
    stream = sources.file_stream(spark, topic, sources.MESSAGE_SCHEMA)
    sinks.to_bronze(stream, MACRO, table, str(tmp_path / "cp"), ("stat_code",)).awaitTermination()
    assert [(r["stat_code"], r["value"]) for r in spark.read.parquet(table).collect()] == [("a", 1.0)]
    assert sorted(r["error"] for r in spark.read.parquet(f"{table}-dead").collect()) == ["malformed", "missing field", "no key", "wrong type"]


def test_a_table_stream_reads_its_own_table_alone(spark, tmp_path):
    for name in ("t.parquet", "t.parquet.bak", "t.parquet_old"):
        spark.range(3).write.parquet(str(tmp_path / name))
    stream = sources.table_stream(spark, str(tmp_path / "t.parquet"), "id long")
    sinks.to_files(stream, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.table_stream(spark, str(tmp_path / "none.parquet"), "id long")


def test_a_message_is_read_once(spark):
    """Neither the filter on the verdict nor the single fields bring readings of their own."""
    raw = spark.range(4).selectExpr("cast(id as string) AS key", "concat('{\"symbol\":\"', id, '\"}') AS value", "0 AS partition", "id AS offset")
    for part in split_good_bad(raw, TICK):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
