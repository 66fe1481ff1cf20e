"""Streaming sources and the parsed tick stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TICK
from ..sources.messages import judged

WATERMARK = "2 minutes"
#: Spark's state store for keyed state with timers; it also keeps large state out of the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MESSAGE_SCHEMA = "key string, value string, topic string"
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def topic_stream(spark: SparkSession, topic: str, servers: str, from_beginning: bool = False) -> DataFrame:
    """Messages of one Kafka topic; a gap in the log does not stop the query.

    The starting offset only matters for a fresh checkpoint: replaying a topic
    is a new checkpoint with ``from_beginning``.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest" if from_beginning else "latest")
        .option("failOnDataLoss", "false")
        .load()
    )


def file_stream(spark: SparkSession, path: str, schema: str, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, oldest first."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def table_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet table as a stream, be it one file or a folder of files; a missing table raises at once."""
    spark.read.schema(schema).parquet(path)
    # A plain file path is no stream source; a pattern that only this name matches is.
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def judged_ticks(messages: DataFrame) -> DataFrame:
    """``messages`` with ``data``, ``error`` and ``event_id``: one reading for :func:`good_ticks` and :func:`bad_messages`.

    A tick needs a symbol and a time; other fields may be absent, but none may be unknown or of another type.
    ``event_id`` orders ticks of one time: the place in the topic (up to 2^17 partitions of 2^46
    messages), or where messages come without one, a hash of the message.
    """
    if {"partition", "offset"} <= set(messages.columns):
        place = F.col("partition").cast("bigint") * (1 << 46) + F.col("offset")
    else:
        place = F.xxhash64("value").bitwiseAND(F.lit((1 << 63) - 1))
    optional = tuple(f.name for f in TICK.fields if f.nullable)
    return judged(messages.withColumn("event_id", place), TICK, optional, key="symbol", time="timestamp")


def good_ticks(judged_rows: DataFrame) -> DataFrame:
    """The ticks of judged messages, with event time."""
    keep = [c for c in ("partition", "offset") if c in judged_rows.columns]
    rows = judged_rows.filter("error is null").select("event_id", *keep, "data.*")
    return rows.withColumn("event_time", F.try_to_timestamp("timestamp"))


def bad_messages(judged_rows: DataFrame) -> DataFrame:
    """The other messages as they came, with the error."""
    return judged_rows.filter("error is not null").drop("data", "event_id")


def parse_ticks(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Decoded ticks with event time, watermark and ``event_id``; exactly the messages that are no dead letters."""
    return with_event_time(good_ticks(judged_ticks(messages)), watermark)


def dead_letters(messages: DataFrame) -> DataFrame:
    """The messages that :func:`parse_ticks` leaves out, with the reason; ``sinks.to_good_and_bad`` keeps both from one reading."""
    return bad_messages(judged_ticks(messages))


def with_event_time(rows: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp")).withWatermark("event_time", watermark)


def state_session(spark: SparkSession, partitions: int) -> SparkSession:
    """Session for stateful queries with its own number of state partitions.

    The number is fixed in a checkpoint at its first run, so it is chosen per
    query and not inherited from the batch setting.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session
