"""Batch sinks.  Every writer takes the output path; formats are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def append_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """Append with an ingestion stamp; rows of a partition value are brought
    together, with the spread of a hot value left to adaptive splitting."""
    stamped = df.withColumn("ingested_at", F.current_timestamp())
    stamped.hint("rebalance", *by).write.mode("append").partitionBy(*by).format(fmt).save(path)


def export_json(df: DataFrame, path: str, source: str) -> None:
    """Records as JSON lines plus one envelope record (source, time, count).

    The envelope is its own file: a single document holding all records would
    pull the whole table into one task.
    """
    df.write.mode("overwrite").json(f"{path}/stocks")
    envelope = df.agg(F.count("*").alias("total_count")).select(
        F.lit(source).alias("source"), F.current_timestamp().alias("crawled_at"), "total_count")
    envelope.write.mode("overwrite").json(f"{path}/envelope")


def export_xml(df: DataFrame, path: str, row_tag: str = "Stock", root_tag: str = "StockInfos") -> None:
    """One element per row; columns starting with ``_`` become attributes."""
    df.write.mode("overwrite").format("xml").option("rootTag", root_tag).option("rowTag", row_tag).save(path)


def export_training_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Train and test rows as CSV, one folder for each split.

    Rows stay in the partitions they come in, which hold whole symbols, and lie in order within a file; so nothing is shuffled or
    computed again to range them, and there are as many files as partitions and not a folder or a task per symbol.
    """
    ordered = df.sortWithinPartitions("split", "symbol", "date")
    writer = ordered.write.mode("overwrite").partitionBy("split").option("header", True).option("compression", compression)
    writer.option("zlib.compress.level", "BEST_SPEED").csv(path)


def read_training_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of :func:`export_training_csv`; ``schema`` has its columns in their order, split last."""
    return spark.read.schema(schema).option("header", True).csv(path)


def publish(df: DataFrame, key: str, topic: str, fmt: str = "kafka", **options) -> tuple[int, int]:
    """Rows as keyed JSON messages to a topic, or to files for ``fmt`` parquet; gives (sent, errors).

    A row without a key cannot be ordered by it; it is counted as an error and not sent.
    The counts are observed while the messages are written.
    """
    messages = df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"), F.lit(topic).alias("topic"))
    good, counts = F.col("key").isNotNull(), Observation()
    counted = messages.observe(counts, F.count_if(good).alias("sent"), F.count_if(~good).alias("errors")).filter(good)
    writer = counted.write.format(fmt).options(**options)
    (writer if fmt == "kafka" else writer.mode("append")).save()
    return counts.get["sent"], counts.get["errors"]


def log_events(df: DataFrame, path: str, *, type: Column, message: Column, detail: Column) -> None:
    """Append one system event per row of ``df``: type, message, detail and the time of logging.

    A null type is logged as UNKNOWN, a null message as an empty one.
    """
    rows = df.select(
        F.coalesce(type, F.lit("UNKNOWN")).alias("type"), F.coalesce(message, F.lit("")).alias("message"), detail.cast("string").alias("detail"), F.current_timestamp().alias("at"))
    rows.write.mode("append").parquet(path)
