"""Streaming sinks.  Each query has its own checkpoint, which makes it an
independent reader of its source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

TRIGGER = "30 seconds"


def _start(writer, once: bool, trigger: str, path: str | None = None) -> StreamingQuery:
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start(path) if path else writer.start()


def to_files(df: DataFrame, path: str, checkpoint: str, *, by: tuple[str, ...] = (), fmt: str = "parquet",
             once: bool = False, trigger: str = TRIGGER) -> StreamingQuery:
    """Append closed results to files, exactly once through the sink's log."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    return _start(writer, once, trigger, path)


def to_bronze(messages: DataFrame, schema, path: str, checkpoint: str, by: tuple[str, ...], fmt: str = "parquet",
              dead: str | None = None, optional: tuple[str, ...] = ()) -> StreamingQuery:
    """Land what is new on a topic in a partitioned table, then stop.

    Messages that are no record of ``schema``, or whose partition columns are null, go to ``dead`` (the folder beside the table unless given).
    """
    from ..sources.messages import judged

    def good(rows: DataFrame) -> DataFrame:
        return rows.filter("error is null").select("data.*").withColumn("ingested_at", F.current_timestamp())

    rows = judged(messages, schema, optional or tuple(f.name for f in schema.fields if f.nullable), key=by[0] if by else None)
    return to_good_and_bad(rows, good, lambda r: r.filter("error is not null").drop("data"), path, dead or f"{path.rstrip('/')}-dead", checkpoint, by=by, fmt=fmt, once=True)


def to_good_and_bad(judged: DataFrame, good: Callable[[DataFrame], DataFrame], bad: Callable[[DataFrame], DataFrame], path: str, dead: str,
                    checkpoint: str, *, by: tuple[str, ...] = (), fmt: str = "parquet", once: bool = False, trigger: str = TRIGGER) -> StreamingQuery:
    """Two tables from one reading: every micro-batch of judged messages is held once and written twice, to ``batch=<id>`` of each.

    A batch that runs again replaces both of its folders, so no message is lost and none stands twice.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            good(held).write.mode("overwrite").format(fmt).partitionBy(*by).save(f"{path}/batch={batch_id}")
            bad(held).write.mode("overwrite").format(fmt).save(f"{dead}/batch={batch_id}")
        finally:
            held.unpersist()

    return each_batch(judged, save, checkpoint, once=once, trigger=trigger)


def to_console(df: DataFrame, name: str, checkpoint: str, *, fmt: str = "console", once: bool = False,
               trigger: str = TRIGGER) -> StreamingQuery:
    """Named query in update mode for watching results."""
    writer = df.writeStream.format(fmt).outputMode("update").queryName(name).option("checkpointLocation", checkpoint)
    if fmt == "console":
        writer = writer.option("truncate", False).option("numRows", 20)
    return _start(writer, once, trigger)


def to_store(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append", once: bool = False,
             trigger: str = TRIGGER, name: str | None = None) -> StreamingQuery:
    """Write every micro-batch to its own folder ``batch=<id>``.

    A batch that is run again after a failure overwrites its folder, so the
    table holds each batch once.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return each_batch(df, save, checkpoint, mode=mode, once=once, trigger=trigger, name=name)


def each_batch(df: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str, *, mode: str = "append",
               once: bool = False, trigger: str = TRIGGER, name: str | None = None) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    writer = writer.queryName(name) if name else writer
    return _start(writer, once, trigger)


def newest_version(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Last written row per key of a table made by :func:`to_store`."""
    rest = [c for c in stored.columns if c not in (*keys, "batch")]
    return stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("v")).select(*keys, "v.*")
