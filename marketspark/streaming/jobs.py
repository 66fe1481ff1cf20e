"""The standing streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.dates import iso_utc
from ..operators.ticks import minute_bars, significant_moves, volume_anomalies, window_bars
from ..schemas import ALERT, FILTERED, TOPICS, WINDOW_BAR
from ..sources.messages import encode
from .sinks import to_console, to_files
from .state import alert_stream


def bars_and_anomalies(ticks: DataFrame, path: str, checkpoint: str, *, once: bool = False,
                       anomaly_window: str = "10 minutes") -> list[StreamingQuery]:
    """Two queries off one parsed stream, both to files; a standing job then
    calls ``spark.streams.awaitAnyTermination()``."""
    bars = to_files(window_bars(ticks, "5 minutes", "1 minute"), f"{path}/bars", f"{checkpoint}/bars", once=once)
    anomalies = to_files(volume_anomalies(ticks, anomaly_window), f"{path}/anomalies", f"{checkpoint}/anomalies", once=once)
    return [bars, anomalies]


def watch(df: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    return to_console(df, name, checkpoint)


def keyed(rows: DataFrame, schema: StructType, topic: str) -> DataFrame:
    """Rows as JSON messages of one topic by symbol, with the schema's fields in its order."""
    return encode(rows.select(*schema.fieldNames()), "symbol").withColumn("topic", F.lit(topic))


def bar_messages(bars: DataFrame) -> DataFrame:
    text = {"window_start": iso_utc(F.col("window_start")), "window_end": iso_utc(F.col("window_end")), "computed_at": iso_utc(F.current_timestamp())}
    return keyed(bars.withColumns(text), WINDOW_BAR, TOPICS["bars"])


def fan_out(ticks: DataFrame, path: str, checkpoint: str, *, once: bool = False) -> list[StreamingQuery]:
    """Filtered moves and minute bars as keyed messages of their topics, and volume alerts as rows and messages, from one tick stream."""
    moves = significant_moves(ticks).withColumn("processed_at", iso_utc(F.current_timestamp()))
    return [
        to_files(keyed(moves, FILTERED, TOPICS["filtered"]), f"{path}/filtered", f"{checkpoint}/filtered", once=once),
        alert_stream(ticks, f"{path}/volume", f"{checkpoint}/alerts", messages=lambda a: keyed(a, ALERT, TOPICS["alerts"]), once=once),
        to_files(bar_messages(minute_bars(ticks)), f"{path}/bars", f"{checkpoint}/bars", once=once),
    ]
