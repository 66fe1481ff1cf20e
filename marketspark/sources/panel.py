"""Loading bar panels from files and reporting what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DAILY_BAR


def load_bars(spark: SparkSession, path: str, fmt: str = "parquet", symbols: DataFrame | None = None) -> DataFrame:
    """Bars with complete prices from parquet, csv or json files.

    The explicit schema makes column pruning and filters reach the scan; row
    order is left to the window specs downstream.
    """
    reader = spark.read.schema(DAILY_BAR)
    if fmt == "csv":
        reader = reader.option("header", True)
    bars = reader.format(fmt).load(path).na.drop(subset=["date", "open", "high", "low", "close", "volume"])
    return bars.join(symbols.select("symbol").distinct(), "symbol", "left_semi") if symbols is not None else bars


def clean_bars(bars: DataFrame) -> DataFrame:
    columns = ["symbol", "date", "open", "high", "low", "close", "volume"]
    return bars.select(*columns).na.drop()


def missing_symbols(requested: DataFrame, bars: DataFrame) -> DataFrame:
    """Requested symbols without a single bar, as an error list."""
    absent = requested.select("symbol").distinct().join(bars.select("symbol").distinct(), "symbol", "left_anti")
    return absent.withColumn("error", F.lit("no data"))
