"""Canonical views over the benchmark tables: ticks, bars, symbols, macro, trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import packed_fields


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Tick view of an events table; works on a stream of it as well."""
    k = F.get_json_object("props", "$.k").cast("int")
    price = (F.lit(50) + k * 0.5).cast("double")
    return events.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.upper("event_type").alias("name"),
        F.lit("SIM").alias("market"),
        F.col("ts").cast("timestamp").alias("event_time"),
        price.alias("price"),
        price.alias("open"),
        (price + 1).alias("high"),
        (price - 2).alias("low"),
        price.alias("close"),
        F.floor(F.col("value") * 100).cast("bigint").alias("volume"),
        ((k - 50) / 10.0).cast("double").alias("change_pct"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (symbol, date).

    The aggregation combines map-side, so a symbol holding a large share of the
    line items shuffles only its per-date partials.  Everything downstream that
    windows over a symbol sees at most one row per calendar day.
    """
    items = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    order = packed_fields((F.col("l_orderkey"), 13), (F.col("l_linenumber"), 4), (F.col("l_partkey"), 12), (F.round(price * 100), 9))
    grouped = items.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
        F.count("*").alias("n"),
    )
    return grouped.select(F.col("l_suppkey").cast("string").alias("symbol"), "date", "open", "high", "low", "close", "volume", "n")


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("symbol"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("market"),
        )
    )


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("stat_code"),
        F.date_format("o_orderdate", "yyyyMM").alias("time"),
    ).agg(F.round(F.avg("o_totalprice"), 4).alias("value")).select(
        "stat_code", F.lit("M").alias("cycle"), "time", "value"
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("side"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_linestatus").alias("broker"),
        F.col("l_orderkey").cast("string").alias("order_id"),
    )
