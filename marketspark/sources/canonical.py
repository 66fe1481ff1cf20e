"""Snapshots and quotes of different sources as canonical tick events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _event(symbol, name, market, price, volume, change_pct, change_price, foreign_ratio, source, ohl=None) -> list[Column]:
    """Canonical columns; open, high, low and close copy the price unless given."""
    ohl = ohl or {}
    cells = {"symbol": symbol, "name": name, "market": market, "price": price.cast("double")}
    for side in ("open", "high", "low", "close"):
        cells[side] = ohl.get(side, price).cast("double")
    cells |= {
        "volume": volume.cast("bigint"), "change_pct": change_pct.cast("double"),
        "change_price": change_price.cast("double"), "foreign_ratio": foreign_ratio.cast("double"),
        "source": F.lit(source),
    }
    return [expr.alias(name) for name, expr in cells.items()]


def _or(column: str, default) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def from_snapshot_json(rows: DataFrame) -> DataFrame:
    return rows.select(*_event(
        _or("symbol_code", ""), _or("name", ""), _or("market", ""), _or("trade_price", 0),
        _or("acc_trade_volume", 0), _or("change_rate", 0.0), _or("change_price", 0), _or("foreign_ratio", 0.0), "daum"))


def from_snapshot_html(rows: DataFrame) -> DataFrame:
    """This source knows neither the price change nor the foreign ratio: both 0."""
    return rows.select(*_event(
        _or("code", ""), _or("name", ""), _or("market", ""), _or("current_price", 0),
        _or("volume", 0), _or("change_rate", 0.0), F.lit(0.0), F.lit(0.0), "naver"))


def from_quote(quotes: DataFrame) -> DataFrame:
    """Quote documents: missing numbers are 0, name falls back to the symbol."""
    sides = {"open": _or("regularMarketOpen", 0.0), "high": _or("regularMarketDayHigh", 0.0),
             "low": _or("regularMarketDayLow", 0.0), "close": _or("regularMarketPreviousClose", 0.0)}
    return quotes.select(*_event(
        F.col("symbol"), F.coalesce("shortName", "symbol"), _or("exchange", "NASDAQ"),
        _or("regularMarketPrice", 0.0), _or("regularMarketVolume", 0), _or("regularMarketChangePercent", 0.0),
        _or("regularMarketChange", 0.0), F.lit(0.0), "yfinance", sides))


def with_derived_change(events: DataFrame) -> DataFrame:
    """Change against the previous close where both prices are known."""
    price, close = F.col("price"), F.col("close")
    known = (price != 0) & (close != 0)
    return events.withColumns({
        "change_pct": F.when(known, F.round(F.try_divide(price - close, close) * 100, 4)).otherwise(0.0),
        "change_price": F.when(known, F.round(price - close, 4)).otherwise(0.0),
    })


# Attribute -> JSON member, per source.
FIELD_MAPPINGS = {
    "daum": {"stock_symbol": "symbol_code", "stock_name": "name", "stock_price": "trade_price",
             "stock_change": "change_rate", "stock_volume": "acc_trade_volume", "stock_market": "market"},
    "naver": {"stock_symbol": "code", "stock_name": "name", "stock_price": "current_price",
              "stock_change": "change_rate", "stock_volume": "volume", "stock_market": "market"},
}


def extract_fields(messages: DataFrame) -> DataFrame:
    """Pull the mapped members of (source, value) JSON into text attributes.

    Unreadable JSON keeps its row, with ``processing_error`` set.
    """
    out = messages
    for attribute in FIELD_MAPPINGS["daum"]:
        value = None
        for source, mapping in FIELD_MAPPINGS.items():
            member = F.get_json_object("value", f"$.{mapping[attribute]}")
            value = F.when(F.col("source") == source, member) if value is None else value.when(F.col("source") == source, member)
        out = out.withColumn(attribute, value)
    return out.withColumn(
        "processing_error", F.when(F.try_parse_json("value").isNull(), F.lit("malformed JSON")))


# Constant attributes stamped on every message.
STATIC_ATTRIBUTES = {"pipeline_version": "1.0", "pipeline_stage": "nifi-etl", "destination_topic": "stock.raw.prices"}


def stamp(messages: DataFrame, attributes: dict[str, str] | None = None) -> DataFrame:
    values = attributes or STATIC_ATTRIBUTES
    return messages.withColumns({k: F.lit(v) for k, v in values.items()} | {"processed_at": F.current_timestamp()})


def route(messages: DataFrame) -> DataFrame:
    """Destination topic, key and delivery status of every message: known source
    and readable value succeed, the rest fail."""
    good = F.col("processing_error").isNull() & F.col("source").isin(*FIELD_MAPPINGS)
    return messages.withColumns({
        "topic": F.coalesce("destination_topic", F.lit("stock.raw.prices")),
        "key": F.coalesce("stock_symbol", F.lit("UNKNOWN")),
        "status": F.when(good, "success").otherwise("failure"),
    })


def delivery_tally(routed: DataFrame) -> DataFrame:
    return routed.groupBy("topic").agg(
        F.sum((F.col("status") == "success").cast("int")).alias("success"),
        F.sum((F.col("status") == "failure").cast("int")).alias("failure"),
        F.count("*").alias("total"),
    )
