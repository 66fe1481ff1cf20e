"""Parsing and formatting of text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change codes of the snapshot feed and their display text.
CHANGE_TEXT = {"RISE": "상승", "FALL": "하락", "EVEN": "보합"}
# Alert severities in rising order.
SEVERITY_LEVEL = {"INFO": 0, "WARNING": 1, "CRITICAL": 2}
# Labels of the direction classifier.
SIGNAL_OF_CLASS = {-1: "SELL", 0: "HOLD", 1: "BUY"}


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def parse_int(text: Column) -> Column:
    """Grouped, unsigned integer text; decimals are cut off, bad text gives 0."""
    bare = F.trim(F.regexp_replace(text, "[,원+-]", ""))
    return F.coalesce(bare.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_float(text: Column) -> Column:
    """Percent text; keeps the minus sign, bad text gives 0."""
    bare = F.trim(F.regexp_replace(text, "[,%+]", ""))
    return F.coalesce(bare.try_cast("double"), F.lit(0.0))


def change_text(code: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(CHANGE_TEXT), code), code)


def url_parameter(url: Column, name: str) -> Column:
    """First value of a query-string parameter, '' when absent."""
    return F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)


def strip_prefix(code: Column, prefix: str = "A") -> Column:
    return F.regexp_replace(code, f"^{prefix}", "")


def market_number(market: Column) -> Column:
    return F.when(F.upper(market) == "KOSPI", "0").otherwise("1")


def quote_symbol(code: Column) -> Column:
    """Domestic numeric codes carry an exchange suffix at the quote provider."""
    return F.when(code.rlike("^[0-9]+$"), F.concat(code, F.lit(".KS"))).otherwise(code)


def severity_level(severity: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(SEVERITY_LEVEL), F.upper(severity)), F.lit(0))


def signal_of(label: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(SIGNAL_OF_CLASS), label.cast("int")), F.lit("HOLD"))


def alert_message(name: Column, symbol: Column, volume: Column, mean: Column) -> Column:
    return F.concat(
        name, F.lit("("), symbol, F.lit(") 거래량 급증: "), F.format_number(volume, 0),
        F.lit(" (평균 "), F.format_number(mean, 0), F.lit("의 "),
        F.format_number(volume / mean, 1), F.lit("배)"),
    )


def safe_percent(x: Column) -> Column:
    return F.round(x * 100, 2)
