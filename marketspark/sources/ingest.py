"""Raw payload tables (one fetched page per row) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html
from ..functions.text import change_text, parse_float, parse_int, strip_prefix, url_parameter

_SNAPSHOT = (
    "data array<struct<symbolCode:string,name:string,tradePrice:double,change:string,changePrice:double,"
    "changeRate:double,accTradeVolume:double,accTradePrice:double,foreignRatio:double>>"
)
_MACRO = (
    "RESULT string, StatisticSearch struct<row:array<struct<STAT_NAME:string,ITEM_CODE1:string,ITEM_NAME1:string,"
    "CYCLE:string,TIME:string,DATA_VALUE:string,UNIT_NAME:string>>>"
)


def _whole(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0)).cast("bigint")


def _percent(x: Column) -> Column:
    return F.round(F.coalesce(x, F.lit(0.0)) * 100, 4)


def snapshot_json(pages: DataFrame) -> DataFrame:
    """(market, body) with a JSON listing per row -> one row per quoted symbol."""
    item = F.explode(F.from_json("body", _SNAPSHOT)["data"])
    rows = pages.select("market", item.alias("i")).filter(F.col("i.tradePrice").isNotNull())
    return rows.select(
        strip_prefix(F.coalesce("i.symbolCode", F.lit(""))).alias("symbol_code"),
        F.coalesce("i.name", F.lit("")).alias("name"),
        "market",
        F.col("i.tradePrice").cast("bigint").alias("trade_price"),
        change_text(F.coalesce("i.change", F.lit(""))).alias("change"),
        _whole(F.col("i.changePrice")).alias("change_price"),
        _percent(F.col("i.changeRate")).alias("change_rate"),
        _whole(F.col("i.accTradeVolume")).alias("acc_trade_volume"),
        _whole(F.col("i.accTradePrice")).alias("acc_trade_price"),
        _percent(F.col("i.foreignRatio")).alias("foreign_ratio"),
    )


def _table(pages: DataFrame, css_class: str, *keep: str) -> DataFrame:
    rows = pages.select(*keep, F.explode(html.table_rows(F.col("body"), css_class)).alias("row"))
    return rows.withColumn("raw", html.cells(F.col("row"))).withColumn(
        "cell", F.transform("raw", html.text_of)
    )


def snapshot_html(pages: DataFrame) -> DataFrame:
    """(market, body) with an HTML ranking per row -> one row per listed item."""
    rows = _table(pages, "type_2", "market")
    href = html.link_target(F.col("row"), "/item/main")
    listed = rows.withColumn("href", href).filter((F.col("href") != "") & (F.size("cell") >= 10))
    cell = F.col("cell")
    return listed.select(
        url_parameter(F.col("href"), "code").alias("code"),
        html.link_text(F.col("row"), "/item/main").alias("name"),
        "market",
        parse_int(F.get(cell, F.lit(2))).alias("current_price"),
        parse_float(F.get(cell, F.lit(4))).alias("change_rate"),
        parse_int(F.get(cell, F.lit(9))).alias("volume"),
        parse_int(F.get(cell, F.lit(6))).alias("market_cap"),
    )


def daily_prices_html(pages: DataFrame) -> DataFrame:
    """(symbol, body) price history pages -> typed daily bars.

    A row counts when its first cell starts with a digit and all its numbers
    parse; anything else on the page is layout.
    """
    rows = _table(pages, "type2", "symbol")
    texts = F.transform("cell", lambda c: F.replace(c, F.lit(","), F.lit("")))
    rows = rows.withColumn("t", texts).filter((F.size("t") >= 7) & F.get("t", F.lit(0)).rlike("^[0-9]"))
    number = {name: F.get("t", F.lit(i)).try_cast("bigint") for name, i in
              {"open": 3, "high": 4, "low": 5, "close": 1, "volume": 6}.items()}
    typed = rows.select(
        "symbol", F.try_to_date(F.get("t", F.lit(0)), "yyyy.MM.dd").alias("date"),
        *[expr.cast("double").alias(name) for name, expr in number.items()],
    )
    return typed.na.drop()


def between_dates(bars: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive date range; either end may be open."""
    if start is not None:
        bars = bars.filter(F.col("date") >= F.to_date(F.lit(start)))
    if end is not None:
        bars = bars.filter(F.col("date") <= F.to_date(F.lit(end)))
    return bars


def six_digit(df: DataFrame, column: str = "ticker") -> DataFrame:
    return df.filter(F.col(column).rlike("^[0-9]{6}$"))


def market_list_html(pages: DataFrame) -> DataFrame:
    """(market, body) listing pages -> text columns of six-digit tickers."""
    rows = _table(pages, "type_2", "market").filter(F.size("cell") >= 6)
    href = html.link_target(F.get("raw", F.lit(1)))
    texts = F.transform("cell", lambda c: F.replace(c, F.lit(","), F.lit("")))
    rows = rows.withColumn("href", href).withColumn("t", texts).filter(F.col("href") != "")
    column = {name: F.coalesce(F.try_element_at("t", F.lit(i + 1)), F.lit("")) for name, i in
              {"price": 2, "change": 3, "change_rate": 4, "volume": 5, "market_cap": 6}.items()}
    listed = rows.select(
        html.link_text(F.get("raw", F.lit(1))).alias("name"),
        F.when(F.col("href").contains("code="), F.regexp_extract("href", "code=([^=]*)$", 1)).otherwise("").alias("ticker"),
        *[expr.alias(name) for name, expr in column.items()],
        F.upper("market").alias("market"),
    )
    return six_digit(listed)


def stock_info_html(pages: DataFrame) -> DataFrame:
    """(ticker, body) company pages -> four text fields; a missing page is an error."""
    page = F.coalesce("body", F.lit(""))
    heading = F.regexp_extract(page, r'(?is)<div[^>]*\bclass="wrap_company"[^>]*>.*?<h2[^>]*>(.*?)</h2>', 1)
    rate = F.coalesce(
        F.nullif(html.blind_text(page, "no_exday", "nv01"), F.lit("")),
        F.nullif(html.blind_text(page, "no_exday", "nv02"), F.lit("")), F.lit(""),
    )
    plain = lambda x: F.replace(x, F.lit(","), F.lit(""))
    return pages.select(
        "ticker",
        html.link_text(heading).alias("name"),
        plain(html.blind_text(page, "no_today")).alias("price"),
        plain(html.blind_text(page, "no_exday")).alias("change"),
        rate.alias("rate"),
        F.when(F.col("body").isNull(), "page not fetched").alias("error"),
    )


def macro_json(payloads: DataFrame) -> DataFrame:
    """(stat_code, body) statistics responses -> macro events.

    A RESULT member marks an error response, which yields no rows; a blank value
    counts as 0.
    """
    parsed = payloads.select("stat_code", F.from_json("body", _MACRO).alias("p")).filter("p.RESULT is null")
    rows = parsed.select("stat_code", F.explode("p.StatisticSearch.row").alias("r"))
    text = {"STAT_NAME": "stat_name", "ITEM_CODE1": "item_code1", "ITEM_NAME1": "item_name1", "CYCLE": "cycle", "TIME": "time"}
    blank = F.lit("")
    return rows.select(
        "stat_code",
        *[F.coalesce(F.col(f"r.{src}"), blank).alias(dst) for src, dst in text.items()],
        F.coalesce(F.col("r.DATA_VALUE").try_cast("double"), F.lit(0.0)).alias("value"),
        F.coalesce("r.UNIT_NAME", blank).alias("unit_name"),
        F.lit("ecos").alias("source"),
    )
