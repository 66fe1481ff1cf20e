"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minute_start(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def next_business_day(day: Column) -> Column:
    """The following day, moved past Saturday and Sunday."""
    step = F.when(F.weekday(day) == 4, 3).when(F.weekday(day) == 5, 2).otherwise(1)
    return F.date_add(day, step)


def period_text(day: Column, cycle: Column) -> Column:
    """Statistics period of a date: day, month, quarter, otherwise year."""
    return (
        F.when(cycle == "D", F.date_format(day, "yyyyMMdd"))
        .when(cycle == "M", F.date_format(day, "yyyyMM"))
        .when(cycle == "Q", F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string")))
        .otherwise(F.date_format(day, "yyyy"))
    )


def months_back(day: Column, months: int) -> Column:
    return F.date_sub(day, 31 * months)


def period_start(cycle: Column, text: Column) -> Column:
    """First day of a statistics period written as yyyyMMdd, yyyyMM, yyyyQn or yyyy."""
    quarter_month = (F.substring(text, 6, 1).try_cast("int") - 1) * 3 + 1
    return (
        F.when(cycle == "D", F.try_to_date(text, "yyyyMMdd"))
        .when(cycle == "M", F.try_to_date(F.concat(text, F.lit("01")), "yyyyMMdd"))
        .when(cycle == "Q", F.make_date(F.substring(text, 1, 4).try_cast("int"), quarter_month, F.lit(1)))
        .otherwise(F.make_date(F.substring(text, 1, 4).try_cast("int"), F.lit(1), F.lit(1)))
    )


def fetch_period(pages: Column) -> Column:
    """History length asked from the quote provider for a page count."""
    # Known page counts.
    known = {1: "3mo", 2: "3mo", 5: "6mo", 10: "1y", 20: "2y"}
    out = F.when(pages > 20, "2y")
    for count, period in known.items():
        out = out.when(pages == count, period)
    return out.otherwise("1y")
