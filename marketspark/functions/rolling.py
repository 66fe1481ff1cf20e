"""Per-symbol window helpers.

All indicator windows use the one spec returned by :func:`by_symbol`, so Spark
plans a single exchange and sort for them.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

EPS = 1e-9


def by_symbol():
    return Window.partitionBy("symbol").orderBy("date")


def last_n(n: int):
    return by_symbol().rowsBetween(-(n - 1), 0)


def so_far():
    return by_symbol().rowsBetween(Window.unboundedPreceding, 0)


def whole():
    return Window.partitionBy("symbol")


def full(agg, x: Column, n: int) -> Column:
    """``agg(x)`` over the last n rows, null until n non-null values are there."""
    frame = last_n(n)
    return F.when(F.count(x).over(frame) == n, agg(x).over(frame))


def change(x: Column, n: int = 1) -> Column:
    """x / x[n rows ago] - 1; null on a zero base."""
    return F.try_divide(x, F.lag(x, n).over(by_symbol())) - 1
