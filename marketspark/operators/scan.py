"""Running sums over groups of any size: a parallel prefix scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize


def running_sums(rows: DataFrame, key: str, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with the running sum of each of ``sums`` within ``key``, along ``order``, the row itself included.

    Rows are dealt by ranges of (key, order), so a key with most rows lies in many ranges, be it all in
    one second.  Each range adds up its own rows; the ranges' totals, one small row for each key and range, give what
    every range opens with.  The dealt rows are written once, so both passes see the same ranges.
    """
    held = materialize(rows.repartitionByRange(key, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    totals = held.groupBy(key, "__range").agg(*[F.sum(x).alias(f"__{n}") for n, x in sums.items()])
    before = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    opening = totals.select(key, "__range", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    within = Window.partitionBy(key, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = held.withColumns({n: F.sum(x).over(within) for n, x in sums.items()}).join(opening, [key, "__range"])
    return out.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop("__range", *[f"__{n}" for n in sums])
