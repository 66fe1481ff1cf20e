"""Correlations of any number of tickers as blocks of one matrix.

Tickers are hashed into blocks.  A date's returns are one vector per block, two blocks meet by
date, and one task turns the dates of a pair of blocks into that part of the matrix.  The plan
does not grow with the tickers, and no pair of tickers is a row before the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 256
MATRIX = "a string, b string, corr double, n_dates long"


def most_traded(bars: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` symbols of the largest traded value, ties by symbol."""
    value = bars.groupBy("symbol").agg(F.sum(F.col("close") * F.col("volume")).alias("value"))
    return value.orderBy(F.desc("value"), "symbol").limit(n).select("symbol")


def aligned(returns: DataFrame, tickers: DataFrame) -> DataFrame:
    """(date, symbol, ret) of the tickers on the dates on which all of them have a return."""
    rows = returns.filter(F.col("ret").isNotNull()).join(tickers, "symbol", "left_semi").select("date", "symbol", "ret")
    full = rows.groupBy("date").agg(F.count("*").alias("n")).filter(F.col("n") == tickers.select(F.count("*")).scalar())
    return rows.join(full.select("date"), "date", "left_semi")


def _part(table: pa.Table) -> pa.Table:
    """Correlations of the tickers of two blocks over the dates that are rows of ``table``."""
    def side(column: str) -> tuple[list[str], np.ndarray]:
        cells = table[column].combine_chunks()
        names = cells[0].as_py()
        values = cells.flatten().field("ret").to_numpy(zero_copy_only=False).reshape(len(cells), len(names))
        away = values - values.mean(axis=0)
        length = np.sqrt((away**2).sum(axis=0))
        return [c["symbol"] for c in names], np.divide(away, length, out=np.full_like(away, np.nan), where=length > 0)

    (a, x), (b, y) = side("x"), side("y")
    corr = x.T @ y
    left, right = np.repeat(np.array(a, object), len(b)), np.tile(np.array(b, object), len(a))
    flat = np.where(left == right, 1.0, corr.ravel())
    return pa.table({"a": pa.array(left, pa.string()), "b": pa.array(right, pa.string()), "corr": pa.array(flat, from_pandas=True),
                     "n_dates": pa.array(np.full(len(flat), table.num_rows))})


def correlation_matrix(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, corr, n_dates) of every ordered pair of the tickers of ``rows`` (date, symbol, ret), of which each has every date.

    A ticker whose returns never change has null with any other, and 1 with itself.
    """
    blocks = F.ceil(rows.select(F.countDistinct("symbol")).scalar() / block).cast("int")
    vectors = rows.groupBy("date", F.pmod(F.xxhash64("symbol"), blocks).cast("int").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("symbol", "ret"))).alias("x"))
    other = vectors.select("date", F.col("block").alias("other"), F.col("x").alias("y"))
    parts = vectors.join(other, "date").filter(F.col("block") <= F.col("other")).groupBy("block", "other").applyInArrow(_part, MATRIX)
    mirrored = parts.select(F.col("b").alias("a"), F.col("a").alias("b"), "corr", "n_dates", F.pmod(F.xxhash64("a"), blocks).alias("i"), F.pmod(F.xxhash64("b"), blocks).alias("j"))
    return parts.unionByName(mirrored.filter(F.col("i") != F.col("j")).drop("i", "j"))
