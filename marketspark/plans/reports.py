"""Composed reports over feature rows of all symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rolling import by_symbol, whole
from ..operators.stats import annual_volatility, monthly_close


def timeseries_report(rows: DataFrame, lags: int = 10, chart_rows: int = 120) -> DataFrame:
    """One row per symbol: return summary, autocorrelations, calendar effects
    and the newest chart rows.

    All parts aggregate the same symbol-partitioned rows, so they are one
    aggregation and not five joined ones.
    """
    ret = F.col("ret")
    shifted = rows.withColumns({f"r{k}": F.lag(ret, k).over(by_symbol()) for k in range(1, lags + 1)})
    chart = shifted.withColumn("age", F.count("*").over(whole()) - F.row_number().over(by_symbol()))
    return chart.groupBy("symbol").agg(
        F.count(ret).alias("n"),
        F.avg(ret).alias("mean_ret"),
        annual_volatility(ret).alias("ann_vol"),
        F.avg((ret > 0).cast("int")).alias("up_ratio"),
        F.array(*[F.corr(ret, F.col(f"r{k}")) for k in range(1, lags + 1)]).alias("acf"),
        (F.lit(2.0) / F.sqrt(F.count(ret).cast("double"))).alias("band"),
        F.array(*[F.coalesce(F.avg(F.when(F.weekday("date") == i, ret)), F.lit(0.0)) for i in range(5)]).alias("weekday"),
        F.array(*[F.coalesce(F.avg(F.when(F.month("date") == i, ret)), F.lit(0.0)) for i in range(1, 13)]).alias("month"),
        F.array_sort(
            F.collect_list(F.when(F.col("age") < chart_rows, F.struct("date", "close", "ma20", "ma60")))
        ).alias("tail"),
    )


def timeseries_details(rows: DataFrame) -> DataFrame:
    """The report of :func:`timeseries_report` with the newest 24 monthly closes, one number a row: symbol, part, name, value."""
    report = timeseries_report(rows)

    def cell(part, name, value):
        return F.struct(F.lit(part).alias("part"), name.alias("name"), value.cast("double").alias("value"))

    def numbered(column: str, first: int):
        return F.transform(column, lambda v, i: cell(column, (i + first).cast("string"), v))

    single = F.array(*[cell("summary", F.lit(c), F.col(c)) for c in ("n", "mean_ret", "ann_vol", "up_ratio", "band")])
    def charted(column: str):
        return F.transform("tail", lambda t: cell(column, F.date_format(t["date"], "yyyy-MM-dd"), t[column]))

    cells = F.concat(single, numbered("acf", 1), numbered("weekday", 0), numbered("month", 1), *map(charted, ("close", "ma20", "ma60")))
    months = monthly_close(rows).select(
        "symbol", F.lit("month close").alias("part"), F.concat_ws("-", "year", F.lpad(F.col("month").cast("string"), 2, "0")).alias("name"), F.col("avg_close").alias("value"))
    return report.select("symbol", F.explode(cells).alias("c")).select("symbol", "c.*").unionByName(months)
