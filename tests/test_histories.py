"""Windows cut from blocks of a symbol's history, against windows over all its rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from marketspark.functions.rolling import by_symbol, whole
from marketspark.operators import models as ml
from marketspark.operators import sequences as seq
from marketspark.operators.labels import ordered_split


def panel(spark):
    """Symbols of 1 to 40 rows, some without a label, one symbol null."""
    day = datetime.date(2024, 1, 1)
    rows = [(None if s == 3 else f"s{s}", day + datetime.timedelta(i), float(s * 100 + i), None if i % 7 == 3 or i == n - 1 else i % 2)
            for s, n in enumerate((1, 4, 5, 6, 17, 40)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date date, v double, up int")


def plain(rows, length):
    windows = seq.sequence_windows(rows, ["v"], length).filter("up is not null") if length else rows.filter("up is not null").withColumn("window", F.array().cast("array<array<double>>"))
    return windows.withColumns({"rn": F.row_number().over(by_symbol()), "n_rows": F.count("*").over(whole())})


def rows_of(df, *names):
    return sorted(map(repr, df.select(*names).collect()))


@pytest.mark.parametrize("block", [5, 8, 1000])
@pytest.mark.parametrize("length", [0, 1, 5, 11])
def test_windows_equal_those_over_whole_histories(spark, monkeypatch, block, length):
    monkeypatch.setattr(seq, "BLOCK_ROWS", block)
    rows = panel(spark)
    blocks = seq.history(rows, ["v"], F.col("up"), (0, 1, 5, 11), ("v",))
    assert rows_of(blocks.cut(length).withColumnRenamed("label", "up"), "symbol", "date", "up", "v", "window", "rn", "n_rows") == rows_of(
        plain(rows, length), "symbol", "date", "up", "v", "window", "rn", "n_rows")
    assert blocks.rows_before(length, 0.8) == ordered_split(plain(rows, length)).filter("split = 'train'").count()


@pytest.mark.parametrize("limit", [1000, 12])
def test_split_draws_the_same_rows_and_writes_no_window(spark, monkeypatch, limit):
    monkeypatch.setattr(seq, "BLOCK_ROWS", 8)
    rows = panel(spark)
    parts = ordered_split(plain(rows, 5))
    blocks = seq.history(rows, ["v"], F.col("up"), (5,))
    written = []
    for module in (seq, ml):
        monkeypatch.setattr(module, "materialize", lambda df, name: written.append(name) or df)
    train, test = ml.vector_split(blocks, 5, seq.flat(), limit=limit)
    assert rows_of(train, "symbol", "date", "key") == rows_of(ml.bounded(parts.filter("split = 'train'"), limit), "symbol", "date", "key")
    assert rows_of(test, "symbol", "date") == rows_of(parts.filter("split = 'test'"), "symbol", "date")
    assert not written and "Exchange" not in test._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("together", [3, 10_000])
def test_blocks_of_smoothed_rows_equal_windows_over_labelled_rows(spark, monkeypatch, together):
    """Also where a symbol comes in several Arrow batches, has no label at all, or no symbol or date."""
    monkeypatch.setattr(seq, "BLOCK_ROWS", 8)
    rows = panel(spark).withColumn("up", F.when(F.coalesce(F.col("symbol") != "s2", F.lit(True)), F.col("up")))
    rows = rows.unionByName(spark.createDataFrame([("s4", None, -1.0, 1)], rows.schema)).repartition(2, "symbol").sortWithinPartitions("symbol", F.desc("date"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", together)
    try:
        got = seq.history_of_smoothed(rows, ["v"], F.col("up"), (5,), 6)
        labelled = rows.filter("up is not null")
        assert rows_of(got.cut(5).withColumnRenamed("label", "up"), "symbol", "date", "up", "window", "rn", "n_rows") == rows_of(
            plain(labelled, 5), "symbol", "date", "up", "window", "rn", "n_rows")
        assert got.rows_before(5, 0.8) == ordered_split(plain(labelled, 5)).filter("split = 'train'").count()
        newest = {r["symbol"]: (r["date"], r["vector"], r["n"]) for r in got.newest().collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["date"] is not None, r["date"])):
        want.setdefault(r["symbol"], []).append(r)
    assert newest == {k: (v[-1]["date"], [r["v"] for r in v[-6:]], min(6, len(v))) for k, v in want.items()}
    assert "Exchange" not in got.blocks._jdf.queryExecution().executedPlan().toString()


def test_every_training_row_of_the_split_is_given(spark):
    """More rows than the 40,000 that a fit once drew."""
    rows = spark.range(60_000).selectExpr("concat('s', id % 20) AS symbol", "date_add(date'2000-01-01', cast(id / 20 as int)) AS date", "id / 7 AS v", "cast(id % 2 as int) AS up")
    train, test = ml.vector_split(seq.history(rows, ["v"], F.col("up"), (5,)), 5, seq.flat())
    assert train.count() == 20 * 2396 and test.count() == 20 * 599


def test_training_csv_is_written_from_the_partitions_it_comes_in(spark, tmp_path):
    from marketspark.sources import writers

    rows = spark.range(60).selectExpr("concat('s', id % 6) AS symbol", "date_add(date'2024-01-01', cast(-id as int)) AS date", "id / 4 AS v", "if(id % 5 = 0, 'test', 'train') AS split")
    writers.export_training_csv(rows.repartition(3, "symbol"), str(tmp_path / "csv"))
    files = sorted((tmp_path / "csv").glob("split=*/*.csv.gz"))
    assert 2 <= len(files) <= 6
    back = writers.read_training_csv(spark, str(tmp_path / "csv"), "symbol string, date date, v double, split string")
    assert rows_of(back, *rows.columns) == rows_of(rows, *rows.columns)
    for f in files:
        got = [(r[0], r[1]) for r in spark.read.schema("symbol string, date date, v double").option("header", True).csv(str(f)).collect()]
        assert got == sorted(got) and got
