"""Small inputs with results worked out by hand or by plain loops."""

import datetime as dt
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketspark.functions import dates, serving, text
from marketspark.operators import backtest as bt
from marketspark.operators import cluster as cl
from marketspark.operators import indicators as ind
from marketspark.operators import labels as lab
from marketspark.operators import models as ml
from marketspark.operators import scan
from marketspark.operators import stats as st
from marketspark.operators import ticks as tk
from marketspark.runtime import materialize
from marketspark.schemas import ML20, TICK
from marketspark.sources import ingest, messages


def bars(spark, closes, symbol="A", volumes=None, start=dt.date(2024, 1, 1)):
    rows = []
    for i, c in enumerate(closes):
        v = volumes[i] if volumes else 100
        rows.append((symbol, start + dt.timedelta(days=i), float(c), float(c) + 1, float(c) - 1, float(c), v))
    return spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume bigint")


def ticks(spark, rows):
    """rows: (event_id, seconds after 09:00, price, volume, change_pct)."""
    base = dt.datetime(2024, 1, 2, 9, 0, 0)
    data = [(i, "A", "A", "SIM", base + dt.timedelta(seconds=s), float(p), float(p), float(p), float(p), float(p), v, float(c))
            for i, s, p, v, c in rows]
    schema = ("event_id bigint, symbol string, name string, market string, event_time timestamp, price double, open double, "
              "high double, low double, close double, volume bigint, change_pct double")
    return spark.createDataFrame(data, schema)


def test_linear_then_flat_prices(spark):
    closes = list(range(100, 140)) + [139] * 30
    rows = ind.native_indicators(bars(spark, closes)).orderBy("date").collect()
    assert rows[3]["ma5"] is None and rows[4]["ma5"] == 102.0
    assert rows[58]["ma60"] is None and rows[59]["ma60"] is not None
    assert rows[69]["std20"] == pytest.approx(0.0) and rows[69]["bb_width"] == pytest.approx(0.0)
    smooth = ind.with_ewm(bars(spark, closes).select("symbol", "date", "close")).withColumn("rsi", ind.rsi()).orderBy("date").collect()
    assert smooth[0]["ema12"] == 100.0
    assert smooth[1]["ema12"] == pytest.approx(100 + 2 / 13)
    assert smooth[39]["rsi"] == pytest.approx(100.0)
    flat = ind.with_ewm(bars(spark, [5.0] * 10).select("symbol", "date", "close")).withColumn("rsi", ind.rsi()).orderBy("date").collect()
    assert flat[0]["rsi"] is None and flat[9]["rsi"] == pytest.approx(0.0)


def test_feature_frame_against_pandas(spark):
    rng = np.random.default_rng(3)
    closes = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.02, 150))), 2)
    volumes = [int(v) for v in rng.integers(10, 500, 150)]
    got = ind.feature_frame(bars(spark, closes, volumes=volumes), "ml20").orderBy("date").toPandas()
    c, v = pd.Series(closes), pd.Series(volumes, dtype=float)
    want = pd.DataFrame({"Returns": c / c.shift() - 1, "MA20_Ratio": c / (c.rolling(20).mean() + 1e-9), "Momentum_20": c / c.shift(20) - 1,
                         "Volatility": (c / c.shift() - 1).rolling(20).std(), "Volume_MA_Ratio": v / (v.rolling(20).mean() + 1e-9)})
    fast, slow = c.ewm(span=12, adjust=False).mean(), c.ewm(span=26, adjust=False).mean()
    want["MACD"] = (fast - slow) / (c + 1e-9)
    want["keep"] = c.rolling(60).mean().notna()
    want = want[want["keep"]].reset_index(drop=True)
    assert list(got.columns[3:]) == ML20 and len(got) == len(want) == 91
    for name in ("Returns", "MA20_Ratio", "Momentum_20", "Volatility", "Volume_MA_Ratio", "MACD"):
        np.testing.assert_allclose(got[name], want[name], rtol=1e-9, atol=1e-12)


def test_zero_volume_days_do_not_fail(spark):
    volumes = [0 if i in (5, 6) else 10 for i in range(25)]
    rows = ind.native_indicators(bars(spark, range(10, 35), volumes=volumes)).orderBy("date").collect()
    assert rows[6]["volume_change"] is None and rows[7]["volume_change"] is None
    assert rows[8]["volume_change"] == 0.0


def test_minimum_history(spark):
    short, long = bars(spark, [1.0], "one"), bars(spark, range(1, 22), "long")
    twenty = bars(spark, range(1, 21), "twenty")
    out = {r["symbol"]: r for r in st.history_profile(short.unionByName(long).unionByName(twenty)).collect()}
    assert set(out) == {"long", "twenty"}
    assert out["twenty"]["momentum_20"] == 0.0 and out["twenty"]["vol_ratio"] == 1.0
    assert out["long"]["momentum_20"] == 20.0


def test_next_business_day(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(dates.next_business_day(F.col("d")).alias("n")).collect()
    assert [r["n"] for r in rows] == [dt.date(2024, 1, 8)] * 3 + [dt.date(2024, 1, 9)]


def test_alignment_is_by_date(spark):
    a = bars(spark, [1, 2, 4, 8], "a").filter("date != '2024-01-02'")
    b = bars(spark, [1, 3, 9, 27], "b").filter("date != '2024-01-03'")
    returns = ind.native_indicators(a.unionByName(b)).select("symbol", "date", "ret")
    aligned = st.aligned_returns(returns, ["a", "b"]).collect()
    assert [r["date"] for r in aligned] == [dt.date(2024, 1, 4)]


def test_running_mean_alert(spark):
    rows = [(i, i, 10, 10, 0) for i in range(4)] + [(4, 4, 10, 100, 0)]
    alert = tk.volume_alerts(tk.running_volume(ticks(spark, rows))).collect()
    assert len(alert) == 1
    assert alert[0]["threshold_value"] == 56.0 and alert[0]["severity"] == "WARNING"
    assert alert[0]["message"] == "A(A) 거래량 급증: 100 (평균 28의 3.6배)"


@pytest.mark.parametrize("seconds, ranges", [(600, 7), (1, 7), (600, 1)])
def test_split_running_sum_equals_loop(spark, monkeypatch, seconds, ranges):
    """One symbol holding everything, with equal times: any split gives the same, and one second lies in several ranges."""
    found = []

    def kept(df, name):
        found.append(materialize(df, name))
        return found[-1]

    monkeypatch.setattr(scan, "materialize", kept)
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(ranges))
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = np.random.default_rng(5)
    rows = [(i, int(s), 10, int(v), 0) for i, (s, v) in enumerate(zip(rng.integers(0, seconds, 400), rng.integers(-5, 50, 400)))]
    got = {r["event_id"]: (r["total"], r["count"]) for r in tk.running_volume(ticks(session, rows)).collect()}
    sizes = [r["count"] for r in found[0].groupBy("__range").count().collect()]
    assert len(sizes) >= ranges - 1 and max(sizes) <= 3 * 400 / ranges
    total, count, want = 0, 0, {}
    for i, s, _, v, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        if v > 0:
            total, count = total + v, count + 1
            want[i] = (total, count)
    assert got == want


def test_window_edges_and_order(spark):
    rows = [(0, 59, 10, 1, 1), (1, 60, 11, 2, 2), (2, 61, 12, 3, 3), (4, 61, 14, 3, 3), (3, 119, 9, 4, 4)]
    out = {r["window_start"].minute: r for r in tk.minute_bars(ticks(spark, rows)).collect()}
    assert out[0]["event_count"] == 1 and out[1]["event_count"] == 4
    assert (out[1]["open"], out[1]["high"], out[1]["low"], out[1]["close"]) == (11.0, 14.0, 9.0, 9.0)


def test_anomaly_needs_six_ticks(spark):
    five = ticks(spark, [(i, i, 10, 10, 0) for i in range(4)] + [(4, 4, 10, 1000, 0)])
    seven = ticks(spark, [(i, i, 10, 10, 0) for i in range(6)] + [(6, 6, 10, 1000, 0)])
    assert tk.volume_anomalies(five).count() == 0 and tk.volume_anomalies(seven).count() == 1


def test_significant_move_keeps_the_bound(spark):
    rows = ticks(spark, [(0, 0, 1, 1, 2.0), (1, 1, 1, 1, 1.99), (2, 2, 1, 1, -2.0)])
    assert {r["event_id"]: r["filter_reason"] for r in tk.significant_moves(rows).collect()} == {0: "SURGE", 2: "PLUNGE"}


def test_snapshot_json(spark):
    body = json.dumps({"data": [{"symbolCode": "A005930", "name": "x", "tradePrice": 75000.9, "change": "RISE", "changeRate": 0.0027},
                                {"symbolCode": "A000660", "tradePrice": None}]})
    rows = ingest.snapshot_json(spark.createDataFrame([("KOSPI", body)], "market string, body string")).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["symbol_code"], row["trade_price"], row["change"], row["change_rate"], row["change_price"]) == ("005930", 75000, "상승", 0.27, 0)


def test_snapshot_html_skips_layout_rows(spark):
    cells = "".join(f"<td>{c}</td>" for c in ["1,234", "x", "-1.50%", "5", "99", "8", "9", "7,000"])
    good = f'<tr><td>1</td><td><a href="/item/main.nhn?code=005930">A &amp; B</a></td>{cells}</tr>'
    nine = good.replace("<td>7,000</td>", "")
    page = f'<table class="type_2"><tr><th>h</th></tr>{good}{nine}<tr>{"<td>1</td>" * 10}</tr></table>'
    rows = ingest.snapshot_html(spark.createDataFrame([("KOSPI", page)], "market string, body string")).collect()
    assert [tuple(r) for r in rows] == [("005930", "A & B", "KOSPI", 1234, -1.5, 7000, 99)]


def test_macro_payloads(spark):
    row = {"STAT_NAME": "n", "ITEM_CODE1": "c", "CYCLE": "M", "TIME": "202401", "DATA_VALUE": "", "UNIT_NAME": "%"}
    good = json.dumps({"StatisticSearch": {"row": [row, {**row, "DATA_VALUE": "3.5"}]}})
    bad = json.dumps({"RESULT": {"CODE": "INFO-200"}})
    rows = ingest.macro_json(spark.createDataFrame([("a", good), ("b", bad)], "stat_code string, body string")).collect()
    assert sorted((r["stat_code"], r["value"]) for r in rows) == [("a", 0.0), ("a", 3.5)]


def test_strict_decoding(spark):
    event = {f.name: (1 if f.dataType.typeName() == "long" else 1.0 if f.dataType.typeName() == "double" else "x") for f in TICK.fields}
    without_time = {k: v for k, v in event.items() if k != "timestamp"}
    values = [json.dumps(event), json.dumps(without_time), json.dumps({**event, "more": 1}), "{broken",
              json.dumps({k: v for k, v in event.items() if k != "market"}), "[1]"]
    raw = spark.createDataFrame([("k", v, 0, i) for i, v in enumerate(values)], "key string, value string, partition int, offset bigint")
    good, bad = messages.split_good_bad(raw, TICK)
    assert sorted(r["_kafka_offset"] for r in good.collect()) == [0, 1]
    assert {r["offset"]: r["error"] for r in bad.collect()} == {2: "unknown field", 3: "malformed", 4: "missing field", 5: "malformed"}


def test_prediction_responses(spark):
    cases = [
        ('[{"predicted_label":"BUY","probabilities":{"BUY":0.6,"SELL":0.1,"HOLD":0.3}}]', ("BUY", 0.6, 0.1, 0.3)),
        ('{"prediction":"-1","prediction_scores":{"1":0.2,"-1":0.7,"0":0.1}}', ("SELL", 0.2, 0.7, 0.1)),
        ('{"predicted_label":"hold","probabilities":[0.2,0.3,0.5]}', ("HOLD", 0.2, 0.3, 0.5)),
        ('"text"', ("HOLD", 0.0, 0.0, 1.0)),
        ('{"predicted_label":"BUY"}', ("BUY", 0.0, 0.0, 0.0)),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, r string")
    got = df.select("i", serving.parse_response(F.col("r")).alias("p")).orderBy("i").select(
        "p.signal", "p.probabilities.BUY", "p.probabilities.SELL", "p.probabilities.HOLD").collect()
    for row, (_, want) in zip(got, cases):
        assert tuple(row) == want


def test_number_parsing(spark):
    df = spark.createDataFrame([("1,234원", "-1.25%"), ("+7.9", "x"), ("", "+3"), ("-5", "1,000.5")], "a string, b string")
    rows = df.select(text.parse_int(F.col("a")).alias("a"), text.parse_float(F.col("b")).alias("b")).collect()
    assert [tuple(r) for r in rows] == [(1234, -1.25), (7, 0.0), (0, 3.0), (5, 1000.5)]


@pytest.mark.parametrize("lag", [0, 1])
def test_backtest_against_loop(spark, lag):
    p = [0.6, 0.5, 0.56, 0.54, 0.9, 0.55, 0.1, 0.7, 0.8, 0.2, 0.6, 0.6]
    r = [0.1, -0.2, 0.05, 0.3, -0.5, 0.2, 0.1, -1.0, 0.4, 0.2, -0.1, 0.3]
    rows = spark.createDataFrame([("A", dt.date(2024, 1, 1) + dt.timedelta(days=i), a, b) for i, (a, b) in enumerate(zip(p, r))],
                                 "symbol string, date date, p double, ret double")
    got = bt.backtest_metrics(bt.equity_curve(rows, return_lag=lag)).first()
    used = list(zip(p, r if lag == 0 else r[1:]))
    equity, hold, peak, worst, daily = 1.0, 1.0, 1.0, 0.0, []
    for a, b in used:
        step = b if a >= 0.55 else 0.0
        equity, hold = equity * (1 + step), hold * (1 + b)
        daily.append(step)
        peak = max(peak, equity)
        worst = min(worst, (equity - peak) / peak)
    assert got["total_return"] == pytest.approx(equity - 1) and got["buy_hold_return"] == pytest.approx(hold - 1)
    assert got["mdd"] == pytest.approx(worst) and got["trades"] == sum(a >= 0.55 for a, _ in used)
    assert got["sharpe"] == pytest.approx(np.mean(daily) / (np.std(daily) + 1e-9) * math.sqrt(252))


def test_folds_respect_the_gap(spark):
    ranked = spark.range(60).select(F.lit("A").alias("symbol"), (F.col("id") + 1).alias("rn"), F.lit(60).alias("n_rows"))
    rows = lab.walk_forward(ranked, 5, 5).groupBy("fold", "role").agg(F.min("rn").alias("a"), F.max("rn").alias("b")).collect()
    at = {(r["fold"], r["role"]): (r["a"], r["b"]) for r in rows}
    assert at[(1, "train")] == (1, 5) and at[(1, "test")] == (11, 20) and at[(5, "test")] == (51, 60)
    assert all(at[(f, "train")][1] + 5 < at[(f, "test")][0] for f in range(1, 6))


@pytest.mark.parametrize("block_rows", [3, 1000, None])
def test_silhouette_against_loop(spark, block_rows):
    """Blocks of all distances, or (None) squared distances from sums of whole clusters."""
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(1)
    points, labels = rng.normal(size=(20, 3)), [i % 3 for i in range(19)] + [7]
    df = spark.createDataFrame([(str(i), c, Vectors.dense(p)) for i, (p, c) in enumerate(zip(points, labels))], ["symbol", "cluster", "scaled"])
    df = df.withColumn("cluster", F.col("cluster").cast("int"))
    parts = cl.euclidean_silhouette_parts(df, block_rows) if block_rows else cl.silhouette_parts(df)
    assert parts.count() == 20
    got = {r["symbol"]: r["silhouette"] for r in parts.collect()}
    gap = ((points[:, None] - points[None]) ** 2).sum(-1) ** (0.5 if block_rows else 1.0)
    for i in range(20):
        same = [j for j in range(20) if labels[j] == labels[i] and j != i]
        if not same:
            assert got[str(i)] == 0.0
            continue
        a = gap[i, same].mean()
        b = min(gap[i, [j for j in range(20) if labels[j] == c]].mean() for c in set(labels) - {labels[i]})
        assert got[str(i)] == pytest.approx((b - a) / max(a, b))


def test_silhouettes_at_their_limits(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(str(i), 0, Vectors.dense([float(i)])) for i in range(5)], ["symbol", "cluster", "scaled"])
    assert [r["silhouette"] for r in cl.silhouette_parts(df).collect()] == [0.0] * 5
    monkeypatch.setattr(cl, "EUCLIDEAN_LIMIT", 4)
    with pytest.raises(ValueError):
        cl.euclidean_silhouette_parts(df)
    assert cl.optimal_k(df.limit(2)).count() == 0


def test_all_distances_of_any_number_of_points(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(str(i), i % 2, Vectors.dense([float(i * i)])) for i in range(9)], ["symbol", "cluster", "scaled"])
    df = df.withColumn("cluster", F.col("cluster").cast("int"))
    whole = sorted(cl.euclidean_silhouette_parts(df).collect())
    monkeypatch.setattr(cl, "EUCLIDEAN_LIMIT", 4)
    monkeypatch.setattr(cl, "CHUNK", 2)
    assert sorted(cl.euclidean_silhouette_parts(df, any_number=True).collect()) == whole


def test_class_report_with_absent_class(spark):
    rows = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    report = {r["label"]: r for r in ml.class_report(rows, [-1, 0, 1]).collect()}
    assert report[-1]["f1"] == 0.0 and report[-1]["support"] == 0
    assert report[0]["precision"] == pytest.approx(2 / 3) and report[1]["recall"] == 0.5
