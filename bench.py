"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times into the noop
sink; the median counts.  Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS,
BENCH_ONLY (comma-separated names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketspark.plans import QUERIES  # noqa: E402

HEADLINE = [
    "x3_moving_averages", "x24_dashboard_frame", "x22_ml_feature_frame", "m28_training_set", "a29_history_profile",
    "a1_sliding_ohlcv", "a2_volume_anomaly", "a3_minute_ohlcv", "a4_running_volume_alerts", "m22_timeseries_report",
    "m23_backtest", "m25_forecast_band", "a19_correlation_matrix", "m16_self_attention", "x29_sequence_windows",
    "m17_transformer_encoding", "s4_consumer_scan", "s8_daily_price_html", "k9_document_update", "j7_crawl_analysis_relation",
    "c6_portfolio_snapshots", "g2_sliding_window_stream", "a4_alert_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in only or HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
