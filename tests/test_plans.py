"""Shape of physical plans and habits the library keeps."""

import os
import re

import pytest

from marketspark.operators import indicators as ind
from marketspark.operators import ticks as tk
from marketspark.sources import views

SF_DIR = "/root/testdata/sf0.001"
ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "marketspark")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_bars(spark, tmp_path):
    path = str(tmp_path / "bars")
    views.daily_bars(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_indicators_share_one_exchange_and_sort(stored_bars):
    text = plan(ind.native_indicators(stored_bars))
    assert text.count("Exchange") == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_labelled_ranked_features_add_no_exchange(stored_bars):
    from marketspark.operators.labels import direction

    text = plan(ind.feature_frame(stored_bars, "ml20", targets={"label": direction()}, rank=True))
    assert text.count("Exchange") == 1


def test_bars_are_hash_aggregated(spark):
    text = plan(views.daily_bars(spark, SF_DIR))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    assert "SortAggregate" not in plan(tk.window_bars(views.ticks(spark, SF_DIR), "5 minutes", "1 minute"))


def test_scan_reads_only_needed_columns(spark):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(tk.with_volume(views.ticks(spark, SF_DIR)).select("volume"))).group(1)
    assert read == "value:double"


def test_running_sum_windows_are_per_range(spark):
    text = plan(tk.running_volume(views.ticks(spark, SF_DIR)))
    per_tick = [line for line in text.splitlines() if "Window [" in line and "event_id" in line]
    assert per_tick and all("__range" in line for line in per_tick)


def test_forecast_ranking_is_cut_before_the_shuffle(stored_bars):
    from marketspark.operators.stats import forecast_band

    assert "WindowGroupLimit" in plan(forecast_band(stored_bars))


def test_no_rows_are_pulled_to_the_driver():
    """collect() only where the rows are a class, fold or settings table or a ticker list; no
    crossJoin, localCheckpoint, toPandas or RDD code anywhere, but for the blocks that boosting holds."""
    found = []
    for folder, _, files in os.walk(ROOT):
        for name in files if os.path.basename(folder) != "llm" else []:  # optional part, with tests of its own
            if name.endswith(".py"):
                for line in open(os.path.join(folder, name), encoding="utf-8"):
                    if re.search(r"\.collect\(\)|toPandas|crossJoin|localCheckpoint|\.rdd\b|mapPartitions", line):
                        found.append((name, line.strip()))
    assert sorted({name for name, _ in found}) == ["boosting.py", "model_reports.py", "models.py", "stat_queries.py"], found
