"""Registered model queries fit with the library's own trees, rounds, iterations, restarts and cluster counts."""

from dataclasses import fields

import pytest

from marketspark.operators.boosting import Boosting
from marketspark.operators.perceptron import Network
from marketspark.plans import QUERIES
from marketspark.plans import model_queries as mq


class Fitted(Exception):
    """Carries the arguments of a stubbed fit."""


def stop(*args, **kwargs):
    raise Fitted(args, kwargs)


@pytest.mark.parametrize("name, kind", [
    ("m7_random_forest", "rf"), ("m8_gradient_boosting", "gb"), ("m9_boosted_trees", "xgb"), ("m13_perceptron", "mlp"), ("m10_train_and_validate", "rf"),
    ("m11_score_latest", "rf"), ("m12_save_and_load", "rf"), ("t6_feature_importance", "rf")])
def test_classifiers(monkeypatch, name, kind):
    monkeypatch.setattr(mq.views, "daily_bars", lambda *a: None)
    monkeypatch.setattr(mq.ml, "training_rows", lambda *a: None)
    for fit in ("holdout", "cross_validate"):
        monkeypatch.setattr(mq.ml, fit, stop)
    with pytest.raises(Fitted) as e:
        QUERIES[name](None, None)
    s = e.value.args[0][1]
    assert s.kind == kind
    assert all(getattr(s, f.name) == f.default for f in fields(s) if f.name not in ("kind", "profile"))


@pytest.mark.parametrize("name, report", [
    ("m15_sequence_report", "sequence_report"), ("m18_transformer_report", "transformer_report"), ("m20_patch_report", "patch_report"),
    ("m21_multihead_report", "multihead_report"), ("m24_backtest_report", "backtest_report")])
def test_reports(monkeypatch, name, report):
    monkeypatch.setattr(mq, "_dash_once", lambda *a: None)
    monkeypatch.setattr(mq.rep, report, stop)
    with pytest.raises(Fitted) as e:
        QUERIES[name](None, None)
    assert e.value.args == ((None,), {})


@pytest.mark.parametrize("name, fit, given", [("m2_kmeans", "fit", (None, 4)), ("m29_cluster_report", "fit", (None, 4)), ("m6_best_cluster_count", "optimal_k", (None,))])
def test_clusters(monkeypatch, name, fit, given):
    monkeypatch.setattr(mq, "scaled_profiles", lambda *a: None)
    monkeypatch.setattr(mq.cl, fit, stop)
    with pytest.raises(Fitted) as e:
        QUERIES[name](None, None)
    assert e.value.args == (given, {})


def test_networks_and_rounds():
    """What the kinds stand for: widths, rounds and rates of the networks and trees."""
    assert mq.ml.rounds_of(mq.ml.Settings(kind="gb")) == Boosting(200, 4, 0.05, rows=0.8)
    assert mq.ml.rounds_of(mq.ml.Settings(kind="xgb")) == Boosting(250, 4, 0.05, rows=0.9, columns=0.9, newton=True, l2=1.0, least_curvature=1.0)
    assert (mq.ml.Settings.hidden, mq.ml.Settings.max_iter) == ((128, 64, 32), 300) and Network() == Network((128, 64, 32), 3, "relu", 300)
