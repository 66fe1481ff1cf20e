"""Queries over windows, encoders, clusters and models.

Where a model is trained the result depends on the learner's random draws, so
those queries have no SQL twin; the data they are trained on and the arithmetic
of their scores are checked by twins of their own.  Trees, depths, rounds,
iterations, restarts and cluster counts are the library's defaults.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.arrays import patches
from ..operators import cluster as cl
from ..operators import encoders as enc
from ..operators import indicators as ind
from ..operators import labels as lab
from ..operators import models as ml
from ..operators import stats as st
from ..operators.perceptron import Network
from ..operators.sequences import flat, history_of_smoothed, last_returns, sequence_windows
from ..runtime import shared_dir
from ..schemas import CLUSTER8, DL20, SEQ4
from ..sources import views
from . import model_reports as rep
from .bar_queries import TRAINING
from .bar_sql import DASH_ROWS, NATIVE, W
from .registry import BARS, SYMBOLS, query, with_ctes
from .stat_queries import _PROFILE, dash, profile

_DASH = (*NATIVE, DASH_ROWS)


@query("x29_sequence_windows", with_ctes(*_DASH, f"""seq AS (SELECT symbol, "date",
  list(ret) OVER s AS r, list(volatility) OVER s AS v FROM dash WINDOW s AS ({W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))""", body="""
SELECT symbol, "date", round(r[1], 8) + 0 AS oldest_ret, round(v[20], 8) AS newest_volatility,
       round(list_sum(r), 7) + 0 AS ret_sum FROM seq WHERE len(r) = 20"""))
def x29(spark, sf):
    rows = sequence_windows(dash(spark, sf), SEQ4, 20)
    total = F.aggregate("window", F.lit(0.0), lambda acc, x: acc + x[0])
    return rows.select("symbol", "date", F.round(F.col("window")[0][0], 8).alias("oldest_ret"),
                       F.round(F.col("window")[19][3], 8).alias("newest_volatility"), F.round(total, 7).alias("ret_sum"))


@query("m19_patches", with_ctes(*_DASH, f"""seq AS (SELECT symbol, "date", list(ret) OVER s AS r FROM dash
  WINDOW s AS ({W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))""", body="""
SELECT symbol, "date", CAST(i AS INTEGER) AS patch, round(r[i * 3 + 1], 8) + 0 AS first_ret, round(r[i * 3 + 5], 8) + 0 AS last_ret
FROM seq, range(9) p(i) WHERE len(r) = 30"""))
def m19(spark, sf):
    rows = sequence_windows(dash(spark, sf), SEQ4, 30)
    cut = rows.select("symbol", "date", F.posexplode(patches(F.col("window"), 30, 5, 3)).alias("patch", "p"))
    return cut.select("symbol", "date", "patch", F.round(F.col("p")[0], 8).alias("first_ret"), F.round(F.col("p")[16], 8).alias("last_ret"))


_ATTENTION = """tail AS (SELECT symbol, "date", ret, row_number() OVER (PARTITION BY symbol ORDER BY "date" DESC) AS age,
    count(*) OVER (PARTITION BY symbol) AS n FROM dash),
scored AS (SELECT *, ret * first_value(ret) OVER (PARTITION BY symbol ORDER BY age) / sqrt(20) AS score FROM tail WHERE age <= 20 AND n >= 20),
powers AS (SELECT *, exp(score - max(score) OVER (PARTITION BY symbol)) AS e FROM scored),
attention AS (SELECT *, e / sum(e) OVER (PARTITION BY symbol) AS weight FROM powers)"""


def attention(spark, sf):
    return enc.self_attention(last_returns(dash(spark, sf), 20), 20)


@query("m16_self_attention", with_ctes(*_DASH, _ATTENTION, body="""
SELECT symbol, round(sum(weight * ret), 8) + 0 AS context, round(max(weight), 8) AS top_weight,
       round(max(CASE WHEN age = 1 THEN weight END), 8) AS last_weight FROM attention GROUP BY symbol"""))
def m16(spark, sf):
    return attention(spark, sf).select(
        "symbol", F.round("context", 8).alias("context"), F.round(F.array_max("weights"), 8).alias("top_weight"),
        F.round(F.element_at("weights", -1), 8).alias("last_weight"))


@query("t7_top_attention_days", with_ctes(*_DASH, _ATTENTION, body="""
SELECT symbol, CAST(place AS INTEGER) AS place, "date", round(ret * 100, 6) + 0 AS return_pct, round(weight, 8) AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY weight DESC, "date" DESC) AS place FROM attention) WHERE place <= 5"""))
def t7(spark, sf):
    return enc.top_attention_days(attention(spark, sf)).withColumns(
        {"return_pct": F.round("return_pct", 6), "weight": F.round("weight", 8)})


@query("m17_transformer_encoding")
def m17(spark, sf):
    return enc.encode_windows(dash(spark, sf), SEQ4, 20, {"code": enc.transformer_kernel(20, 4)})


@query("y2_window_encoders")
def y2(spark, sf):
    return enc.encode_windows(dash(spark, sf), SEQ4, 30, {
        "patch_code": enc.on_patches(enc.patch_kernel(9, 20), 5, 3), "multihead_code": enc.on_newest(enc.multihead_kernel(20, 4), 20)})


# Deterministic predictions, so that the score arithmetic has a SQL twin.
_RULE = f"""preds AS (SELECT symbol, "date", CASE WHEN ahead > 0.01 THEN 1 WHEN ahead < -0.01 THEN -1 ELSE 0 END AS label,
  CASE WHEN ret_5 > 0.01 THEN 1 WHEN ret_5 < -0.01 THEN -1 ELSE 0 END AS prediction,
  CASE WHEN ret_20 > 0.01 THEN 1 WHEN ret_20 < -0.01 THEN -1 ELSE 0 END AS prediction20,
  row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY symbol) AS n_rows
  FROM (SELECT d.*, b.ahead FROM dash d JOIN (SELECT symbol, "date", lead("close", 5) OVER ({W}) / "close" - 1 AS ahead FROM l3) b
        USING (symbol, "date")) WHERE ahead IS NOT NULL)"""


def _rule(column):
    return F.when(F.col(column) > 0.01, 1).when(F.col(column) < -0.01, -1).otherwise(0)


def rule_predictions(spark, sf):
    rows = ind.feature_frame(views.daily_bars(spark, sf), "dash", targets={"label": lab.direction()}, rank=True)
    return rows.withColumn("prediction", _rule("ret_5")).withColumn("prediction20", _rule("ret_20"))


@query("a23_accuracy", with_ctes(*_DASH, _RULE, body="""
SELECT symbol, round(avg(CAST(label = prediction AS INTEGER)), 8) AS accuracy, count(*) AS n FROM preds GROUP BY symbol"""))
def a23(spark, sf):
    return ml.accuracy(rule_predictions(spark, sf), "symbol").withColumn("accuracy", F.round("accuracy", 8))


_REPORT = """counted AS (SELECT c AS label, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (prediction = c) AS pp,
  count(*) FILTER (label = c) AS support FROM preds, (VALUES (-1), (0), (1)) v(c) GROUP BY c),
report AS (SELECT label, coalesce(CAST(tp AS DOUBLE) / nullif(pp, 0), 0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0) AS recall,
  coalesce(2 * CAST(tp AS DOUBLE) / nullif(pp + support, 0), 0) AS f1, support FROM counted)"""


@query("a24_class_report", with_ctes(*_DASH, _RULE, _REPORT, body="""
SELECT label, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support,
       round(avg(f1) OVER (), 8) AS macro_f1 FROM report"""))
def a24(spark, sf):
    report = ml.class_report(rule_predictions(spark, sf), [-1, 0, 1])
    macro = ml.macro_f1(report).select("macro_f1").scalar()
    return report.select("label", *[F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support",
                         F.round(macro, 8).alias("macro_f1"))


@query("a25_mean_absolute_error", with_ctes(*_DASH, f"""pairs AS (SELECT log_ret AS prediction, lead(log_ret) OVER ({W}) AS label FROM dash)""", body="""
SELECT round(avg(abs(prediction - label)), 8) AS mae FROM pairs"""))
def a25(spark, sf):
    from ..functions.rolling import by_symbol

    rows = dash(spark, sf).select(F.col("log_ret").alias("prediction"), F.lead("log_ret").over(by_symbol()).alias("label"))
    return ml.mean_absolute_error(rows).withColumn("mae", F.round("mae", 8))


@query("a26_cross_validation_summary", with_ctes(*_DASH, _RULE, """scores AS (SELECT fold, avg(CAST(label = prediction AS INTEGER)) AS accuracy
  FROM preds, range(1, 6) f(fold)
  WHERE rn - 1 >= n_rows - (n_rows // 6) * (6 - fold) AND rn - 1 < n_rows - (n_rows // 6) * (5 - fold) GROUP BY fold)""", body="""
SELECT round(avg(accuracy), 4) AS cv_mean, round(stddev_pop(accuracy), 4) AS cv_std FROM scores"""))
def a26(spark, sf):
    tested = lab.walk_forward(rule_predictions(spark, sf)).filter("role = 'test'")
    return ml.cv_summary(ml.accuracy(tested, "fold"))


@query("t8_best_parameter", with_ctes(*_DASH, _RULE, body="""
SELECT CASE WHEN a5 >= a20 THEN 5 ELSE 20 END AS best, round(greatest(a5, a20), 8) AS score FROM (
  SELECT avg(CAST(label = prediction AS INTEGER)) AS a5, avg(CAST(label = prediction20 AS INTEGER)) AS a20 FROM preds)"""))
def t8(spark, sf):
    rows = rule_predictions(spark, sf)
    scores = rows.agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("s5"),
                      F.avg((F.col("label") == F.col("prediction20")).cast("int")).alias("s20"))
    table = scores.select(F.explode(F.array(
        F.struct(F.lit(5).alias("param"), F.lit(0).alias("place"), F.col("s5").alias("score")),
        F.struct(F.lit(20).alias("param"), F.lit(1).alias("place"), F.col("s20").alias("score")))).alias("c")).select("c.*")
    return ml.best_parameter(table).withColumn("score", F.round("score", 8))


# Clusters given by the market of a symbol, for the parts that have a twin.
_ASSIGNED = (SYMBOLS, *_PROFILE, """assigned AS (SELECT p.*, market AS cluster FROM profile8 p JOIN symbols USING (symbol)),
summary AS (SELECT cluster, round(avg(ann_return), 6) + 0 AS ann_return, round(avg(ann_vol), 6) + 0 AS ann_vol, round(avg(sharpe), 6) + 0 AS sharpe,
  round(avg(max_dd), 6) + 0 AS max_dd, round(avg(rsi_mean), 6) + 0 AS rsi_mean, round(avg(momentum_20), 6) + 0 AS momentum_20,
  round(avg(vol_ratio), 6) + 0 AS vol_ratio, round(avg(skewness), 6) + 0 AS skewness FROM assigned GROUP BY cluster),
titles AS (SELECT cluster, CASE WHEN ann_return > 0.15 AND ann_vol < 0.25 THEN '성장형 안정주 📈'
  WHEN ann_return > 0.10 AND momentum_20 > 0.05 THEN '모멘텀 강세주 🚀' WHEN ann_return < -0.05 AND max_dd < -0.20 THEN '하락 위험주 ⚠️'
  WHEN ann_vol > 0.35 THEN '고변동성 투기주 🎲' WHEN abs(ann_return) < 0.05 AND ann_vol < 0.20 THEN '저변동 방어주 🛡️'
  WHEN rsi_mean > 65 THEN '과매수 구간 🔴' WHEN rsi_mean < 40 THEN '과매도 반등 후보 🟢' ELSE '중립·관망 ➖' END AS cluster_name FROM summary)""")


def assigned(spark, sf):
    listed = views.symbols(spark, sf).select("symbol", F.col("market").alias("cluster"))
    return profile(spark, sf).join(listed, "symbol")


@query("a13_cluster_summary", with_ctes(*_ASSIGNED, body="SELECT * FROM summary"))
def a13(spark, sf):
    return cl.summary(assigned(spark, sf), 6)


@query("f20_cluster_names", with_ctes(*_ASSIGNED, body="SELECT * FROM titles"))
def f20(spark, sf):
    return cl.named(cl.summary(assigned(spark, sf), 6)).select("cluster", "cluster_name")


@query("j3_cluster_name_join", with_ctes(*_ASSIGNED, body="SELECT symbol, cluster, cluster_name FROM assigned JOIN titles USING (cluster)"))
def j3(spark, sf):
    rows = assigned(spark, sf)
    return cl.with_cluster_names(rows, cl.summary(rows, 6)).select("symbol", "cluster", "cluster_name")


@query("a28_distinct_clusters", with_ctes(SYMBOLS, BARS, body="""
SELECT count(DISTINCT market) AS clusters FROM symbols WHERE symbol IN (SELECT symbol FROM bars)"""))
def a28(spark, sf):
    return assigned(spark, sf).agg(F.countDistinct("cluster").alias("clusters"))


def _z(column):
    return f"(p.{column} - avg(p.{column}) OVER ()) / stddev_pop(p.{column}) OVER ()"


_SCALED = f"scaled AS (SELECT symbol, {', '.join(f'{_z(c)} AS {c}' for c in CLUSTER8)} FROM profile8 p)"


@query("m1_standardised_features", with_ctes(*_PROFILE, _SCALED, body=f"""
SELECT symbol, {', '.join(f'round({c}, 7) + 0 AS {c}' for c in CLUSTER8)} FROM scaled"""))
def m1(spark, sf):
    v = vector_to_array("scaled")
    return cl.standardise(profile(spark, sf)).select(
        "symbol", *[F.round(F.get(v, F.lit(i)), 7).alias(c) for i, c in enumerate(CLUSTER8)])


@query("m4_silhouette", with_ctes(SYMBOLS, *_PROFILE, _SCALED, f"""points AS (SELECT s.*, market AS cluster FROM scaled s JOIN symbols USING (symbol)),
gaps AS (SELECT x.symbol, x.cluster AS own, y.cluster AS other, sum(sqrt({' + '.join(f'power(x.{c} - y.{c}, 2)' for c in CLUSTER8)})) AS total,
  count(*) AS n FROM points x JOIN points y ON true GROUP BY 1, 2, 3),
parts AS (SELECT symbol, own, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b
  FROM gaps GROUP BY 1, 2)""", body="""
SELECT symbol, round(coalesce((b - a) / greatest(a, b), 0), 6) + 0 AS silhouette FROM parts"""))
def m4(spark, sf):
    region = views.table(spark, sf, "region").select(F.col("r_name").alias("cluster"), F.col("r_regionkey").alias("id"))
    points = assigned(spark, sf).join(region, "cluster").drop("cluster").withColumnRenamed("id", "cluster")
    return cl.euclidean_silhouette_parts(cl.standardise(points), any_number=True).select("symbol", F.round("silhouette", 6).alias("silhouette"))


_SQUARED = " + ".join(f"power(x.{c} - y.{c}, 2)" for c in CLUSTER8)


@query("m4_squared_silhouette", with_ctes(SYMBOLS, *_PROFILE, _SCALED, f"""points AS (SELECT s.*, market AS cluster FROM scaled s JOIN symbols USING (symbol)),
gaps AS (SELECT x.symbol, x.cluster AS own, y.cluster AS other, sum({_SQUARED}) AS total, count(*) AS n FROM points x JOIN points y ON true GROUP BY 1, 2, 3),
parts AS (SELECT symbol, own, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b
  FROM gaps GROUP BY 1, 2)""", body="""
SELECT symbol, round(coalesce((b - a) / greatest(a, b), 0), 6) + 0 AS silhouette FROM parts"""))
def m4_squared(spark, sf):
    points = assigned(spark, sf)
    return cl.silhouette_parts(cl.standardise(points)).select("symbol", F.round("silhouette", 6).alias("silhouette"))


def scaled_profiles(spark, sf):
    return cl.standardise(profile(spark, sf))


@query("m2_kmeans")
def m2(spark, sf):
    return cl.fit(scaled_profiles(spark, sf), 4).select("symbol", "cluster")


@query("m3_hierarchical")
def m3(spark, sf):
    return cl.fit(scaled_profiles(spark, sf), 4, "hierarchical").select("symbol", "cluster")


@query("m5_principal_coordinates")
def m5(spark, sf):
    return cl.pca_2d(scaled_profiles(spark, sf)).select("symbol", F.round("PC1", 6).alias("PC1"), F.round("PC2", 6).alias("PC2"))


@query("m6_best_cluster_count")
def m6(spark, sf):
    rows = cl.optimal_k(scaled_profiles(spark, sf))
    best = rows.agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("b")).select("b").scalar()
    return rows.withColumn("best", F.col("k") == best)


@query("m29_cluster_report")
def m29(spark, sf):
    rows = cl.pca_2d(cl.fit(scaled_profiles(spark, sf), 4))
    score = cl.silhouette(rows).select(F.round("silhouette", 4)).scalar()
    out = cl.with_cluster_names(rows, cl.summary(rows)).withColumn("silhouette", score)
    return out.select("symbol", "cluster", "cluster_name", "silhouette", F.round("PC1", 6).alias("PC1"), F.round("PC2", 6).alias("PC2"))


def _direction(spark, sf, **settings):
    s = ml.Settings(**settings)
    return s, ml.training_rows(views.daily_bars(spark, sf), s)


def _holdout_query(name, **settings):
    @query(name)
    def run(spark, sf):
        s, rows = _direction(spark, sf, **settings)
        _, predictions = ml.holdout(rows, s)
        return ml.class_report(predictions, [0.0, 1.0, 2.0])

    return run


_holdout_query("m7_random_forest", kind="rf")
_holdout_query("m8_gradient_boosting", kind="gb")
_holdout_query("m9_boosted_trees", kind="xgb")
_holdout_query("m13_perceptron", kind="mlp", profile="dl20")


@query("m10_train_and_validate")
def m10(spark, sf):
    s, rows = _direction(spark, sf)
    return ml.training_report(rows, s).withColumn("value", F.round("value", 6))


@query("m11_score_latest")
def m11(spark, sf):
    s, rows = _direction(spark, sf)
    model, _ = ml.holdout(rows, s)
    return ml.score_latest(model, views.daily_bars(spark, sf), s)


@query("m12_save_and_load", with_ctes(*TRAINING, body="""
SELECT count(*) AS n, count(*) AS equal, 5 AS forward_days FROM training
WHERE rn > floor(CAST(n_rows AS DOUBLE) * CAST(0.8 AS DOUBLE))"""))
def m12(spark, sf):
    s, rows = _direction(spark, sf)
    model, predictions = ml.holdout(rows, s)
    path = shared_dir(spark, "model")
    ml.save(model, s, path, rows)
    again, loaded = ml.load(spark, path)
    test = lab.ordered_split(rows).filter("split = 'test'")
    both = predictions.select("symbol", "date", F.col("prediction").alias("before")).join(
        again.transform(test).select("symbol", "date", F.col("prediction").alias("after")), ["symbol", "date"])
    return both.agg(F.count("*").alias("n"), F.sum((F.col("before") == F.col("after")).cast("int")).alias("equal")).withColumn(
        "forward_days", F.lit(loaded.forward_days))


@query("t6_feature_importance")
def t6(spark, sf):
    s, rows = _direction(spark, sf)
    model, _ = ml.holdout(rows, s)
    return ml.importances(model, rows)


@query("m14_window_classifier")
def m14(spark, sf):
    """Held-out report of the window model, and what it says of each symbol's newest window."""
    features = ind.feature_frame(views.daily_bars(spark, sf), "dl20", targets={"label": lab.direction()}, labelled=False)
    rows = history_of_smoothed(features, DL20, F.col("label") + 1, (20,), 20)
    train, test = ml.vector_split(rows, 20, flat())
    model = ml.fit_vectors(train, Network(ml.Settings.hidden, 3, rounds=ml.Settings.max_iter))
    report = ml.class_report(model.transform(test), [0.0, 1.0, 2.0])
    newest = ml.score_windows(model, rows.newest(), 20)
    cells = F.explode(F.array(*[F.struct(F.concat_ws(" ", (F.col("label") - 1).cast("int").cast("string"), F.lit(c)).alias("name"), F.col(c).alias("value")) for c in ("precision", "recall", "f1")]))
    return report.select(cells.alias("c"), "support").select(
        F.lit("class").alias("part"), "c.name", F.lit(None).cast("string").alias("signal"), "c.value", F.col("support").alias("n")).unionByName(newest.select(
            F.lit("newest").alias("part"), F.col("symbol").alias("name"), "signal", F.array_max("p").alias("value"), F.lit(None).cast("bigint").alias("n")))


def _dash_once(spark, sf):
    """Feature rows; the reports write what they read of them once."""
    return dash(spark, sf)


@query("m15_sequence_report")
def m15(spark, sf):
    return rep.sequence_report(_dash_once(spark, sf))


@query("m18_transformer_report")
def m18(spark, sf):
    return rep.transformer_report(_dash_once(spark, sf))


@query("m20_patch_report")
def m20(spark, sf):
    return rep.patch_report(_dash_once(spark, sf))


@query("m21_multihead_report")
def m21(spark, sf):
    return rep.multihead_report(_dash_once(spark, sf))


@query("m24_backtest_report")
def m24(spark, sf):
    return rep.backtest_report(_dash_once(spark, sf))
