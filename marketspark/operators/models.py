"""Direction classifiers over the panel: one model for all symbols.

Training data is materialised once to the shared folder and read by every fit.
A fit uses all labelled rows of its side of a split.  Folds are fitted side by side, as independent Spark jobs.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax_index
from ..functions.serving import probability_map
from ..functions.text import signal_of
from ..runtime import materialize, side_by_side
from . import boosting, forest, perceptron
from .indicators import contract, feature_frame, latest_features
from .labels import direction, ordered_split, walk_forward
from .sequences import History
from .stats import newest_rows

CLASSES = [-1, 0, 1]


@dataclass
class Settings:
    kind: str = "rf"
    forward_days: int = 5
    threshold: float = 0.01
    trees: int | None = None
    max_depth: int | None = None
    max_iter: int = 300
    hidden: tuple[int, ...] = (128, 64, 32)
    profile: str = "ml20"


def rounds_of(s: Settings) -> boosting.Boosting:
    if s.kind == "gb":
        return boosting.Boosting(rounds=s.trees or 200, depth=s.max_depth or 4, rows=0.8)
    return boosting.Boosting(rounds=s.trees or 250, depth=s.max_depth or 4, rows=0.9, columns=0.9, newton=True, l2=1.0, least_curvature=1.0)


@dataclass
class Fitted:
    """A learned model with the columns it reads; ``transform`` adds probability and prediction."""

    learned: forest.Forest | boosting.BoostedModel | perceptron.Perceptron
    columns: list[str]

    def transform(self, rows: DataFrame) -> DataFrame:
        if isinstance(self.learned, perceptron.Perceptron):
            return self.learned.transform(rows, F.array(*[F.col(c).cast("double") for c in self.columns]))
        return self.learned.transform(rows)

    def importances(self) -> list[float]:
        """One number a column; none for a perceptron."""
        return [] if isinstance(self.learned, perceptron.Perceptron) else self.learned.importances()


def bounded(rows: DataFrame, limit: int) -> DataFrame:
    """About ``limit`` of ``rows`` by a hash of symbol and date, all if they are fewer, with that hash as ``key``.  No query draws; it is for trials."""
    n = rows.count()
    if n > limit:
        rows = rows.where(F.pmod(F.xxhash64("symbol", "date", F.lit(5)), F.lit(1 << 30)) < int(limit / n * (1 << 30)))
    return rows.withColumn("key", F.xxhash64("symbol", "date"))


def training_rows(bars: DataFrame, s: Settings) -> DataFrame:
    """Ranked feature rows with a 0-based label, written once."""
    label = direction(s.forward_days, s.threshold) + 1
    rows = feature_frame(bars, s.profile, targets={"label": label}, rank=True)
    return materialize(rows.withColumn("label", F.col("label").cast("double")), "training")


def fit(train: DataFrame, s: Settings) -> Fitted:
    columns = contract(s.profile)
    rows = train.withColumn("key", F.xxhash64("symbol", "date"))
    if s.kind == "rf":
        learned = forest.fit(rows, columns, s.trees or 300, s.max_depth or 15)
    elif s.kind in ("gb", "xgb"):
        learned = boosting.fit(rows, columns, rounds_of(s))
    elif s.kind == "mlp":
        vectors = rows.withColumn("vector", F.array(*[F.col(c).cast("double") for c in columns]))
        learned = perceptron.fit(vectors, perceptron.Network(hidden=s.hidden, rounds=s.max_iter))
    else:
        raise ValueError(f"unknown model kind {s.kind}")
    return Fitted(learned, columns)


def accuracy(predictions: DataFrame, *by: str) -> DataFrame:
    hit = (F.col("label") == F.col("prediction")).cast("int")
    grouped = predictions.groupBy(*by) if by else predictions.groupBy()
    return grouped.agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("accuracy"), F.count("*").alias("n"))


def class_report(predictions: DataFrame, labels: list) -> DataFrame:
    """Precision, recall, F1 and support per class; an empty denominator gives 0.

    The counts come from one aggregation; nothing but the class table leaves it.
    """
    label, prediction = F.col("label"), F.col("prediction")
    aggs = []
    for i, c in enumerate(labels):
        aggs += [F.count(F.when((label == c) & (prediction == c), 1)).alias(f"tp{i}"),
                 F.count(F.when(prediction == c, 1)).alias(f"pp{i}"), F.count(F.when(label == c, 1)).alias(f"sp{i}")]
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    cells = []
    for i, c in enumerate(labels):
        hit = F.col(f"tp{i}")
        cells.append(F.struct(
            F.lit(c).alias("label"), ratio(hit, F.col(f"pp{i}")).alias("precision"), ratio(hit, F.col(f"sp{i}")).alias("recall"),
            ratio(hit * 2, F.col(f"pp{i}") + F.col(f"sp{i}")).alias("f1"), F.col(f"sp{i}").alias("support")))
    return predictions.agg(*aggs).select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def macro_f1(report: DataFrame) -> DataFrame:
    return report.agg(F.avg("f1").alias("macro_f1"))


def mean_absolute_error(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.avg(F.abs(F.col("prediction") - F.col("label"))).alias("mae"))


def cv_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.round(F.avg("accuracy"), 4).alias("cv_mean"), F.round(F.stddev_pop("accuracy"), 4).alias("cv_std"))


def cross_validate(rows: DataFrame, s: Settings, folds: int = 5) -> DataFrame:
    """fold, accuracy and n of every walk-forward fold with at least 5 rows to test.

    Each fold trains only on rows that end ``forward_days`` before its test
    block.  The loop submits whole Spark jobs; no rows come to the driver.
    """
    placed = walk_forward(rows, folds, s.forward_days)
    sizes = {r["fold"]: r["count"] for r in placed.filter("role = 'test'").groupBy("fold").count().collect()}  # one row a fold

    def run(fold: int) -> DataFrame:
        part = placed.filter(F.col("fold") == fold)
        scored = fit(part.filter("role = 'train'"), s).transform(part.filter("role = 'test'"))
        return accuracy(scored).select(F.lit(fold).alias("fold"), "accuracy", "n")

    tested = side_by_side([lambda f=f: run(f) for f in range(1, folds + 1) if sizes.get(f, 0) >= 5])
    out = rows.sparkSession.createDataFrame([], "fold int, accuracy double, n long")
    for score in tested:
        out = out.unionByName(score)
    return out


def holdout(rows: DataFrame, s: Settings) -> tuple[Fitted, DataFrame]:
    """Model on the first 80% of every symbol and its predictions for the rest."""
    parts = ordered_split(rows)
    model = fit(parts.filter("split = 'train'"), s)
    return model, model.transform(parts.filter("split = 'test'"))


def training_report(rows: DataFrame, s: Settings) -> DataFrame:
    """(part, name, value, n): the whole result of a training run, one number a row.

    ``fold`` has the accuracy of each fold, ``cv`` their mean and std (the held-out accuracy, if there is no fold), ``holdout`` the
    accuracy on the last fifth of every symbol, ``class`` its precision, recall and f1 by class with the support as n,
    ``importance`` the features.
    """
    folds, (model, predictions) = side_by_side([lambda: materialize(cross_validate(rows, s), "folds"), lambda: holdout(rows, s)])
    held = materialize(predictions.select("label", "prediction"), "held-out")
    score = materialize(accuracy(held), "accuracy")
    none = F.lit(None).cast("long").alias("n")
    cv = cv_summary(folds.select("accuracy") if not folds.isEmpty() else score.select("accuracy"))
    report = class_report(held, [0.0, 1.0, 2.0])
    name = (F.col("label") - 1).cast("int").cast("string")
    cells = F.explode(F.array(*[F.struct(F.concat_ws(" ", name, F.lit(c)).alias("name"), F.col(c).alias("value")) for c in ("precision", "recall", "f1")]))
    return (
        folds.select(F.lit("fold").alias("part"), F.col("fold").cast("string").alias("name"), F.col("accuracy").alias("value"), "n")
        .unionByName(cv.select(F.lit("cv").alias("part"), F.explode(F.create_map(F.lit("mean"), "cv_mean", F.lit("std"), "cv_std")).alias("name", "value"), none))
        .unionByName(score.select(F.lit("holdout").alias("part"), F.lit("accuracy").alias("name"), F.col("accuracy").alias("value"), "n"))
        .unionByName(report.select(cells.alias("c"), "support").select(F.lit("class").alias("part"), "c.*", F.col("support").alias("n")))
        .unionByName(importances(model, rows, len(model.columns)).select(F.lit("importance").alias("part"), F.col("feature").alias("name"), F.col("importance").alias("value"), none))
    )


def importances(model: Fitted, rows: DataFrame, top: int = 10) -> DataFrame:
    """Feature importances, largest first; no rows for a perceptron.

    The fitted model holds one number per feature; ``rows`` only lends its
    session so that the result is a DataFrame like all others.
    """
    table = rows.sparkSession.createDataFrame(list(zip(model.columns, model.importances())), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def score_latest(model: Fitted, bars: DataFrame, s: Settings) -> DataFrame:
    """Signal and class probabilities of the newest row of every symbol."""
    scored = model.transform(latest_features(bars, s.profile))
    p = F.col("probability")
    return scored.select(
        "symbol", "date", signal_of(argmax_index(p) - 1).alias("signal"), probability_map(p, CLASSES).alias("probabilities"))


def score_newest_windows(model: perceptron.Perceptron, rows: DataFrame, columns: list[str], length: int) -> DataFrame:
    """symbol, date, signal and class probabilities ``p`` of every symbol's newest window, its newest row included.

    A symbol with fewer than ``length`` rows is held, with certainty.
    """
    newest = newest_rows(rows.select("symbol", "date", *columns), length)
    cells = F.transform(F.array_sort(F.collect_list(F.struct("date", F.array(*[F.col(c).cast("double") for c in columns]).alias("x")))), lambda r: r["x"])
    return score_windows(model, newest.groupBy("symbol").agg(F.max("date").alias("date"), F.flatten(cells).alias("vector"), F.count("*").alias("n")), length)


def score_windows(model: perceptron.Perceptron, windows: DataFrame, length: int) -> DataFrame:
    """What :func:`score_newest_windows` gives, for ``vector`` and ``n``, the number of its rows, of every symbol."""
    full = model.transform(windows.filter(F.col("n") == length)).select("symbol", "date", signal_of(argmax_index(F.col("probability")) - 1).alias("signal"), F.col("probability").alias("p"))
    short = windows.filter(F.col("n") < length).select("symbol", "date", signal_of(F.lit(0)).alias("signal"), F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("p"))
    return full.unionByName(short)


def save(model: Fitted, s: Settings, path: str, rows: DataFrame) -> None:
    """Model and its settings side by side."""
    if isinstance(model.learned, forest.Forest):
        model.learned.save(f"{path}/model", rows)
    else:
        rows.sparkSession.createDataFrame([(model.learned.to_json(),)], "value string").write.mode("overwrite").text(f"{path}/model")
    rows.sparkSession.createDataFrame([(json.dumps(asdict(s)),)], "value string").write.mode("overwrite").text(f"{path}/settings")


def load(spark, path: str) -> tuple[Fitted, Settings]:
    config = json.loads(spark.read.text(f"{path}/settings").first()["value"])
    config["hidden"] = tuple(config["hidden"])
    config.pop("fit_rows", None)  # models saved before fits used all rows have it
    s = Settings(**config)
    if s.kind == "rf":
        learned = forest.Forest.load(spark, f"{path}/model")
    else:
        text = spark.read.text(f"{path}/model").first()["value"]
        learned = perceptron.Perceptron.from_json(text) if s.kind == "mlp" else boosting.BoostedModel.from_json(text)
    return Fitted(learned, contract(s.profile)), s


def vector_split(rows: History, length: int, vector: Column, limit: int | None = None, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(symbol, date, vector, label, kept columns) of the windows of ``length`` rows, in the ordered split: all training rows, or
    about ``limit`` as :func:`bounded` draws them, and all test rows.  ``vector`` is over ``window`` and ``x``.

    The history's blocks are the only rows written; windows are cut as each side is read.
    """
    cut = lambda n_rows: F.floor(n_rows * F.lit(share))
    n = 0 if limit is None else rows.rows_before(length, share)

    def drawn(date: Column, rn: Column, n_rows: Column) -> Column:
        first = rn <= cut(n_rows)
        return first & (F.pmod(F.xxhash64("symbol", date, F.lit(5)), F.lit(1 << 30)) < int(limit / n * (1 << 30))) if limit is not None and n > limit else first

    train = rows.cut(length, drawn)
    test = rows.cut(length, lambda date, rn, n_rows: rn > cut(n_rows))
    names = ["symbol", "date", vector.alias("vector"), F.col("label").cast("double").alias("label"), *rows.keep]
    return train.select(*names, F.xxhash64("symbol", "date").alias("key")), test.select(*names)


def fit_vectors(train: DataFrame, network: perceptron.Network) -> perceptron.Perceptron:
    """A network for the training side of :func:`vector_split`."""
    return perceptron.fit(train, network)


def best_parameter(scores: DataFrame) -> DataFrame:
    """Parameter with the highest score; the one listed first wins a tie."""
    return scores.agg(F.max_by("param", F.struct("score", (-F.col("place")).alias("p"))).alias("best"), F.max("score").alias("score"))
