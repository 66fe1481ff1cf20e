"""Boosted trees and perceptrons on tables with a known answer, against plain loops, and saved and loaded again."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketspark.operators import boosting, forest, perceptron
from marketspark.operators import models as ml
from marketspark.schemas import ML20


def table(spark, x, y):
    columns = [f"c{i}" for i in range(x.shape[1])]
    rows = [(i, int(label), *map(float, values)) for i, (values, label) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ", ".join(["i long", "label int", *[f"{c} double" for c in columns]]))
    return df.withColumn("key", F.xxhash64("i")).repartition(3), columns


def corners(n=900, seed=1):
    """Three classes of two features, of which no single feature tells any apart; a third feature is noise."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 3))
    a, b = x[:, 0] > 0, x[:, 1] > 0
    return x, np.where(a == b, 1, np.where(a, 2, 0))


def accuracy(scored):
    return scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("a")).first()["a"]


@pytest.mark.parametrize("s", [
    boosting.Boosting(rounds=25, rate=0.3), boosting.Boosting(rounds=25, rate=0.3, rows=0.9, columns=0.9, newton=True, l2=1.0, least_curvature=1.0)])
def test_boosting_learns_corners(spark, monkeypatch, s):
    monkeypatch.setattr(boosting, "TASK_ROWS", 300)
    monkeypatch.setattr(boosting, "REWRITE", 7)
    x, y = corners()
    df, columns = table(spark, x, y)
    model = boosting.fit(df, columns, s)
    scored = model.transform(df)
    assert accuracy(scored) > 0.98
    share = model.importances()
    assert abs(sum(share) - 1) < 1e-9 and share[2] < 0.1
    assert scored.where(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, v: a + v) - 1) > 1e-9).count() == 0
    again = boosting.BoostedModel.from_json(model.to_json())
    assert np.array_equal(again.probabilities(x), model.probabilities(x))
    # Subsamples are drawn by key and sums are exact, so the number of tasks changes nothing.
    monkeypatch.setattr(boosting, "TASK_ROWS", 10_000)
    assert np.array_equal(boosting.fit(df, columns, s).probabilities(x), model.probabilities(x))


def test_one_round_is_the_best_split_of_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (400, 2)).astype(float)
    y = np.where(x[:, 0] + rng.normal(0, 2, 400) > 5, 2, 0)
    df, columns = table(spark, x, y)
    model = boosting.fit(df, columns, boosting.Boosting(rounds=1, depth=1, rate=1.0, rows=1.0))
    share = np.array([max((y == k).sum(), 0.5) / 400 for k in range(3)])
    p = (share / share.sum())[2]
    g = p - (y == 2)
    best = max(((g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum()), f, cut) for f in range(2) for cut in np.unique(x[:, f])[:-1] for left in [x[:, f] <= cut])
    tree = model.rounds[0][2]
    assert (tree.feature[0], model.edges[tree.feature[0]][tree.cut[0]]) == best[1:]
    left = x[:, best[1]] <= best[2]
    want = [-(2 / 3) * g[side].sum() / (side.sum() * p * (1 - p)) for side in (left, ~left)]
    assert np.allclose(tree.value, want, atol=1e-5)


def test_boosting_of_odd_tables(spark):
    df, columns = table(spark, np.ones((30, 2)), np.zeros(30))
    probabilities = boosting.fit(df, columns, boosting.Boosting(rounds=3)).probabilities(np.ones((1, 2)))[0]
    assert probabilities.argmax() == 0  # nothing to split by, one class
    assert np.allclose(boosting.fit(df.limit(0), columns, boosting.Boosting(rounds=3)).probabilities(np.ones((1, 2))), 1 / 3)


@pytest.mark.parametrize("activation, tasks", [("relu", 1), ("tanh", 3)])
def test_perceptron_learns_what_no_line_separates(spark, monkeypatch, activation, tasks):
    x, y = corners(1200)
    monkeypatch.setattr(perceptron, "TASK_ROWS", -(-1200 // tasks))
    df, columns = table(spark, x, y)
    df = df.withColumn("vector", F.array(*columns))
    model = perceptron.fit(df, perceptron.Network((32, 16), 3, activation, rounds=120, batch=32, rate=3e-3))
    assert accuracy(model.transform(df)) > 0.93
    assert model.rounds < 120 or tasks > 1  # the held-out part stops it
    again = perceptron.Perceptron.from_json(model.to_json())
    assert np.allclose(again.outputs(x), model.outputs(x))


def test_perceptron_regression(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, (900, 2))
    y = np.abs(x[:, 0])
    df = spark.createDataFrame([(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))], "i long, vector array<double>, label double")
    model = perceptron.fit(df.withColumn("key", F.xxhash64("i")), perceptron.Network((32,), 0, "relu", rounds=150, batch=32, rate=3e-3))
    (error,) = ml.mean_absolute_error(model.transform(df)).collect()
    assert error["mae"] < 0.05  # a line would be off by a quarter on average
    with pytest.raises(ValueError):
        perceptron.fit(df.withColumn("key", F.xxhash64("i")).limit(0))


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(7, 4)), rng.integers(0, 3, 7)
    for activation in ("relu", "tanh"):
        s = perceptron.Network((5, 4), 3, activation, l2=0.0)
        flat = perceptron.initial(4, s) + 0.1

        def loss(w):
            p = perceptron.forward(x, perceptron.layers(w, 4, s), s)[-1]
            return -np.log(p[np.arange(7), y]).mean()

        got = perceptron.gradient(x, y, flat, s)
        for i in rng.choice(len(flat), 12, replace=False):
            step = np.zeros_like(flat)
            step[i] = 1e-6
            assert abs((loss(flat + step) - loss(flat - step)) / 2e-6 - got[i]) < 1e-5


@pytest.fixture(scope="module")
def panel(spark):
    """Rows of four symbols whose label follows one feature."""
    rng = np.random.default_rng(6)
    rows = []
    for s in "abcd":
        for i in range(150):
            values = rng.normal(size=len(ML20))
            rows.append((s, i, float(np.digitize(values[0], [-0.4, 0.4])), i + 1, 150, *map(float, values)))
    schema = "symbol string, d int, label double, rn long, n_rows long, " + ", ".join(f"{c} double" for c in ML20)
    return spark.createDataFrame(rows, schema).withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))


@pytest.mark.parametrize("kind", ["rf", "xgb", "mlp"])
def test_every_kind_learns_reports_and_is_loaded_again(spark, tmp_path, panel, kind):
    s = ml.Settings(kind=kind, trees=8, max_depth=4, max_iter=40, hidden=(16,))
    report = {(r["part"], r["name"]): (r["value"], r["n"]) for r in ml.training_report(panel, s).collect()}
    assert sum(k[0] == "fold" for k in report) == 5 and ("cv", "mean") in report and ("cv", "std") in report
    least = 0.2 if kind == "mlp" else 0.8  # a few hundred rows stop a perceptron early
    assert report[("holdout", "accuracy")][0] > least and report[("holdout", "accuracy")][1] == 4 * 30
    folds = [v[0] for k, v in report.items() if k[0] == "fold"]
    assert abs(report[("cv", "mean")][0] - np.mean(folds)) < 1e-4 and abs(report[("cv", "std")][0] - np.std(folds)) < 1e-4
    assert sum(report[("class", f"{c} f1")][1] for c in (-1, 0, 1)) == 120
    top = [k[1] for k in report if k[0] == "importance"]
    assert (not top) if kind == "mlp" else (top and max((v[0], k[1]) for k, v in report.items() if k[0] == "importance")[1] == ML20[0])
    model, predictions = ml.holdout(panel, s)
    ml.save(model, s, str(tmp_path / kind), panel)
    again, loaded = ml.load(spark, str(tmp_path / kind))
    assert loaded == s
    test = panel.where("rn > 120")
    assert sorted(map(str, again.transform(test).select("symbol", "date", "prediction").collect())) == sorted(map(str, predictions.select("symbol", "date", "prediction").collect()))


def test_a_fit_uses_a_bounded_part_of_its_rows(panel):
    assert ml.bounded(panel, 10_000).count() == 600
    assert 200 < ml.bounded(panel, 300).count() < 400
    assert ml.bounded(panel, 300).exceptAll(ml.bounded(panel.repartition(7), 300)).count() == 0


def test_folds_without_test_rows_are_not_trained(spark, panel):
    few = panel.where("symbol = 'a' AND rn <= 20").withColumn("n_rows", F.lit(20))
    assert ml.cross_validate(few, ml.Settings(kind="gb", trees=1)).count() == 0  # blocks of three rows


def test_newest_windows(spark):
    rows = [(s, i, float(i), float(-i)) for s, n in (("long", 30), ("short", 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, d int, a double, b double").withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))

    class Model:
        def transform(self, windows):
            return windows.withColumn("probability", F.when(F.col("vector")[0] == 25.0, F.array(F.lit(0.1), F.lit(0.2), F.lit(0.7))))

    got = {r["symbol"]: (str(r["date"]), r["signal"], r["p"]) for r in ml.score_newest_windows(Model(), df, ["a", "b"], 5).collect()}
    assert got == {"long": ("2024-01-30", "BUY", [0.1, 0.2, 0.7]), "short": ("2024-01-04", "HOLD", [0.0, 1.0, 0.0])}


def test_no_histogram_reaches_the_driver(spark, monkeypatch):
    import pickle

    from pyspark import RDD

    sizes, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: (got := collect(self), sizes.append(len(pickle.dumps(got))))[0])
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 8))
    df = spark.createDataFrame([(*map(float, r), int(r[0] > 0), int(i)) for i, r in enumerate(x)], [*[f"c{i}" for i in range(8)], "label", "key"])
    boosting.fit(df, [f"c{i}" for i in range(8)], boosting.Boosting(rounds=2, depth=3))
    assert len(sizes) == 6 and max(sizes) < 10_000


def test_rows_walk_trees_in_parts(monkeypatch):
    rng = np.random.default_rng(4)
    bins = rng.integers(0, boosting.BINS, (101, 5)).astype(np.uint8)
    rounds = [[boosting.Tree(3) for _ in range(3)] for _ in range(60)]
    for tree in sum(rounds, []):
        tree.feature[:], tree.cut[:], tree.value[:] = rng.integers(0, 5, 7), np.where(rng.random(7) < 0.2, 255, rng.integers(0, 64, 7)), rng.normal(size=8)
    monkeypatch.setattr(boosting, "WALK_ROWS", 7)
    expected = np.stack([sum(r[k].predict(bins) for r in rounds) for k in range(3)], axis=1)
    assert np.allclose(boosting.added(np.zeros((101, 3)), bins, rounds), expected)


@pytest.mark.parametrize("kind", ["gb", "mlp", "rf"])
def test_a_fit_gets_all_its_rows(spark, monkeypatch, kind):
    """More rows than the 40,000 that a fit once drew reach every learner."""
    rows = spark.range(50_000).select(F.lit("a").alias("symbol"), F.expr("date_add(date'1900-01-01', cast(id as int))").alias("date"), F.lit(1.0).alias("label"), *[F.rand(1).alias(c) for c in ml.contract("ml20")])
    seen = []
    for module in (ml.forest, ml.boosting, ml.perceptron):
        monkeypatch.setattr(module, "fit", lambda df, *a: seen.append(df.select("key").distinct().count()))
    ml.fit(rows, ml.Settings(kind=kind))
    assert seen == [50_000]


def test_models_saved_with_a_bound_on_their_rows_are_loaded(spark, tmp_path, panel):
    s = ml.Settings(kind="gb", trees=1)
    ml.save(ml.fit(panel, s), s, str(tmp_path / "m"), panel)
    text = spark.read.text(str(tmp_path / "m/settings")).first()["value"]
    assert "fit_rows" not in text
    spark.createDataFrame([(text[:-1] + ', "fit_rows": 40000}',)], "value string").write.mode("overwrite").text(str(tmp_path / "m/settings"))
    assert ml.load(spark, str(tmp_path / "m"))[1] == s


@pytest.mark.parametrize("walked", [200, 25_000])
def test_perceptron_of_many_rows_writes_no_vector(spark, monkeypatch, walked):
    x, y = corners(1200)
    df, columns = table(spark, x, y)
    df = df.withColumn("vector", F.array(*columns)).cache()
    monkeypatch.setattr(perceptron, "WRITTEN", 1200 * 3 - 1)
    monkeypatch.setattr(perceptron, "MAX_TASKS", 2)
    monkeypatch.setattr(perceptron, "WALK_ROWS", walked)
    monkeypatch.setattr(perceptron, "materialize", lambda *a: pytest.fail("vectors are written"))
    model = perceptron.fit(df, perceptron.Network((32, 16), 3, rounds=120, batch=32, rate=3e-3))
    assert accuracy(model.transform(df)) > 0.93
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))


def test_a_forest_of_more_rows_than_a_task_holds(spark, monkeypatch):
    """Grown as sums and by parts: as good as one grown in a task, whose trees and those of another cut it repeats."""
    x, y = corners(3000)
    df, columns = table(spark, x, y)
    whole = forest.fit(df, columns, trees=12, depth=8)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 400)
    monkeypatch.setattr(forest, "SENT_ROWS", 15_000)  # five trees at a time
    model = forest.fit(df, columns, trees=12, depth=8)
    assert len(model.trees) == 12 and accuracy(model.transform(df)) > 0.97 and accuracy(whole.transform(df)) > 0.97
    assert abs(sum(model.importances()) - 1) < 1e-9 and model.importances()[2] < 0.2
    drawn = [np.searchsorted(forest._POISSON, forest.hashed(np.arange(100_000), n + 1), "right") for n in range(2)]
    assert all(abs(d.mean() - 1) < 0.02 and abs((d == 0).mean() - np.exp(-1)) < 0.01 for d in drawn) and abs(np.corrcoef(drawn)[0, 1]) < 0.02
    monkeypatch.setattr(forest, "quantile_edges", lambda *a: model.edges)  # they are approximate
    again = forest.fit(df.repartition(7), columns, trees=12, depth=8)
    assert np.array_equal(again.probabilities(x), model.probabilities(x))
    for tree in model.trees:
        inner = tree.left >= 0
        assert sorted(np.concatenate([tree.left[inner], tree.left[inner] + 1])) == list(range(1, len(tree.left)))
        assert np.allclose(tree.value.sum(axis=1), 1)


def test_parts_split_like_a_tree_of_one_task(spark, monkeypatch):
    """One feature, so all are tried, and equal draws: sums and parts find the splits that one task finds."""
    x = np.random.default_rng(8).uniform(0, 1, (900, 1))
    y = (x[:, 0] * 9).astype(int) % 3
    edges, key = [np.arange(1, forest.BINS) / forest.BINS], np.arange(900) * 7919
    bins = forest.bin_matrix(x, edges)
    draws = np.searchsorted(forest._POISSON, forest.hashed(key, 1), "right")
    use = draws > 0
    want = forest.grow_drawn(bins[use], y[use], draws[use].astype(float), forest._balance(np.bincount(y[use], draws[use], 3)), 6, np.random.default_rng(1))
    ready = spark.createDataFrame([(int(k), int(c), bytes(b)) for k, c, b in zip(key, y, bins)], "key long, label int, bins binary").repartition(3)
    for most in (100, 300, 2000):  # the last leaves nothing but the root to sums
        monkeypatch.setattr(forest, "LOCAL_ROWS", most)
        (got,) = forest._grow_together(ready, 900, 1, 1, 6, 3)
        assert np.allclose(got.predict(bins), want.predict(bins)) and len(got.left) == len(want.left)
        assert np.allclose(got.gains, 1)


def test_boosting_of_many_rows_has_a_bounded_number_of_tasks(spark, monkeypatch):
    """Rows are dealt as bytes, and as many more blocks as there are rows; the sums stay the same."""
    x, y = corners()
    df, columns = table(spark, x, y)
    monkeypatch.setattr(boosting, "TASK_ROWS", 10)
    written, materialize = {}, boosting.materialize
    monkeypatch.setattr(boosting, "materialize", lambda rows, name: written.setdefault(name, materialize(rows, name)))
    monkeypatch.setattr(boosting, "MAX_TASKS", 3)
    edges = [np.linspace(-1, 1, 40)] * 3
    monkeypatch.setattr(boosting, "quantile_edges", lambda *a: edges)
    model = boosting.fit(df, columns, boosting.Boosting(rounds=3))
    assert list(written) == ["binned"] and written["binned"].count() == 3
    monkeypatch.setattr(boosting, "MAX_TASKS", 1000)
    assert np.array_equal(boosting.fit(df, columns, boosting.Boosting(rounds=3)).probabilities(x), model.probabilities(x))
