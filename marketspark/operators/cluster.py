"""Clustering of symbols by their history profile (one row per symbol)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, side_by_side
from ..schemas import CLUSTER8
from .stats import finite_or_zero


def standardise(profiles: DataFrame, columns: list[str] = CLUSTER8) -> DataFrame:
    """Add ``scaled``: features minus mean over population deviation.

    Spark's scaler divides by the sample deviation; one constant factor turns
    that into the population one.  The profiles, one row per symbol, are written
    once: every fit that follows reads them again.
    """
    clean = materialize(finite_or_zero(profiles, columns), "profiles")
    raw = VectorAssembler(inputCols=columns, outputCol="raw").transform(clean)
    n = raw.count()
    sample = StandardScaler(inputCol="raw", outputCol="sample_scaled", withMean=True).fit(raw).transform(raw)
    factor = float(np.sqrt(n / (n - 1))) if n > 1 else 1.0
    product = ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(columns)), inputCol="sample_scaled", outputCol="scaled")
    return product.transform(sample).drop("raw", "sample_scaled")


def kmeans(scaled: DataFrame, k: int = 4, restarts: int = 10, seed: int = 42):
    """Best of several seeded k-means|| runs by within-cluster cost."""
    def start(i: int):
        return KMeans(k=k, seed=seed + i, featuresCol="scaled", predictionCol="cluster").fit(scaled)

    fits = side_by_side([lambda i=i: start(i) for i in range(restarts)])
    return min(fits, key=lambda m: m.summary.trainingCost)


def bisecting(scaled: DataFrame, k: int = 4, seed: int = 42):
    """Hierarchical variant.  It splits top-down, where the bottom-up Ward
    linkage would need the distances of all pairs of symbols."""
    return BisectingKMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster").fit(scaled)


def fit(scaled: DataFrame, k: int = 4, method: str = "kmeans", restarts: int = 10) -> DataFrame:
    if method not in ("kmeans", "hierarchical"):
        raise ValueError(f"unknown method {method}")
    model = bisecting(scaled, k) if method == "hierarchical" else kmeans(scaled, k, restarts)
    return model.transform(scaled)


def cluster_sums(points: DataFrame) -> DataFrame:
    """One row (clusters): an array of (cluster, n, sums, squares), what squared distances to whole clusters need."""
    width = len(points.select("scaled").head().scaled) if not points.isEmpty() else 0
    v = vector_to_array("scaled")
    sums = points.groupBy("cluster").agg(
        F.count("*").alias("n"), F.array(*[F.sum(F.get(v, F.lit(i))) for i in range(width)]).alias("sums"),
        F.sum(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)).alias("squares"))
    return sums.agg(F.collect_list(F.struct("cluster", "n", "sums", "squares")).alias("clusters"))


def silhouette_parts(points: DataFrame) -> DataFrame:
    """(symbol, cluster, silhouette) of every point by squared Euclidean distance, in linear time.

    The sum of squared distances from a point to a cluster follows from the cluster's size, sum and
    sum of squares; these few rows reach every point as one value.  A point alone in its cluster has 0, and so has every point of a single cluster.
    """
    v = vector_to_array("scaled")
    near = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)
    rows = points.select("symbol", "cluster", v.alias("v"), near.alias("q"), cluster_sums(points).scalar().alias("clusters"))

    def total(c: Column) -> Column:
        inner = F.aggregate(F.zip_with("v", c["sums"], lambda x, s: x * s), F.lit(0.0), lambda acc, x: acc + x)
        return F.greatest(c["n"] * F.col("q") - inner * 2 + c["squares"], F.lit(0.0))

    own = F.get(F.transform(F.filter("clusters", lambda c: c["cluster"] == F.col("cluster")), lambda c: F.try_divide(total(c), c["n"] - 1)), F.lit(0))
    other = F.array_min(F.transform(F.filter("clusters", lambda c: c["cluster"] != F.col("cluster")), lambda c: total(c) / c["n"]))
    scored = rows.select("symbol", "cluster", own.alias("a"), other.alias("b"))
    return scored.select("symbol", "cluster", F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)).alias("silhouette"))


#: Points for which all distances may be computed unless a caller asks for any number.
EUCLIDEAN_LIMIT = 50_000
#: Points of a block whose distances to the other block are held at once.
CHUNK = 500


def euclidean_silhouette_parts(points: DataFrame, block_rows: int = 8000, any_number: bool = False) -> DataFrame:
    """Silhouette of every point with Euclidean distance; more than ``EUCLIDEAN_LIMIT`` points raise ValueError unless ``any_number`` is set.

    Points are hashed into blocks of about ``block_rows``; every block meets
    every block once, as a pair of bounded matrices in one task.  What leaves a
    task is one distance sum per point and cluster, never a pair.  The work is
    quadratic by definition; ``silhouette_parts`` is linear.
    """
    n = points.count()
    if n > EUCLIDEAN_LIMIT and not any_number:
        raise ValueError(f"{n} points need {n} x {n} distances; the squared silhouette needs none")
    blocks = max(1, -(-n // block_rows))
    base = points.select("symbol", "cluster", vector_to_array("scaled").alias("v")).withColumn(
        "block", F.pmod(F.xxhash64("symbol"), F.lit(blocks)).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = base.select("symbol", "cluster", "v", F.col("block").alias("i"), others.alias("j"))
    # Names of its own for the other side: both come from one table, and shared
    # columns get lost when a caller needs only part of the result.
    right = base.select(
        F.col("cluster").alias("other_cluster"), F.col("v").alias("other_v"), F.col("block").alias("other_j"), others.alias("other_i"))

    def block_sums(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"symbol": [], "own": [], "other": [], "total": [], "size": []})
        if a.empty or b.empty:
            return empty
        x, y = np.stack(a["v"].to_numpy()), np.stack(b["other_v"].to_numpy())
        squares, out = (y**2).sum(1)[None], []
        clusters = b.groupby("other_cluster").indices.items()
        for lo in range(0, len(x), CHUNK):
            part, rows = x[lo : lo + CHUNK], a.iloc[lo : lo + CHUNK]
            gap = np.sqrt(np.maximum((part**2).sum(1)[:, None] + squares - 2 * part @ y.T, 0.0))
            for cluster, at in clusters:
                out.append(pd.DataFrame({"symbol": rows["symbol"], "own": rows["cluster"], "other": cluster,
                                         "total": gap[:, at].sum(axis=1), "size": len(at)}))
        return pd.concat(out, ignore_index=True)

    sums = left.groupBy("i", "j").cogroup(right.groupBy("other_i", "other_j")).applyInPandas(
        block_sums, "symbol string, own int, other int, total double, size long")
    per_cluster = sums.groupBy("symbol", "own", "other").agg(F.sum("total").alias("total"), F.sum("size").alias("size"))
    own = F.col("own") == F.col("other")
    folded = per_cluster.groupBy("symbol", "own").agg(
        F.max(F.when(own, F.try_divide("total", F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"))
    score = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return folded.select("symbol", F.col("own").alias("cluster"), F.coalesce(score, F.lit(0.0)).alias("silhouette"))


def silhouette(points: DataFrame) -> DataFrame:
    """Mean squared-Euclidean silhouette; 0 when there is a single cluster."""
    return silhouette_parts(points).agg(
        F.coalesce(F.avg("silhouette"), F.lit(0.0)).alias("silhouette"), F.countDistinct("cluster").alias("clusters"))


def pca_2d(scaled: DataFrame) -> DataFrame:
    """First two principal coordinates; each axis points to where its largest
    loading is positive."""
    model = PCA(k=2, inputCol="scaled", outputCol="pca").fit(scaled)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.abs(loadings[:, c]).argmax(), c])) for c in range(2)]
    xy = vector_to_array("pca")
    return model.transform(scaled).withColumns(
        {"PC1": F.get(xy, F.lit(0)) * signs[0], "PC2": F.get(xy, F.lit(1)) * signs[1]}).drop("pca")


def summary(assigned: DataFrame, digits: int = 4, columns: list[str] = CLUSTER8) -> DataFrame:
    return assigned.groupBy("cluster").agg(*[F.round(F.avg(c), digits).alias(c) for c in columns])


# Conditions on a cluster's means and names, in the order they are tried.
RULES = [
    ("ann_return > 0.15 AND ann_vol < 0.25", "성장형 안정주 📈"),
    ("ann_return > 0.10 AND momentum_20 > 0.05", "모멘텀 강세주 🚀"),
    ("ann_return < -0.05 AND max_dd < -0.20", "하락 위험주 ⚠️"),
    ("ann_vol > 0.35", "고변동성 투기주 🎲"),
    ("abs(ann_return) < 0.05 AND ann_vol < 0.20", "저변동 방어주 🛡️"),
    ("rsi_mean > 65", "과매수 구간 🔴"),
    ("rsi_mean < 40", "과매도 반등 후보 🟢"),
    ("true", "중립·관망 ➖"),
]


def cluster_name() -> Column:
    """Name of a summary row; the first rule that holds decides."""
    (condition, name), *rest = RULES
    out = F.when(F.expr(condition), name)
    for condition, name in rest:
        out = out.when(F.expr(condition), name)
    return out


def named(summaries: DataFrame) -> DataFrame:
    return summaries.withColumn("cluster_name", cluster_name())


def with_cluster_names(assigned: DataFrame, summaries: DataFrame) -> DataFrame:
    """Attach the name of its cluster to every symbol; the names are one row per
    cluster, small enough for Spark to broadcast by its own size estimate."""
    return assigned.join(named(summaries).select("cluster", "cluster_name"), "cluster", "left")


def optimal_k(scaled: DataFrame, k_min: int = 2, k_max: int = 8, restarts: int = 10) -> DataFrame:
    """k, silhouette and inertia of each k; no rows where there are too few symbols to compare two."""
    k_max = min(k_max, scaled.count())
    rows = scaled.sparkSession.createDataFrame([], "k int, silhouette double, inertia double")
    if k_max <= k_min:
        return rows
    for k in range(k_min, k_max + 1):
        model = kmeans(scaled, k, restarts)
        rows = rows.unionByName(silhouette(model.transform(scaled)).select(
            F.lit(k).alias("k"), F.round("silhouette", 4).alias("silhouette"),
            F.lit(round(model.summary.trainingCost, 2)).alias("inertia")))
    return rows
