"""Mix overlapping sources to target weights by minimum-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to).  Each pattern can give its words once for free, a second and a third time
at growing cost; each source has a quota.  The flow from patterns to quotas is
solved on the driver over the pattern table, which has one row per distinct
set of sources and is checked against ``max_patterns``; documents never go there.  The
words that a pattern gives become whole passes over its documents plus a seeded
selection of some of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .text import n_words

REPEATS = 3
_BUCKETS = 4096


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], cap: float = REPEATS) -> dict[str | None, float]:
    """Share the total of all sizes by weight; no source gets over ``cap`` times its size.

    What a capped source cannot take is shared again by weight among the others.
    """
    out: dict[str | None, float] = {}
    left, rest = float(sum(sizes.values())), dict(sizes)
    while rest:
        unit = left / sum(weights[s] for s in rest)
        over = [s for s in rest if unit * weights[s] > cap * rest[s]]
        if not over:
            return out | {s: unit * weights[s] for s in rest}
        for s in over:
            out[s] = float(cap * rest.pop(s))
            left -= out[s]
    return out


def cycled_weights(sources, values=(1, 2, 3)) -> dict[str | None, int]:
    """Weights in code point order of the source names, null last."""
    named = sorted((s for s in sources if s is not None), key=lambda s: [ord(c) for c in s])
    return {s: values[i % len(values)] for i, s in enumerate(named + [None] * (None in set(sources)))}


def min_cost_flow(supply: list[int], links: list[list[int]], quota: list[int], repeats: int = REPEATS) -> list[list[int]]:
    """Words of each pattern that go to each quota, for ``links[p]`` = quotas open to pattern p.

    Successive shortest paths with potentials on source -> patterns -> quotas ->
    sink.  Pattern p has ``repeats`` parallel arcs of capacity ``supply[p]`` and
    cost 0, 1, 3, ...: the convex price of using its words again.
    """
    n_p, n_q = len(supply), len(quota)
    sink = n_p + n_q + 1
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    to, cap, cost = [], [], []

    def arc(u: int, v: int, c: int, w: int) -> int:
        for a, b, x, y in ((u, v, c, w), (v, u, 0, -w)):
            graph[a].append(len(to))
            to.append(b)
            cap.append(x)
            cost.append(y)
        return len(to) - 2

    for p, s in enumerate(supply):
        for r in range(repeats):
            arc(0, 1 + p, s, r * (r + 1) // 2)
    flows = [[arc(1 + p, 1 + n_p + q, sum(quota), 0) for q in links[p]] for p in range(n_p)]
    for q, c in enumerate(quota):
        arc(1 + n_p + q, sink, c, 0)
    potential = [0] * (sink + 1)
    while True:
        dist, via, queue = [None] * (sink + 1), [-1] * (sink + 1), [(0, 0)]
        dist[0] = 0
        while queue:
            d, u = heapq.heappop(queue)
            if d > dist[u]:
                continue
            for e in graph[u]:
                if cap[e] > 0:
                    there = d + cost[e] + potential[u] - potential[to[e]]
                    if dist[to[e]] is None or there < dist[to[e]]:
                        dist[to[e]], via[to[e]] = there, e
                        heapq.heappush(queue, (there, to[e]))
        if dist[sink] is None:
            break
        potential = [p + d if d is not None else p for p, d in zip(potential, dist)]
        path, v = [], sink
        while v:
            path.append(via[v])
            v = to[via[v] ^ 1]
        amount = min(cap[e] for e in path)
        for e in path:
            cap[e] -= amount
            cap[e ^ 1] += amount
    return [[cap[e ^ 1] for e in row] for row in flows]


def _take(df: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Whole passes plus a seeded selection whose words come nearest to each pattern's rest.

    The documents of a pattern are ordered by a seeded hash.  Sums over 4096
    hash ranges find the range in which the rest is used up; only that range's documents are
    ordered one by one, so a pattern with most documents still spreads over tasks.
    """
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("__id").cast("string"), F.lit("null"))))
    rows = df.withColumn("__order", order).withColumn("__range", F.conv(F.substring("__order", 1, 3), 16, 10).cast("int"))
    sums = rows.groupBy("__pattern", "__range").agg(F.sum("__size").alias("__words"))
    before = F.coalesce(F.sum("__words").over(Window.partitionBy("__pattern").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each pattern and range: at most 4096 rows a pattern are ordered together.
    opened = sums.withColumn("__before", before).join(F.broadcast(plan), "__pattern").select(
        "__pattern", "__range", F.col("__words").alias("__in_range"), (F.col("__rest") - F.col("__before")).alias("__left"),
        (F.col("__before") < F.col("__rest")).alias("__some"),
    )
    joined = rows.join(opened, ["__pattern", "__range"], "left")
    # Ranges wholly inside the rest are taken as they are; the one that the rest ends in goes on below.
    inside = F.col("__some") & (F.col("__in_range") <= F.col("__left"))
    edge = F.col("__some") & ~inside
    cuts = joined.where(edge)
    run = F.sum("__size").over(Window.partitionBy("__pattern", "__range").orderBy("__order", "__size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A document counts while the running sum is nearer to the rest with it than without it.
    cuts = cuts.withColumn("__more", (run - F.col("__size") / 2.0 <= F.col("__left")).cast("int"))
    rest = joined.where(~F.coalesce(edge, F.lit(False))).withColumn("__more", F.coalesce(inside, F.lit(False)).cast("int"))
    return rest.unionByName(cuts)


def mix_sources(
    df: DataFrame, sources: Column, size: Column, doc_id: Column, weights: Mapping | None = None,
    repeats: int = REPEATS, seed: int = 17, max_patterns: int = 100_000,
) -> DataFrame:
    """``df`` plus ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_copies`` and ``mix_taken``.

    ``sources``: array of the sources a row belongs to (null names allowed).
    ``mix_taken`` is ``mix_copies`` times the row's size, at most ``repeats`` times it.
    ``mix_source_size`` and ``mix_target`` are arrays in the order of ``sources``.
    Rows of no source take no part (taken 0).  Raises when there are more than
    ``max_patterns`` patterns.  Repeated rows count each by itself; equal ids of one pattern share their fate
    up to the row at which the quota is reached.
    """
    own = F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))
    key = F.to_json(F.array_sort(F.transform(own, lambda s: F.struct(s.isNull().alias("n"), s.alias("s")))))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), own.alias("__sources"), size.cast("long").alias("__size"),
        key.alias("__pattern"), doc_id.alias("__id"),
    )
    found = rows.groupBy("__pattern").agg(F.first("__sources").alias("sources"), F.sum("__size").alias("words")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    found = sorted(found, key=lambda r: r["__pattern"])
    sizes: dict = {}
    for r in found:
        for s in r["sources"]:
            sizes[s] = sizes.get(s, 0) + r["words"]
    total = sum(r["words"] for r in found if r["sources"])
    weights = weights or cycled_weights(sizes)
    # The shared total is that of the documents, each counted once.
    scale = total / max(1, sum(sizes.values()))
    want = targets(sizes if scale == 1 else {s: v * scale for s, v in sizes.items()}, weights, repeats)
    names_of = list(sizes)
    flow = min_cost_flow(
        [r["words"] for r in found], [[names_of.index(s) for s in r["sources"]] for r in found],
        [round(want[s]) for s in names_of], repeats,
    )
    spark = df.sparkSession
    plan, meta = [], []
    for r, given in zip(found, flow):
        gives, words = sum(given), r["words"]
        passes = min(gives // words, repeats) if words else 0
        plan.append((r["__pattern"], int(passes), int(gives - passes * words)))
        meta.append((r["__pattern"], [sizes[s] for s in r["sources"]], [float(want[s]) for s in r["sources"]]))
    plan_df = spark.createDataFrame(plan, "__pattern string, __passes long, __rest long")
    meta_df = spark.createDataFrame(meta, "__pattern string, __sizes array<long>, __targets array<double>")
    taken = _take(rows, plan_df, seed).drop("__passes")
    # Both tables have a row for each pattern, at most max_patterns.
    taken = taken.join(F.broadcast(plan_df.select("__pattern", "__passes")), "__pattern", "left").join(F.broadcast(meta_df), "__pattern", "left")
    copies = F.coalesce("__passes", F.lit(0)) + F.col("__more")
    return taken.select(
        "__row.*", F.col("__size").alias("mix_size"), F.col("__sizes").alias("mix_source_size"), F.col("__targets").alias("mix_target"),
        copies.cast("int").alias("mix_copies"), (F.col("__size") * copies).alias("mix_taken"),
    )


def mix_documents(documents: DataFrame, seed: int = 17) -> DataFrame:
    """The mix of a documents table, one source a row.

    Null text has size 0 and is taken 0 words.  An empty table gives no rows.
    """
    docs = documents.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    docs = materialize(docs, "mix-sizes")
    mixed = mix_sources(docs, F.array("source"), F.col("size"), F.col("doc_id"), seed=seed)
    return mixed.select(
        "doc_id", "size", F.element_at("mix_source_size", 1).alias("source_size"), F.element_at("mix_target", 1).alias("target"),
        F.col("mix_taken").alias("taken"), "source", F.col("mix_copies").alias("copies"),
    )


def repeat_by_mix(documents: DataFrame, seed: int = 17) -> DataFrame:
    """``documents`` with every row as often as the mix takes it.

    Rows that share an id (null too) share the largest number of copies that one of them gets.
    """
    mixed = mix_documents(documents, seed).groupBy("doc_id").agg(F.max("copies").alias("__copies")).where("__copies > 0")
    mixed = mixed.withColumnRenamed("doc_id", "__id")
    rows = documents.join(mixed, documents["doc_id"].eqNullSafe(F.col("__id")))
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*documents.columns)
