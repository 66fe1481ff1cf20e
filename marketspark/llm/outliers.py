"""Quality rules with robust multivariate outliers.

Every text gets counts of its words, symbols, repeated lines and repeated
three-word windows.  Fixed rules fail a text outright.  The others of each
(language, source) are described by a vector of square roots of shares, whose
centre and covariance are estimated by minimum covariance determinant: from a
start of medians, concentration steps re-estimate both from the h rows of least
Mahalanobis distance, and a last step from all rows inside the 0.975 quantile.  A row far
outside is rejected.

Everything is DataFrame expressions.  The vectors are rounded to whole
thousandths, so sums are exact integers and a rerun gives the same verdicts in
any order of rows.  Quantiles are exact ones over a bounded grid of values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .text import WORD

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
GRID = 1000
#: Share of rows that a concentration step keeps.
H_SHARE = 0.75
STEPS = 3
#: Chi-square quantile 0.975 of 5 degrees of freedom.
REWEIGHT = 12.833
#: Squared distance beyond which a text is rejected.
CUTOFF = 60.0
#: Standard deviation added to each statistic, in grid units: a statistic that is constant in a
#: group does not reject the first text that differs a little.
FLOORS = {"len": 40, "symbols": 60, "dup": 110, "repeat": 110, "upper": 60}
#: Fewest rows of a group that are judged by their distance.
MIN_GROUP = 12

NAMES = list(FLOORS)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Hashes only tell that no window can repeat; windows themselves are compared otherwise.
    """
    window = lambda i: [F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)]
    at = F.sequence(F.lit(0), n - 3)
    hashes = F.transform(at, lambda i: F.xxhash64(*window(i)))
    ordered = F.sort_array(F.transform(at, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i"))))
    same = lambda rows, j, k: F.coalesce(F.get(rows, j)["w"] == F.get(rows, k)["w"], F.lit(False))
    # A one-element outer array binds the sorted windows once.
    hit = F.transform(F.array(ordered), lambda rows: F.filter(
        F.transform(rows, lambda r, j: F.when(same(rows, j, j - 1) | same(rows, j, j + 1), r["i"])), lambda i: i.isNotNull()))
    covered = F.array_distinct(F.flatten(F.transform(F.get(hit, F.lit(0)), lambda i: F.array(i, i + 1, i + 2))))
    return F.when(n < 3, 0).when(F.size(F.array_distinct(hashes)) == n - 2, 0).otherwise(F.size(covered)).cast("long")


def statistics(df: DataFrame, text: Column) -> DataFrame:
    """``df`` plus the five counts, ``base_failed`` and the upper-case count ``n_upper``; null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD))
    out = df.withColumns({"__words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), "__lines": lines})
    out = out.withColumn("__n", F.size("__words")).withColumns({
        "n_words": F.col("__n").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("__words"), F.col("__n")),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("__words", "__lines", "__n")


def _grid(top: Column, below: Column) -> Column:
    return F.floor(F.sqrt(F.try_divide(top.cast("double"), below.cast("double"))) * GRID + 0.5).cast("long")


def vector() -> dict[str, Column]:
    """The statistic vector on the grid; null without a word."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "x_len": _grid(chars, n), "x_symbols": _grid(F.col("n_symbols"), n), "x_dup": _grid(F.col("n_dup_lines"), n),
        "x_repeat": _grid(F.col("n_repeat_words"), n), "x_upper": _grid(F.col("n_upper"), chars),
    }


def _distance(est: str = "") -> Column:
    """Squared Mahalanobis distance by forward substitution through the Cholesky factor in the row."""
    solved: list[Column] = []
    for i, name in enumerate(NAMES):
        y = F.col(f"x_{name}") - F.col(f"{est}m{i}")
        for j in range(i):
            y = y - F.col(f"{est}l{i}{j}") * solved[j]
        solved.append(y / F.col(f"{est}l{i}{i}"))
    total = solved[0] * solved[0]
    for y in solved[1:]:
        total = total + y * y
    return total


def _factor(moments: DataFrame, scale: float) -> DataFrame:
    """Centre ``m*`` and Cholesky factor ``l**`` of a group from exact sums."""
    n = F.col("n").cast("double")
    mean = {f"m{i}": F.col(f"s{i}").cast("double") / n for i in range(len(NAMES))}
    out = moments.withColumns(mean)
    floor = list(FLOORS.values())
    cov = {
        f"c{i}{j}": (F.col(f"p{i}{j}").cast("double") / n - F.col(f"m{i}") * F.col(f"m{j}")) * F.lit(scale)
        + F.lit(float(floor[i] ** 2) if i == j else 0.0)
        for i, j in PAIRS
    }
    out = out.withColumns(cov)
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # The floors keep every pivot positive but for rounding.
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1.0))) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select("g", *mean, *[f"l{i}{j}" for i, j in PAIRS])


def _moments(rows: DataFrame) -> DataFrame:
    x = [F.col(f"x_{n}") for n in NAMES]
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    return rows.groupBy("g").agg(
        F.count("*").alias("n"), *[exact(c).alias(f"s{i}") for i, c in enumerate(x)], *[exact(x[i] * x[j]).alias(f"p{i}{j}") for i, j in PAIRS],
    )


def consistency(share: float, d: int = len(NAMES)) -> float:
    """Factor that makes the covariance of the inner ``share`` of a normal sample unbiased."""
    step, total, inner, x = 1e-3, 0.0, 0.0, 5e-4
    density = lambda v: v ** (d / 2 - 1) * math.exp(-v / 2) / (2 ** (d / 2) * math.gamma(d / 2))
    while total < share:
        total += density(x) * step
        inner += density(x) * x * step
        x += step
    return share * d / inner


def estimates(rows: DataFrame) -> DataFrame:
    """Centre and factor of every group ``g`` of rows with grid vectors ``x_*``."""
    med = rows.groupBy("g").agg(*[F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY x_{n})").alias(f"m{i}") for i, n in enumerate(NAMES)])
    start = med.select(
        "g", *[F.col(f"m{i}").cast("double").alias(f"m{i}") for i in range(len(NAMES))],
        *[F.lit(float(list(FLOORS.values())[i]) if i == j else 0.0).alias(f"l{i}{j}") for i, j in PAIRS],
    )
    est, factor = materialize(start, "mcd-start"), consistency(H_SHARE)
    for _ in range(STEPS):
        near = rows.join(est, "g").withColumn("r", F.least(F.floor(F.sqrt(_distance()) * 100), F.lit(100_000)).cast("long"))
        limit = near.groupBy("g").agg(F.expr(f"percentile_disc({H_SHARE}) WITHIN GROUP (ORDER BY r)").alias("limit"))
        limit = materialize(limit, "mcd-limit")
        inner = near.join(limit, "g").where("r <= limit")
        est = materialize(_factor(_moments(inner), factor), "mcd-step")
    inner = rows.join(est, "g").where(_distance() <= REWEIGHT)
    last = _factor(_moments(inner), 1.0)
    sizes = rows.groupBy("g").agg(F.count("*").alias("group_size"))
    return materialize(last.join(sizes, "g"), "mcd-final")


def quality_rules(documents: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` and ``kept`` of every row of a documents table.

    Null language or source is a group of its own.  A text without a word fails
    the base rules.  Groups of fewer than MIN_GROUP judged rows keep all of them; so does a group without an
    estimate.  An empty table gives no rows; extra columns pass through and
    repeated rows are judged each by itself.
    """
    group = F.to_json(F.struct(F.col("lang"), F.col("source")))
    return _judged(materialize(
        statistics(documents.select("doc_id", group.alias("g"), "text"), F.col("text")).drop("text"), "quality-counts"))


def _judged(counts: DataFrame) -> DataFrame:
    rows = counts.where("NOT base_failed").select("g", *[c.alias(n) for n, c in vector().items()])
    est = estimates(rows).withColumnRenamed("g", "__g")
    scored = counts.withColumns(vector()).join(est, F.col("g") == F.col("__g"), "left")
    d = F.when(~F.col("base_failed"), _distance())
    out = F.coalesce((d > CUTOFF) & (F.col("group_size") >= MIN_GROUP), F.lit(False))
    return scored.select("doc_id", *BASE, "base_failed", d.alias("distance"), (~F.col("base_failed") & ~out).alias("kept"))


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with all their columns.

    Rows are told apart by id; rows that share an id (null too) must all be kept, else all go.
    """
    verdict = quality_rules(documents).groupBy("doc_id").agg(F.every("kept").alias("__kept"))
    bad = verdict.where("NOT __kept").select(F.col("doc_id").alias("__bad"))
    return documents.join(bad, documents["doc_id"].eqNullSafe(F.col("__bad")), "left_anti")
