"""Forward labels, ordered splits and walk-forward folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rolling import by_symbol
from ..functions.text import signal_of


def forward_return(days: int = 5) -> Column:
    return F.try_divide(F.lead("close", days).over(by_symbol()), F.col("close")) - 1


def direction(days: int = 5, threshold: float = 0.01) -> Column:
    """1 above the threshold, -1 below its negative, 0 between; null where the
    future is unknown."""
    ahead = forward_return(days)
    return (
        F.when(ahead.isNull(), F.lit(None).cast("int"))
        .when(ahead > threshold, 1)
        .when(ahead < -threshold, -1)
        .otherwise(0)
    )


def direction_text(days: int = 5, threshold: float = 0.01) -> Column:
    label = direction(days, threshold)
    return F.when(label.isNotNull(), signal_of(label))


def next_day_up() -> Column:
    return (F.lead("close", 1).over(by_symbol()) > F.col("close")).cast("int")


def next_return_up(ret: Column) -> Column:
    return (F.lead(ret, 1).over(by_symbol()) > 0).cast("int")


def ordered_split(ranked: DataFrame, share: float = 0.8) -> DataFrame:
    """First ``share`` of each symbol's rows is 'train', the rest 'test'."""
    return ranked.withColumn(
        "split", F.when(F.col("rn") <= F.floor(F.col("n_rows") * F.lit(share)), "train").otherwise("test")
    )


def walk_forward(ranked: DataFrame, folds: int = 5, gap: int = 5) -> DataFrame:
    """Expanding folds: test blocks of n // (folds + 1) rows at the end of the
    history, training rows end ``gap`` rows before their block.  One row per
    membership; rows in no set of a fold are absent from it."""
    size = F.floor(F.col("n_rows") / (folds + 1))
    rows = ranked.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(1, folds + 1)])))
    start = F.col("n_rows") - size * (folds - F.col("fold") + 1)
    position = F.col("rn") - 1
    role = F.when(position < start - gap, "train").when(
        (position >= start) & (position < start + size), "test"
    )
    return rows.withColumn("role", role).filter("role is not null")
