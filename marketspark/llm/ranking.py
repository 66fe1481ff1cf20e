"""Row numbers within groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize


def _numbered(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column(key), run_end_type=pa.int64())
            ends = runs.run_ends.to_numpy()
            starts = np.concatenate([[0], ends[:-1]])
            begun = np.zeros(len(ends), np.int64)
            keys = runs.values
            first = keys[0].as_py()
            if last is not None and last == (first,):
                begun[0] = carried
            at = np.arange(batch.num_rows) - np.repeat(starts - begun, ends - starts)
            last, carried = (keys[-1].as_py(),), int(at[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "at"])

    return run


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, the place of a row among those of its ``key`` (from 0), and ``total``, their number.

    Nulls come first and are a key of their own; equal rows get any order among themselves.  Rows
    are dealt by ranges of (key, order) and counted in their sorted partitions; the
    counts, one for each partition and key in it, give each partition's first rank.  ``rows``
    should be cheap to read twice, as the ranges come from a sample of it.  Columns part, at and seq are taken.
    """
    names = [key, *order, "seq"]
    dealt = rows.withColumn("seq", F.monotonically_increasing_id()).repartitionByRange(*names).sortWithinPartitions(*names).drop("seq")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    counted = materialize(dealt.mapInArrow(_numbered(key), f"{shape}, part int, at long"), "ranked")
    sizes = counted.groupBy("part", key).agg(F.count("*").alias("size"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("part").alias("s_part"), F.col(key).alias("s_key"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"),
        F.sum("size").over(Window.partitionBy(key)).alias("total"))
    out = counted.join(starts, (F.col("part") == F.col("s_part")) & F.col(key).eqNullSafe(F.col("s_key")))
    return out.select(*rows.columns, (F.col("first") + F.col("at")).alias("rank"), "total")
