"""Where intermediate tables, checkpoints and sink outputs of a run go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}
#: Independent fits that run side by side.
SIDE_BY_SIDE = 4


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder of its own.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = context.applicationId
        if app not in _LOCAL_BASE:
            _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="marketspark-")
        base = _LOCAL_BASE[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used where a result feeds several passes (model fits, parameter sweeps): the
    written table cuts the lineage and outlives a lost executor.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(tasks: list[Callable]) -> list:
    """Results of independent functions that submit Spark jobs, a few at a time."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return list(pool.map(lambda task: task(), tasks))
