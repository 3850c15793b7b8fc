"""Small plan-shaping helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row (broadcast of one row)."""
    return df.crossJoin(F.broadcast(one_row))


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it holds at most ``max_rows`` rows, else leave the join to a shuffle.

    ``df`` should be cheap to count (checkpointed or a small aggregate).
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def spread(df: DataFrame, key=None) -> DataFrame:
    """Hash-redistribute ``df`` only when its files give fewer splits than the cluster has cores.

    CPU-heavy per-row work (regexes, Arrow UDFs) needs parallelism; a large input
    already arrives in many splits and is left alone (no extra shuffle), while a
    small input is spread over all cores first. The decision reads the optimizer's size
    estimate; nothing runs.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * split:
        return df
    if key is None:
        return df.repartition(cores)
    return df.repartition(cores, F.col(key) if isinstance(key, str) else key)


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet below the shared checkpoint folder and reading it back.

    Preferred over ``checkpoint()`` for wide tables that later readers project
    differently: the Parquet re-read prunes columns and pushes filters.
    """
    from tessera.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_LOADED: dict = {}


def model_key(factory) -> str:
    """Driver-side key of a model factory (hash of its pickled form at plan time)."""
    import hashlib

    from pyspark import cloudpickle

    return hashlib.sha1(cloudpickle.dumps(factory)).hexdigest()


def worker_model(factory, key: str):
    """Build ``factory()`` once per Python worker process and reuse it (models, clients).

    ``factory`` is pickled into each task (cheap); the object it returns (weights,
    sessions, connections) is created on first use in each worker and cached
    under ``key``, which the driver computes once with ``model_key``.
    """
    if key not in _LOADED:
        _LOADED[key] = factory()
    return _LOADED[key]
