"""Intermediate tables in the shared folder, numbered rows, bounded broadcasts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Most rows (of a few longs each) that a side may have to be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


_WATCHING: list[list[str]] = []


@contextmanager
def watching() -> Iterator[list[str]]:
    """Collects the paths of the tables that ``stored`` writes inside the block."""
    paths: list[str] = []
    _WATCHING.append(paths)
    try:
        yield paths
    finally:
        _WATCHING.pop()


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    for paths in _WATCHING[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that nothing reads any more (through Hadoop's file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """A stored copy of ``df`` with a unique long ``node`` per row, fixed once written.

    Rows stay apart even if their ids are null or repeated.
    """
    return stored(df.withColumn("node", F.monotonically_increasing_id()), name)[0]


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (df is a stored table)."""
    return F.broadcast(df) if df.count() <= rows else df
