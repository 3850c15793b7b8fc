"""All pairs inside groups, in blocks: helpers shared by the two similarity joins.

A group of m rows is cut into ceil(m / block) blocks by a hash of the row's node; every pair of blocks
is one unit of work with at most about two blocks of rows, whatever the size of the group. A unit
returns rows per node (sums and local roots), never a row per pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIRS_AT_ONCE = 1 << 18


def block_units(df: DataFrame, key: list[str], blocks: Column, node: str = "node") -> DataFrame:
    """Copy each row to every unit (lo, hi) of its group that holds its block ``b``, grouped and sorted.

    The units of one group go to different tasks: the exchange is on (key, lo, hi).
    """
    unit = [*key, "lo", "hi"]
    return (df.withColumn("__n", blocks.cast("int"))
            .withColumn("b", F.pmod(F.xxhash64(F.lit(11), F.col(node)), F.col("__n")).cast("int"))
            .withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
            .withColumn("lo", F.least("b", "__o")).withColumn("hi", F.greatest("b", "__o")).drop("__o", "__n")
            .repartition(*unit).sortWithinPartitions(*unit, "b"))


def unit_tables(batches: Iterator[pa.RecordBatch], unit: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole units (input sorted by unit) with each unit's first row as offsets."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rest.append(batch)
        table = pa.Table.from_batches(rest)
        cut = _starts(table, unit)
        if len(cut) < 2:
            continue
        yield table.slice(0, int(cut[-1])).combine_chunks(), cut
        rest = table.slice(int(cut[-1])).combine_chunks().to_batches()
    if rest:
        table = pa.Table.from_batches(rest).combine_chunks()
        yield table, np.append(_starts(table, unit), table.num_rows)


def _starts(table: pa.Table, unit: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for c in unit:
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def unit_pairs(starts: np.ndarray, lo: np.ndarray, hi: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each unit, at most about ``PAIRS_AT_ONCE`` at once: inside a block, or between two."""
    n = int(starts[-1])
    sizes = np.diff(starts)
    end = np.repeat(starts[1:], sizes)
    first = np.arange(n) + 1
    cross = lo != hi
    if cross.any():  # rows of block lo stand before those of block hi
        left = cross & (b == lo)
        unit = np.repeat(np.arange(len(sizes)), sizes)
        lefts = np.bincount(unit, weights=left, minlength=len(sizes)).astype(np.int64)
        first = np.where(left, (starts[:-1] + lefts)[unit], np.where(cross, end, first))
    count = np.maximum(end - first, 0)
    total = np.concatenate([[0], np.cumsum(count)])
    a = 0
    while a < n:
        z = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS_AT_ONCE, side="right")) - 1)
        c = count[a:z]
        if m := int(c.sum()):
            i = np.repeat(np.arange(a, z), c)
            yield i, np.arange(m) - np.repeat(np.cumsum(c) - c, c) + np.repeat(first[a:z], c)
        a = z


def merge_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the trees of every pair: afterwards ``root`` maps each row to the least row it is connected to."""
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        while not np.array_equal(root, hop := root[root]):
            root = hop
        if np.array_equal(root, before):
            break
    return root


def root_edges(batches: Iterator[pa.RecordBatch], unit: list[str], survivors: Callable) -> Iterator[pa.RecordBatch]:
    """(a, b) edges that connect what ``survivors(table)(i, j)`` keeps; at most one row per input row."""
    for table, starts in unit_tables(batches, unit):
        keep, root = survivors(table), np.arange(table.num_rows)
        for i, j in unit_pairs(starts, *(table.column(c).to_numpy() for c in ("lo", "hi", "b"))):
            i, j = keep(i, j)
            root = merge_roots(root, i, j)
        node = table.column("node").to_numpy()
        at = np.flatnonzero(root != np.arange(len(root)))
        out = np.unique(np.stack([node[at], node[root[at]]], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(out[:, 0], pa.int64()), pa.array(out[:, 1], pa.int64())], ["a", "b"])


def linked_rows(batches: Iterator[pa.RecordBatch], unit: list[str], linked: Callable) -> Iterator[pa.RecordBatch]:
    """(a, b, links): per row that has links its node, its local root and the weight of its partners."""
    for table, starts in unit_tables(batches, unit):
        link, root = linked(table), np.arange(table.num_rows)
        weight, links = table.column("weight").to_numpy(), np.zeros(table.num_rows, dtype=np.int64)
        for i, j in unit_pairs(starts, *(table.column(c).to_numpy() for c in ("lo", "hi", "b"))):
            i, j = link(i, j)
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            root = merge_roots(root, i, j)
        node, at = table.column("node").to_numpy(), np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(node[at], pa.int64()), pa.array(node[root[at]], pa.int64()),
                                          pa.array(links[at], pa.int64())], ["a", "b", "links"])
