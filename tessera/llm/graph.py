"""Distributed connected components (alternating large-star and small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.store import BROADCAST_ROWS, drop_table, stored


def connected_components(edges: DataFrame, max_rounds: int = 60, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the least node reachable.

    Each round is two grouped minima, added up in every task before rows move, and two lookups of them, which leave the
    edges of a node with very many neighbours spread over the tasks: with few edges the minima are broadcast, with
    more see ``_met``. Rounds (and of large graphs the minima) are written to the shared folder, so a lost executor
    costs one of them. Null ends and loops are ignored; no edges give no rows.
    """
    # spark's own comparison of struct<low, high> orders each edge as (high, low)
    flat = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, path = stored(flat, "cc")
    spark, mark = edges.sparkSession, _mark(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, paths = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), F.count("*").alias("n")), [path]
        if 2 * mark[0] <= broadcast_rows:  # there are at most two nodes to an edge
            large = _large(both.where("v > u").join(F.broadcast(least.drop("n")), "u"))
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            met = large.join(F.broadcast(low), "u")
        else:
            least, least_path = stored(least, "cc-least")
            large, large_path = stored(_large(_met(both.where("v > u"), least, 2 * mark[0], broadcast_rows)), "cc-large")
            low, low_path = stored(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "cc-low")
            met = _met(large, low, large.count(), broadcast_rows)
            paths += [least_path, large_path, low_path]
        small = (met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after, after_path = stored(small, "cc")
        for p in paths:
            drop_table(spark, p)
        now, path, last, mark = after, after_path, mark, _mark(after)
        if mark == last:
            break
    else:
        raise RuntimeError("connected components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large(met: DataFrame) -> DataFrame:
    return met.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _met(edges: DataFrame, least: DataFrame, total: int, broadcast_rows: int) -> DataFrame:
    """``edges`` with the minimum (m) of their u. ``least`` (u, m, n) is a written table of ``total`` counted edges.

    Minima of at most ``broadcast_rows`` nodes are broadcast. Of more, those of the nodes with more than a
    ``broadcast_rows``-th of all edges are, which are fewer than that, and the others' edges meet theirs in a join.
    """
    if least.count() <= broadcast_rows:
        return edges.join(F.broadcast(least.drop("n")), "u")
    heavy = F.col("n") > total // broadcast_rows
    some = edges.join(F.broadcast(least.where(heavy).drop("n")), "u", "left")
    rest = some.where("m IS NULL").drop("m").join(least.where(~heavy).drop("n"), "u")
    return some.where("m IS NOT NULL").unionByName(rest)


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edge set."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())
