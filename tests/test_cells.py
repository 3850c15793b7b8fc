"""Coarse cells: exact search equals brute force, probing reaches its recall, only needed cells are read."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cells as C
from tessera.operators import retrieve as R
from tessera.session import scratch_path
from tessera.sources import collections as coll
from tessera.sources.tables import table


def _data(spark, seed=0, n=600, dim=6, unit=False):
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(12, dim)) * 3
    v = middle[rnd.integers(0, 12, n)] + rnd.normal(size=(n, dim)) * rnd.choice([0.05, 0.6], (n, 1))
    v[5] = v[6]
    if unit:
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    q = np.concatenate([v[:10], rnd.normal(size=(15, dim)) * 4])
    V = spark.createDataFrame([(f"c{i:03d}", x.tolist()) for i, x in enumerate(v)] + [("none", None)], "chunk_id string, embedding array<double>")
    Q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)] + [(99, None)], "question_id long, embedding array<double>")
    return q, v, Q, V


def _found(df):
    return sorted((r.question_id, r["rank"], r.chunk_id) for r in df.collect())


@pytest.mark.parametrize("metric,unit", [("ip", False), ("ip", True), ("l2", False)])
def test_exact_equals_a_full_scan(spark, metric, unit):
    q, v, Q, V = _data(spark, unit=unit)
    store = scratch_path(spark, "cells")
    assert 1 < C.build_cells(V, store, "v", cells=12) <= 12
    want = _found(R.similarity_search(Q, V, k=5, metric=metric))
    for how in ({}, {"first_probes": 1}, {"broadcast_rows": 0, "cell_floats": 60}):
        assert _found(C.cell_search(Q, store, "v", k=5, metric=metric, **how)) == want, how


def test_more_neighbours_than_vectors_and_rebuilding(spark):
    q, v, Q, V = _data(spark, seed=1, n=30)
    store = scratch_path(spark, "cells-small")
    C.build_cells(V, store, "v", cells=4, file_rows=3)
    assert _found(C.cell_search(Q, store, "v", k=40)) == _found(R.similarity_search(Q, V, k=40))
    other = V.where(F.col("chunk_id") < "c010")
    C.build_cells(other, store, "v", cells=3)
    assert _found(C.cell_search(Q, store, "v", k=2)) == _found(R.similarity_search(Q, other, k=2))
    names = {n for n in coll.store_state(spark, store)[1] if n != "v#cells"}
    assert len({n.split("#")[1] for n in names}) == 1  # the old cells are gone


def test_far_cells_are_not_searched(spark, monkeypatch):
    """Two distant clouds: queries near one leave the other's cells alone, by the bound, in the exact search too."""
    rnd = np.random.default_rng(2)
    v = np.concatenate([rnd.normal(size=(50, 4)), rnd.normal(size=(50, 4)) + 100])
    V = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "chunk_id long, embedding array<double>")
    Q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v[:5] + 0.01)], "question_id long, embedding array<double>")
    store = scratch_path(spark, "cells-far")
    C.build_cells(V, store, "v", centres=np.array([[0.0] * 4, [100.0] * 4, [0.5] * 4]))
    read, plain = [], C.read_collections
    monkeypatch.setattr(C, "read_collections", lambda s, st, names: read.extend(names) or plain(s, st, names))
    got = _found(C.cell_search(Q, store, "v", k=3, metric="l2", first_probes=1))
    assert got == _found(R.similarity_search(Q, V, k=3, metric="l2"))
    assert {n.rsplit("#", 1)[1] for n in read} <= {"0", "2"}


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_probing_reaches_its_recall(spark, sf_small, metric):
    """The number of cells is measured on a sample of the queries; all of them together reach the recall with it."""
    e = table(spark, sf_small, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    store = scratch_path(spark, "cells-recall")
    C.build_cells(e, store, "v", cells=32)
    queries = e.withColumnRenamed("chunk_id", "question_id")
    p = C.probes_for_recall(queries, store, "v", recall=0.95, k=10, metric=metric, exclude_self=True, most_queries=200)
    want = {(r[0], r[2]) for r in _found(R.similarity_search(queries, e, k=10, metric=metric, exclude_self=True))}
    got = {(r[0], r[2]) for r in _found(C.cell_search(queries, store, "v", k=10, probes=p, metric=metric, exclude_self=True))}
    assert 1 < p < 32 and len(got & want) / len(want) >= 0.9


def test_empty_sides(spark):
    _, _, Q, V = _data(spark, seed=3, n=20)
    store = scratch_path(spark, "cells-empty")
    assert C.build_cells(V.where("chunk_id = 'none'"), store, "v", cells=4) == 0
    assert C.cell_search(Q, store, "v").collect() == []
    C.build_cells(V, store, "w", cells=4)
    assert C.cell_search(Q.where("question_id = 99"), store, "w").collect() == []
    with pytest.raises(Exception, match="vector of odd has not 6 values"):
        C.build_cells(V.unionByName(spark.createDataFrame([("odd", [1.0])], V.schema)), store, "x", centres=np.zeros((2, 6)))
    with pytest.raises(ValueError):
        C.fit_centroids(V, cells=10**7)
