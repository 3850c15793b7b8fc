"""Dedup plans and ties, infinite quantiles, top-k budgets, repeated stream batches, scratch folders."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.quantile import exact_quantiles
from tessera.operators import clean as C
from tessera.operators import retrieve as R
from tessera.session import scratch_path
from tessera.sources import collections as coll
from tessera.streaming.ingest import ingest_chunks


def test_dedup_keep_first_null_orders_ties_and_plan(spark):
    rows = [("a", 3, 1), ("a", 1, 2), ("b", None, 3), ("b", 2, 4), (None, 5, 5), (None, 4, 6), ("c", None, 7), ("d", 9, 8), ("d", 9, 8)]
    df = spark.createDataFrame(rows, "t string, o int, x int")
    got = C.dedup_keep_first(df, "t", "o")
    assert sorted((r.t or "", r.o, r.x) for r in got.collect()) == [("", 4, 6), ("a", 1, 2), ("b", 2, 4), ("c", None, 7), ("d", 9, 8)]
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_dedup_chunks_first_place_and_plan(spark):
    arts = spark.createDataFrame([(2, ["x", "y", "x"]), (1, ["y", "z"]), (None, ["x", "q", "q"]), (3, [])],
                                 "row_id long, content array<string>")
    got = C.dedup_chunks(arts)
    assert {tuple(r) for r in got.collect()} == {(1, 0, "y"), (1, 1, "z"), (2, 0, "x"), (None, 1, "q")}
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [[1.0, float("inf"), 2.0, 3.0], [float("-inf")] * 3 + [0.0, 5.0, float("inf")],
                                    [float("inf")] * 4, [-1.7e308, 0.0, 1.0, 2.0, 1.7e308]])
def test_quantiles_of_infinite_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, [], "v", [0.0, 0.5, 1.0], max_collect=1).first()
    want = sorted(values)
    mid = (want[(len(want) - 1) // 2], want[len(want) // 2])
    assert got.q0 == want[0] and got.q2 == want[-1]
    # between an infinite and a finite value the interpolation is undefined (NaN), as in numpy
    assert np.array_equal(got.q1, mid[0] if mid[0] == mid[1] else mid[0] + (mid[1] - mid[0]) * 0.5, equal_nan=True)


def test_topk_budgets_do_not_change_the_result(spark, monkeypatch):
    rnd = np.random.default_rng(8)
    q, c = rnd.integers(-3, 4, (11, 6)).astype(float), rnd.integers(-3, 4, (90, 6)).astype(float)
    Q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)] + [(99, None)], "question_id long, embedding array<double>")
    V = spark.createDataFrame([(f"c{i:02d}", v.tolist()) for i, v in enumerate(c)] + [("none", None)], "chunk_id string, embedding array<double>")
    s = q @ c.T
    want = {(i, r + 1, f"c{j:02d}") for i in range(11) for r, j in enumerate(sorted(range(90), key=lambda j: (-s[i, j], j))[:5])}
    for kw in ({}, {"block_rows": 7}, {"broadcast_floats": 10, "cell_floats": 60}, {"grid": (2, 3), "block_rows": 4}):
        got = R.similarity_search(Q, V, k=5, **kw)
        assert {(r.question_id, r["rank"], r.chunk_id) for r in got.collect()} == want, kw
    empty = R.similarity_search(Q.limit(0), V, k=5)
    assert empty.collect() == []


def test_score_blocks_are_bounded(monkeypatch):
    monkeypatch.setattr(R, "SCORE_BLOCK", 64)
    sizes = []
    plain = R._block_topk
    monkeypatch.setattr(R, "_block_topk", lambda qi, qm, ci, cm, k, m: sizes.append(len(qi) * len(ci)) or plain(qi, qm, ci, cm, k, m))
    frames = list(R._local_topk(np.arange(50), np.ones((50, 3)), np.arange(20), np.ones((20, 3)), 2, "ip"))
    assert max(sizes) <= 64 and sum(len(f) for f in frames) == 50 * 20  # all tied: every vector stays


def test_query_side_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf

    Q = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)], "question_id long, embedding array<double>")
    V = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "chunk_id string, embedding array<double>")
    for kw in ({}, {"broadcast_rows": 2}):
        before = seen.value
        R.similarity_search(Q.mapInPandas(count, Q.schema), V, k=1, **kw).collect()
        assert seen.value - before == 6, kw


def test_a_stream_batch_run_again_adds_nothing(spark):
    src, store = scratch_path(spark, "again-src"), scratch_path(spark, "again-store")
    spark.range(20).select(F.col("id").cast("string").alias("chunk_id"), F.lit("text").alias("page_content")).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for _ in range(2):  # a lost checkpoint: the same files come as batch 0 once more
        ingest_chunks(spark, src, schema, store, "live", scratch_path(spark, "again-ckpt")).awaitTermination(120)
        assert coll.read_collection(spark, store, "live").count() == 20
