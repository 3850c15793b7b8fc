"""Top-k: broadcast path = block-grid path = numpy brute force; plan shape."""
import numpy as np
from pyspark.sql import functions as F

from tessera.operators import retrieve as R


def _data(spark, n_q=7, n_c=60, dim=8, seed=3):
    rnd = np.random.default_rng(seed)
    q = rnd.normal(size=(n_q, dim)).astype(np.float32)
    c = rnd.normal(size=(n_c, dim)).astype(np.float32)
    c[5] = c[6]  # exact tie, broken by chunk id
    Q = spark.createDataFrame([(i, q[i].tolist()) for i in range(n_q)], "question_id long, embedding array<float>")
    C = spark.createDataFrame([(f"c{i:03d}", c[i].tolist()) for i in range(n_c)], "chunk_id string, embedding array<float>")
    return q, c, Q, C


def _brute(q, c, k):
    s = q.astype(np.float64) @ c.astype(np.float64).T
    out = {}
    for i in range(len(q)):
        order = sorted(range(len(c)), key=lambda j: (-round(s[i, j], 9), f"c{j:03d}"))[:k]
        out[i] = [f"c{j:03d}" for j in order]
    return out


def _ranked(df):
    out = {}
    for r in df.orderBy("question_id", "rank").collect():
        out.setdefault(r["question_id"], []).append(r["chunk_id"])
    return out


def test_broadcast_and_grid_agree_with_brute_force(spark):
    q, c, Q, C = _data(spark)
    want = _brute(q, c, 4)
    assert _ranked(R.similarity_search(Q, C, k=4)) == want
    assert _ranked(R.similarity_search(Q, C, k=4, grid=(3, 4))) == want


def test_window_group_limit_in_plan(spark):
    _, _, Q, C = _data(spark)
    plan = R.similarity_search(Q, C, k=4)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_l2_ranking_equals_cosine_on_unit_vectors(spark):
    q, c, Q, C = _data(spark)
    unit = C.select("chunk_id", F.transform("embedding", lambda x: x / F.sqrt(F.aggregate(
        "embedding", F.lit(0.0), lambda a, y: a + y * y))).alias("embedding"))
    a = _ranked(R.similarity_search(Q, unit, k=3))
    b = _ranked(R.search_with_scores(Q, unit, k=3))
    assert a == b


def test_oversized_query_side_falls_back_to_grid(spark):
    q, c, Q, C = _data(spark, n_q=9)
    want = _brute(q, c, 3)
    # a 4-row broadcast budget: the count is larger and the block-grid cogroup runs
    hits = R.similarity_search(Q, C, k=3, broadcast_rows=4)
    assert "FlatMapCoGroupsInPandas" in hits._jdf.queryExecution().executedPlan().toString()
    assert _ranked(hits) == want
