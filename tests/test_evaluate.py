"""Rank metrics, verdict formulas and summaries on the FIXTURES.md hand-made tables."""
import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import compare as G2
from tessera.operators import evaluate as EV


def test_rr_and_hit_at_k(spark):
    rows = [(1, [7, 8, 9], 7), (2, [8, 7, 9], 7), (3, [8, 9, 7], 7), (4, [8, 9], 7), (5, [7, 7, 8], 7),
            (6, [], 7), (7, [1, 2], None)]
    df = spark.createDataFrame(rows, "example_id long, contexts_origin_doc_ids array<long>, best_match_id long")
    got = {r[0]: (r[1], r[2], r[3]) for r in df.select(
        "example_id", EV.reciprocal_rank(), EV.hit_at_k(2), EV.hit_at_k(10)).collect()}
    assert got[1] == (1.0, 1.0, 1.0)
    assert got[2] == (0.5, 1.0, 1.0)
    assert abs(got[3][0] - 1 / 3) < 1e-12 and got[3][1] == 0.0
    assert got[4] == (0.0, 0.0, 0.0) and got[5][0] == 1.0 and got[6] == (0.0, 0.0, 0.0)
    assert got[7] == (0.0, 0.0, 0.0)
    for _, (rr, _, h10) in got.items():
        assert (rr > 0) == (h10 > 0)


def test_context_precision_formula(spark):
    v = [(1, 1, 0), (1, 2, 0), (2, 1, 1), (2, 2, 1), (3, 1, 1), (3, 2, 0), (3, 3, 1)]
    df = spark.createDataFrame(v, "example_id long, rank int, verdict int")
    got = dict(EV.context_precision_long(df).collect())
    assert got[1] == 0.0 and got[2] == 1.0
    assert abs(got[3] - (1.0 + 2 / 3) / 2) < 1e-12


def test_metric_summary_nan_null_single(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (float("nan"), None, None), (3.0, None, None)],
                               "a double, b double, c double")
    got = {r["metric"]: (r["mean"], r["std"]) for r in G2.metric_summary(df).collect()}
    assert got["a"][0] == 2.0 and abs(got["a"][1] - math.sqrt(2)) < 1e-6
    assert got["b"] == (None, None)
    assert got["c"] == (2.0, None)  # n = 1 -> sample std undefined


def test_combine_runs_requires_results(spark):
    with pytest.raises(ValueError):
        G2.combine_runs({"x": None})


def test_quotas():
    assert G2.quotas(10, G2.DEFAULT_DISTRIBUTION) == [("simple", 5), ("reasoning", 3), ("multi_context", 2)]
    with pytest.raises(ValueError):
        G2.quotas(10, {"simple": 0.9})
    with pytest.raises(ValueError):
        G2.quotas(10, {"other": 1.0})


def test_box_stats_matches_numpy(spark):
    import numpy as np
    vals = [1.0, 2.0, 2.5, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "evaluator string, value double").withColumn("metric", F.lit("m"))
    r = G2.box_stats(df).first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (r["q1"], r["median"], r["q3"]) == (round(q1, 6), round(med, 6), round(q3, 6))
    assert r["n_outliers"] == 1 and r["whisker_hi"] == 4.0


def test_exact_quantiles_hot_group_small_budget(spark):
    import numpy as np

    from tessera.functions.quantile import exact_quantiles
    rnd = np.random.default_rng(1)
    hot = rnd.normal(size=3000).round(3)  # many duplicates
    cold = rnd.exponential(size=7)
    rows = [("hot", float(x)) for x in hot] + [("cold", float(x)) for x in cold] + [("one", 5.0), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", probs, bins=8, max_collect=20).collect()}
    for g, vals in (("hot", hot), ("cold", cold), ("one", np.array([5.0]))):
        want = np.percentile(vals, [p * 100 for p in probs])
        assert got[g]["n"] == len(vals)
        assert np.allclose([got[g][f"q{i}"] for i in range(len(probs))], want, rtol=0, atol=1e-12)
    assert "nan" not in got
