"""Profiles from hashes and sketches, histogram limits, samples found by counts."""
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.sources import io


def _frame(spark):
    rows = [(1, "a", 0.0, ["x"], None), (2, "a", -0.0, ["x"], None), (3, None, float("nan"), [], None), (3, "", float("nan"), None, None)]
    return spark.createDataFrame(rows, "n long, `t.x` string, d double, l array<string>, void_ string")


def test_profile_without_expand_or_texts(spark):
    prof = P.column_profile(_frame(spark))
    assert {r["column"]: (r.total_count, r.nan_count, r.unique_count) for r in prof.collect()} == {
        "n": (4, 0, 3), "t.x": (3, 1, 2), "d": (4, 0, 2), "l": (3, 1, 2), "void_": (0, 4, 0)}
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "t.x" in line]
    empty = P.column_profile(_frame(spark).limit(0)).collect()
    assert len(empty) == 5 and all(r.total_count == r.unique_count == 0 and r.nan_pct is None for r in empty)


def test_sketches_of_parts_merge(spark):
    df = spark.range(30000).select((F.col("id") % 20000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("s"))
    parts = P.profile_sketch(df.where("k % 2 = 0")).unionByName(P.profile_sketch(df.where("k % 2 = 1")))
    got = {r["column"]: r for r in P.merged_profile(parts).collect()}
    assert got["k"].total_count == 30000 and abs(got["k"].unique_count / 20000 - 1) < 0.03
    assert (got["s"].total_count, got["s"].nan_count, got["s"].unique_count) == (20000, 10000, 7)
    whole = {r["column"]: r.unique_count for r in P.column_profile(df, approx=True).collect()}
    assert whole == {c: r.unique_count for c, r in got.items()}


def test_histogram_limits_show_the_same_bins(spark):
    df = spark.range(101).select(F.col("id").alias("v"))
    every = [tuple(r) for r in P.histogram(df, "v", 20).collect()]
    some = [tuple(r) for r in P.histogram(df, "v", 20, limits=(12, 31)).collect()]
    assert sorted(some) == [r for r in sorted(every) if r[2] >= 12 and r[1] <= 31] and 4 <= len(some) < 20


@pytest.mark.parametrize("n", [0, 1, 102, 500, 999, 1000])
def test_sample_is_the_first_by_digest(spark, n):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    want = sorted(sorted(range(1000), key=lambda k: hashlib.sha256(f"42:{k}".encode()).hexdigest())[:n])
    for most in (100_000, 3):
        assert sorted(r.k for r in io.sample_exact(df.repartition(3), n, "k", most_sorted=most).collect()) == want


def test_sample_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 0)] * 3, "k long, v long")
    for n in (0, 1, 49, 51, 53):
        got = io.sample_exact(df, n, "k", most_sorted=5).collect()
        assert len(got) == n
    with pytest.raises(ValueError):
        io.sample_exact(df, 54, "k")
