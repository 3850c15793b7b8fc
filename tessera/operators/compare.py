"""Comparing runs (G11-G18): summaries, long forms, box statistics, confidence, test-set quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.plan import attach_scalars
from tessera.functions.quantile import exact_quantiles
from tessera.schemas import ALL_METRICS, JUDGE_METRICS, METRIC_DISPLAY


def _nan_to_null(c: str):
    return F.when(F.isnan(F.col(f"`{c}`")), F.lit(None)).otherwise(F.col(f"`{c}`"))


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]


def metric_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(metric, mean, std) over the double columns; NaN treated as missing; sample std."""
    cols = cols or double_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        v = _nan_to_null(c)
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.round(F.col(f"m{i}"), 6).alias("mean"),
                              F.round(F.col(f"s{i}"), 6).alias("std")) for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def combine_runs(runs: dict[str, DataFrame], display: bool = True) -> DataFrame:
    """Tag each run with its name, union by column name, rename metrics for display."""
    if not runs:
        raise ValueError("no runs to combine")
    out = None
    for name, df in runs.items():
        if df is None:
            raise ValueError(f"No evaluation results available for {name}.")
        tagged = df.withColumn("evaluator", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if display:
        for src, dst in METRIC_DISPLAY.items():
            if src in out.columns:
                out = out.withColumnRenamed(src, dst)
    return out


def melt_metrics(df: DataFrame, metrics=None, id_col: str = "evaluator") -> DataFrame:
    """Wide metric columns -> (evaluator, metric, value)."""
    metrics = list(metrics or [METRIC_DISPLAY[m] for m in JUDGE_METRICS])
    sub = df.select(id_col, *[_nan_to_null(m).cast("double").alias(m) for m in metrics])
    return sub.unpivot(id_col, metrics, "metric", "value")


def comparative_stats(df: DataFrame, use_median: bool = False, metrics=None, id_col: str = "evaluator") -> DataFrame:
    """Per run x metric: mean (or median) and sample std, with clipped error-bar bounds.

    All-null (run, metric) pairs are kept with NULL statistics.
    """
    metrics = list(metrics or [METRIC_DISPLAY[m] for m in ALL_METRICS])
    long = melt_metrics(df, metrics, id_col)
    st = long.groupBy(id_col, "metric").agg(F.avg("value").alias("value"), F.stddev_samp("value").alias("std"))
    if use_median:  # exact median without gathering a group in one task
        med = exact_quantiles(long, [id_col, "metric"], "value", [0.5]).select(id_col, "metric", F.col("q0").alias("med"))
        st = st.join(med, [id_col, "metric"], "left").withColumn("value", F.col("med")).drop("med")
    return st.select(id_col, "metric", F.round("value", 6).alias("value"), F.round("std", 6).alias("std"),
                     F.round(F.greatest(F.lit(0.0), F.col("value") - F.col("std")), 6).alias("lower"),
                     F.round(F.least(F.lit(1.0), F.col("value") + F.col("std")), 6).alias("upper"))


def box_stats(df: DataFrame, value: str = "value", by=("evaluator", "metric"), approx: bool = False) -> DataFrame:
    """Quartiles (linear interpolation), whiskers within 1.5 IQR, outlier count per group.

    Quartiles are exact (``exact_quantiles``: bucket narrowing, no group gathered
    in one task) unless ``approx``; then one aggregate joins back for the whiskers.
    """
    by = list(by)
    v = F.col(value).cast("double")
    base = df.select(*by, v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    if approx:
        q = base.groupBy(*by).agg(F.percentile_approx("v", [0.25, 0.5, 0.75], 10000).alias("q"),
                                  F.count(F.lit(1)).alias("n"))
        q = q.select(*by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    else:
        q = exact_quantiles(base, by, "v", [0.25, 0.5, 0.75]).select(
            *by, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * iqr).withColumn("hi_fence", F.col("q3") + 1.5 * iqr)
    j = base.join(q, by)
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    w = j.groupBy(*by).agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"), F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_outliers"))
    out = q.join(w, by)
    return out.select(*by, F.col("n").cast("long").alias("n"), *[F.round(c, 6).alias(c) for c in
                      ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_outliers")


def mean_pair(df: DataFrame, x: str, y: str, id_col: str = "evaluator") -> DataFrame:
    """Per run: mean of two metrics."""
    return df.groupBy(id_col).agg(F.round(F.avg(_nan_to_null(x)), 6).alias("mean_x"),
                                  F.round(F.avg(_nan_to_null(y)), 6).alias("mean_y"))


def system_confidence(df: DataFrame, metrics=None, id_col: str = "evaluator",
                      correctness: str = METRIC_DISPLAY["answer_correctness"]) -> DataFrame:
    """Per run: average of the metric stds; confidence = max over runs + 1 - that average."""
    metrics = list(metrics or [METRIC_DISPLAY[m] for m in ALL_METRICS])
    long = melt_metrics(df, metrics, id_col)
    stds = long.groupBy(id_col, "metric").agg(F.stddev_samp("value").alias("std"))
    avg_std = stds.groupBy(id_col).agg(F.avg("std").alias("avg_std"))
    mx = avg_std.agg(F.max("avg_std").alias("max_std"))
    corr = df.groupBy(id_col).agg(F.avg(_nan_to_null(correctness)).alias("correctness_mean"))
    out = attach_scalars(avg_std, mx).join(corr, id_col)
    return out.select(id_col, F.round("avg_std", 6).alias("avg_std"),
                      F.round(F.col("max_std") + 1 - F.col("avg_std"), 6).alias("system_confidence"),
                      F.round("correctness_mean", 6).alias("correctness_mean"))


# Test-set question kinds and their default shares (fixed values).
DEFAULT_DISTRIBUTION = {"simple": 0.5, "reasoning": 0.25, "multi_context": 0.25}


def quotas(n: int, distribution: dict[str, float]) -> list[tuple[str, int]]:
    """Largest-remainder split of ``n`` questions over the kinds (ties in the given order)."""
    if abs(sum(distribution.values()) - 1.0) > 1e-9:
        raise ValueError("distribution must sum to 1")
    unknown = [k for k in distribution if k not in DEFAULT_DISTRIBUTION]
    if unknown:
        raise ValueError(f"unknown question kinds {unknown}")
    raw = [(k, n * p) for k, p in distribution.items()]
    base = {k: int(x) for k, x in raw}
    left = n - sum(base.values())
    for k, _ in sorted(raw, key=lambda kx: -(kx[1] - int(kx[1])))[:left]:
        base[k] += 1
    return [(k, base[k]) for k in distribution]


def allocate_testset(docs: DataFrame, key: str, n: int = 10, distribution: dict[str, float] | None = None,
                     n_docs: int = 5, seed: int = 42) -> DataFrame:
    """(slot, kind, doc, second_doc) plan for test-set generation over the first ``n_docs`` documents.

    Slots get kinds by quota; a slot's document is picked by a seeded hash among
    the first documents in key order; multi-context slots also carry the next one.
    """
    q = quotas(n, distribution or DEFAULT_DISTRIBUTION)
    spark = docs.sparkSession
    first = docs.select(key).orderBy(key).limit(n_docs)
    w = Window.orderBy(key)
    ranked = first.select(key, (F.row_number().over(w) - 1).alias("pos"))
    m = ranked.agg(F.count(F.lit(1)).alias("m"))
    kinds = [k for k, c in q for _ in range(c)]
    slots = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "slot int, kind string")
    pick = F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("slot").cast("string")), 256), 1, 8),
                         16, 10).cast("bigint"), F.col("m"))
    s = attach_scalars(slots, m).where(F.col("m") > 0).withColumn("pos", pick)
    s = s.withColumn("pos2", F.when(F.col("kind") == "multi_context", F.pmod(F.col("pos") + 1, F.col("m"))))
    r1 = ranked.select(F.col("pos"), F.col(key).alias("doc"))
    r2 = ranked.select(F.col("pos").alias("pos2"), F.col(key).alias("second_doc"))
    return (s.join(F.broadcast(r1), "pos").join(F.broadcast(r2), "pos2", "left")
            .select("slot", "kind", "doc", "second_doc"))
