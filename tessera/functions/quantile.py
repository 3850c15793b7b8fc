"""Exact per-group quantiles without gathering a group into one task.

Linear interpolation between order statistics (the definition numpy, pandas,
Spark ``percentile`` and DuckDB ``quantile_cont`` share). Each needed order
statistic (group, rank) is found by bucket narrowing: a pass counts the
candidate values of every unresolved (group, rank) in ``bins`` equal-width
buckets (a partial-aggregated histogram, at most ``bins`` rows per statistic),
keeps the bucket that holds the rank, and narrows the value range to that
bucket's min/max. The bucket map is monotone, so the narrowed range holds
exactly the bucket's values. Once at most ``max_collect`` candidates remain
they are sorted in one small group; a range with min == max is resolved
directly. A group holding a third of all rows costs a few scans of a narrow
(group, value) projection, never one task holding the whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float], bins: int = 4096,
                    max_collect: int = 50_000, max_passes: int = 16) -> DataFrame:
    """(by..., n, q0..q{m-1}) per group; NULL/NaN values are ignored, infinite ones count."""
    if not by:
        out = exact_quantiles(df.withColumn("__g", F.lit(0)), ["__g"], value, probs, bins, max_collect, max_passes)
        return out.drop("__g")
    v = F.col(value).cast("double")
    base = df.select(*by, v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")).checkpoint()
    stats = base.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"))
    targets = stats.select(*by, "n", "mn", "mx", F.explode(F.array(*[
        F.struct(F.lit(i).alias("pi"), ((F.col("n") - 1) * F.lit(float(p))).alias("k")) for i, p in enumerate(probs)
    ])).alias("t")).select(*by, "n", "mn", "mx", "t.pi", "t.k")
    targets = targets.select("*", F.floor("k").cast("long").alias("r0"), F.ceil("k").cast("long").alias("r1"))
    ranks = (targets.select(*by, "mn", "mx", "n", F.col("r0").alias("r"))
             .unionByName(targets.select(*by, "mn", "mx", "n", F.col("r1").alias("r"))).distinct())
    state = ranks.select(*by, "r", F.col("mn").alias("lo"), F.col("mx").alias("hi"), F.lit(0).cast("long").alias("below"),
                         F.col("n").alias("c"), F.when(F.col("mn") == F.col("mx"), F.col("mn")).alias("val")).checkpoint()
    done = state.where(F.col("val").isNotNull())
    active = state.where(F.col("val").isNull())
    for _ in range(max_passes):
        if active.limit(1).count() == 0:
            break
        small = active.where(F.col("c") <= max_collect)
        large = active.where(F.col("c") > max_collect)
        # (1) few candidates left: sort them (at most max_collect values per statistic)
        picked = (base.join(small, by).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                  .groupBy(*by, "r", "below").agg(F.sort_array(F.collect_list("v")).alias("vs"))
                  .select(*by, "r", F.element_at("vs", (F.col("r") - F.col("below") + 1).cast("int")).alias("val")))
        resolved = small.select(*by, "r", "lo", "hi", "below", "c").join(picked, by + ["r"])
        # (2) many candidates: histogram, keep the bucket holding the rank
        # an infinite end gets a bucket of its own; a range too wide for a double is halved first
        inf = float("inf")
        width = F.col("hi") - F.col("lo")
        share = F.when(F.abs(width) < inf, (F.col("v") - F.col("lo")) / width).otherwise(
            (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2))
        bucket = F.when((F.col("lo") == -inf) | (F.col("hi") == inf),
                        F.when(F.col("v") == -inf, 0).when(F.col("v") == inf, bins - 1).otherwise(1)).otherwise(
            F.least(F.floor(share * F.lit(float(bins))).cast("int"), F.lit(bins - 1)))
        hist = (base.join(large, by).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                .select(*by, "r", "below", bucket.alias("b"), "v")
                .groupBy(*by, "r", "below", "b").agg(F.count(F.lit(1)).alias("cb"), F.min("v").alias("bmin"),
                                                    F.max("v").alias("bmax")))
        w = Window.partitionBy(*by, "r").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("cum", F.sum("cb").over(w))
        chosen = hist.where((F.col("below") + F.col("cum") - F.col("cb") <= F.col("r")) &
                            (F.col("r") < F.col("below") + F.col("cum")))
        narrowed = chosen.select(*by, "r", F.col("bmin").alias("lo"), F.col("bmax").alias("hi"),
                                 (F.col("below") + F.col("cum") - F.col("cb")).alias("below"), F.col("cb").alias("c"),
                                 F.when(F.col("bmin") == F.col("bmax"), F.col("bmin")).alias("val"))
        nxt = resolved.unionByName(narrowed).checkpoint()
        done = done.unionByName(nxt.where(F.col("val").isNotNull()))
        active = nxt.where(F.col("val").isNull())
    else:
        raise RuntimeError("quantile narrowing did not converge")
    vals = done.select(*by, "r", "val")
    q = (targets.join(vals.withColumnRenamed("r", "r0").withColumnRenamed("val", "x0"), by + ["r0"])
         .join(vals.withColumnRenamed("r", "r1").withColumnRenamed("val", "x1"), by + ["r1"]))
    between = F.col("x0") + (F.col("x1") - F.col("x0")) * (F.col("k") - F.col("r0"))
    q = q.select(*by, "n", "pi", F.when((F.col("k") == F.col("r0")) | (F.col("x0") == F.col("x1")), F.col("x0"))
                 .otherwise(between).alias("x"))
    return q.groupBy(*by, "n").pivot("pi", list(range(len(probs)))).agg(F.first("x")).select(
        *by, "n", *[F.col(f"`{i}`").alias(f"q{i}") for i in range(len(probs))])
