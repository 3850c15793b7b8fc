"""Mixing sources to target weights by systematic sampling (operator 4): DataFrame functions only.

Within a source every document has the same expected number of copies r = target / source size. In a fixed order of
the source (by a keyed digest of the id) the running total of expected copies plus one random offset crosses
integer boundaries; each crossing emits the document once, so a document has floor(r) or ceil(r) copies.
The offset is one of ``OFFSETS`` evenly spaced ones from a random start: the one whose words come nearest to the
target. The running total is rank * r, so only ranks are
needed: a range exchange on (source, digest, id, size), row numbers inside each range, and a prefix sum of the
ranges' counts per source. A source of any size is spread over many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.store import numbered, small, stored

WORD = r"[^\x20\x09-\x0D]+"
OFFSETS = 32
SPACES = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Number of words of the whole text (null: 0)."""
    marks = F.translate(F.regexp_replace(text, WORD, "x"), SPACES, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: float = 3) -> DataFrame:
    """(source, source_size) -> the same and ``target``, one row per source.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the total by weight; a target stops at
    ``cap`` times its source's size and the excess is shared again by weight until none is above. That is
    target = min(cap * size, level * weight) with the level at which the targets add up to the total. One row per
    source meets in one task here: a mixture has few sources.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    s = (sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
         .withColumn("cap", F.col("source_size") * cap))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    every, before = Window.partitionBy(), by.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every)
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / rest)
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)
    s = s.withColumn("settled", level["level"])
    return s.select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("settled") * F.col("weight")).alias("target"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1,
             cap: float = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): how often each row is emitted.

    Null texts have size 0; a null source is a source of its own; rows with equal id and size are alike and share
    their copies in any order; a source without words has target 0 and no copies. Reruns with a seed agree.
    Other columns are ignored, an empty table gives no rows.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows, _ = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                 word_count(F.col(text_col)).alias("size"), digest.alias("tie")), "mix-sizes")
    targets, _ = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cap), "mix-targets")
    ranged, _ = stored(rows.repartitionByRange("source", "tie", "doc_id", "size")
                       .withColumn("part", F.spark_partition_id()), "mix-ranges")
    inside = Window.partitionBy("part", "source").orderBy("tie", "doc_id", "size")
    ahead = Window.partitionBy("source").orderBy("part")
    offsets = (ranged.groupBy("source", "part").agg(F.count("*").alias("n"))
               .withColumn("ahead", F.sum("n").over(ahead) - F.col("n"))
               .select(F.col("source").alias("o_source"), F.col("part").alias("o_part"), "ahead"))
    t = targets.withColumnRenamed("source", "t_source")
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|offset|"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    start = start.cast("double") / F.lit(4294967296.0 * OFFSETS)
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ranked, _ = stored(ranged.withColumn("rn", F.row_number().over(inside))
                       .join(small(stored(offsets, "mix-offsets")[0]),
                             F.col("source").eqNullSafe(F.col("o_source")) & (F.col("part") == F.col("o_part")))
                       .join(small(t), F.col("source").eqNullSafe(F.col("t_source")))
                       .select("doc_id", "source", "size", "source_size", "target", r.alias("r"), start.alias("start"),
                               (F.col("ahead") + F.col("rn")).alias("rank")), "mix-ranked")

    def copies(offset):
        return F.floor(offset + F.col("rank") * F.col("r")) - F.floor(offset + (F.col("rank") - 1) * F.col("r"))

    tried = ranked.groupBy("source", "start", "target").agg(
        *(F.sum(F.col("size") * copies(F.col("start") + F.lit(j / OFFSETS))).alias(f"t{j}") for j in range(OFFSETS)))
    best = F.array_min(F.array(*(F.struct(F.abs(F.col(f"t{j}") - F.col("target")).alias("off"), F.lit(j / OFFSETS).alias("add"))
                                 for j in range(OFFSETS))))
    chosen = tried.select(F.col("source").alias("c_source"), (F.col("start") + best["add"]).alias("offset"))
    ranked = ranked.join(small(stored(chosen, "mix-offset")[0]), F.col("source").eqNullSafe(F.col("c_source")))
    return (ranked.withColumn("copies", copies(F.col("offset")).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: each row of ``docs`` (all columns) as often as the plan emits it."""
    rows = numbered(docs.select(F.struct("*").alias("row")), "mix-rows")
    plan = mix_plan(rows.select("node", F.col("row")[text_col].alias("text"), F.col("row")[source_col].alias("source")),
                    id_col="node", **options)
    chosen, _ = stored(plan.where("copies > 0").select(F.col("doc_id").alias("node"), "copies"), "mix-chosen")
    return (rows.join(small(chosen), "node")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*"))
