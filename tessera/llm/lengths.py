"""Exact token-length histogram with suffix sums (operator 9)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import batch as bt
from tessera.llm.store import stored
from tessera.llm.tokens import DEFAULT_VOCABULARY, encoder

#: Lengths per bucket of the two-level suffix sums.
BUCKET = 1024


def token_lengths(docs: DataFrame, text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(length): the number of token ids of each row's whole text; null and empty texts have 0."""
    def count(batches):
        for b in batches:
            data, off = bt.as_bytes(b.column(0))
            for lo, hi in bt.slices(off):
                n = encoder(vocabulary).counts(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["length"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct length, with the sums that answer questions about every context limit.

    Columns: length, docs, tokens (of this length); docs_at_least, tokens_at_least (suffix sums); docs_all, tokens_all;
    docs_share (share of documents of at most this length, the quantile it answers); truncated_tokens (total if each
    document is cut to this length). Null lengths are left out; no rows give no rows. Suffix sums run per bucket of
    ``BUCKET`` lengths and then over the buckets, so no task holds all lengths.
    """
    counts, _ = stored(lengths.where("length IS NOT NULL").groupBy("length").agg(F.count("*").alias("docs")), "length-histogram")
    hist = counts.withColumn("tokens", F.col("length") * F.col("docs")).withColumn("bucket", F.floor(F.col("length") / BUCKET))
    after = Window.orderBy(F.desc("bucket"))
    buckets = (hist.groupBy("bucket").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
               .withColumn("docs_after", F.sum("d").over(after) - F.col("d"))
               .withColumn("tokens_after", F.sum("t").over(after) - F.col("t")))
    totals = buckets.agg(F.sum("d").alias("docs_all"), F.sum("t").alias("tokens_all"))
    inside = Window.partitionBy("bucket").orderBy(F.desc("length"))
    return (hist.join(F.broadcast(buckets.drop("d", "t")), "bucket").crossJoin(F.broadcast(totals))
            .withColumn("docs_at_least", F.sum("docs").over(inside) + F.col("docs_after"))
            .withColumn("tokens_at_least", F.sum("tokens").over(inside) + F.col("tokens_after"))
            .select("length", "docs", "tokens", "docs_at_least", "tokens_at_least", "docs_all", "tokens_all",
                    ((F.col("docs_all") - F.col("docs_at_least") + F.col("docs")) / F.col("docs_all")).alias("docs_share"),
                    (F.col("tokens_all") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least"))
                    .alias("truncated_tokens")))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: docs, tokens, docs_cut and truncated_tokens if documents are cut to ``limit`` tokens (any limit)."""
    cut = F.least(F.col("length"), F.lit(limit))
    return histogram.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
                         F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("docs"))), F.lit(0)).alias("docs_cut"),
                         F.coalesce(F.sum(cut * F.col("docs")), F.lit(0)).alias("truncated_tokens"))


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least this share of the documents does not exceed."""
    wanted = F.explode(F.array(*(F.lit(float(s)) for s in shares)))
    return (histogram.select(wanted.alias("share"), "length", "docs_share").where("docs_share >= share - 1e-12")
            .groupBy("share").agg(F.min("length").alias("length")))
