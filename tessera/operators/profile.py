"""Corpus profiling (B1-B11). Every operator is one declarative plan with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.plan import attach_scalars
from tessera.functions.text import word_count


def _hashes(c: Column) -> tuple[Column, Column]:
    """128 bits that stand for a value where values are told apart; NULL for NULL."""
    return F.when(c.isNotNull(), F.xxhash64(c)), F.when(c.isNotNull(), F.xxhash64(F.lit(1), c))


def _hashable(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    return F.to_json(c) if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)) else c


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: non-null count, null count and %, distinct count (nulls excluded) and % of rows (B1).

    One pass over the rows. Exact distinct counts come from one aggregate by (column, 128-bit hash): each task adds up
    its own values first, and no text is shuffled. ``approx`` keeps a sketch per column instead (``profile_sketch``).
    """
    if approx:
        return merged_profile(profile_sketch(df))
    fields = df.schema.fields
    values = F.array(*(F.struct(F.lit(i).alias("i"), *(h.alias(n) for h, n in zip(_hashes(_hashable(f)), ("h1", "h2"))))
                       for i, f in enumerate(fields)))
    per_value = df.select(F.inline(values)).groupBy("i", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("h1").isNotNull()
    per_column = per_value.groupBy("i").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("total_count"),
                                            F.count(F.when(known, 1)).alias("unique_count"))
    names = df.sparkSession.createDataFrame([(i, f.name) for i, f in enumerate(fields)], "i int, column string")
    # an empty table has no values: its columns are still listed
    found = names.join(F.broadcast(per_column), "i", "left").na.fill(0, ["rows", "total_count", "unique_count"])
    return _shares(found.withColumn("nan_count", F.col("rows") - F.col("total_count")))


def _shares(found: DataFrame) -> DataFrame:
    def pct(c):
        return F.when(F.col("rows") > 0, F.round(F.lit(100.0) * F.col(c) / F.col("rows"), 6))

    return found.select("column", "total_count", "nan_count", pct("nan_count").alias("nan_pct"),
                        "unique_count", pct("unique_count").alias("unique_pct"))


def profile_sketch(df: DataFrame, lg_k: int = 14) -> DataFrame:
    """(column, rows, total_count, sketch): counts and a HyperLogLog sketch of each column's values.

    A few kilobytes per column, however many rows; sketches of parts of a table (days, files) can be stored and merged
    later with ``merged_profile`` without reading the rows again.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        value = _hashable(f)
        known = F.when(value.isNotNull(), F.xxhash64(value))
        aggs += [F.count(known).alias(f"c{i}"), F.hll_sketch_agg(known, lg_k).alias(f"s{i}")]
    each = F.array(*(F.struct(F.lit(f.name).alias("column"), F.col(f"c{i}").alias("total_count"), F.col(f"s{i}").alias("sketch"))
                     for i, f in enumerate(df.schema.fields)))
    return df.agg(*aggs).select("rows", F.inline(each)).select("column", "rows", "total_count", "sketch")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all rows that any number of ``profile_sketch`` tables have seen; distinct counts are estimates."""
    merged = sketches.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("total_count").alias("total_count"),
                                            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_count"))
    return _shares(merged.withColumn("nan_count", F.col("rows") - F.col("total_count")))


def chunks_per_article(articles: DataFrame, key: str = "row_id", content: str = "content") -> DataFrame:
    """List length per article."""
    return articles.select(key, F.size(content).alias("n_chunks"))


def words_per_chunk(articles: DataFrame, key: str = "row_id", content: str = "content") -> DataFrame:
    """Whitespace-token count of every chunk, flattened."""
    return (articles.select(key, F.posexplode(content).alias("chunk_no", "chunk"))
            .select(key, "chunk_no", word_count("chunk").alias("n_words")))


def histogram(df: DataFrame, col: str, bins: int, limits: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed; empty bins included.

    ``limits`` shows the bins that reach into this range, as an axis limit does: bins and counts stay the same.

    Edges are ``min + i*step`` with the last edge exactly ``max`` (as linspace
    builds them); a value goes to bin i when edge_i <= x < edge_{i+1}. One
    aggregate for the range, a broadcast of that single row, a partial-aggregated
    count per bin, and a left join of the bin grid (``bins`` rows).
    """
    spark = df.sparkSession
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    raw_stats = vals.agg(F.min("x").alias("mn0"), F.max("x").alias("mx0"))
    # a single-valued column gets the range [v - 0.5, v + 0.5], as numpy's bin edges do
    stats = raw_stats.select(
        F.when(F.col("mn0") == F.col("mx0"), F.col("mn0") - 0.5).otherwise(F.col("mn0")).alias("mn"),
        F.when(F.col("mn0") == F.col("mx0"), F.col("mx0") + 0.5).otherwise(F.col("mx0")).alias("mx"))
    step = (F.col("mx") - F.col("mn")) / F.lit(float(bins))

    def edge(i):
        return F.when(i >= bins, F.col("mx")).otherwise(i.cast("double") * step + F.col("mn"))

    raw = F.floor((F.col("x") - F.col("mn")) / step).cast("int")
    raw = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))
    with_raw = attach_scalars(vals, stats).withColumn("b0", raw)
    b = F.col("b0")
    fixed = (F.when((b > 0) & (F.col("x") < edge(b)), b - 1)
             .when((b < bins - 1) & (F.col("x") >= edge(b + 1)), b + 1)
             .otherwise(b))
    counts = with_raw.select(fixed.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    grid = attach_scalars(spark.range(bins).select(F.col("id").cast("int").alias("bin")), stats)
    grid = grid.select("bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"))
    if limits is not None:
        grid = grid.where((F.col("hi") >= limits[0]) & (F.col("lo") <= limits[1]))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency table, most frequent first; nulls dropped."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("value")))


def repeated_values(df: DataFrame, col: str, limit: int | None = None) -> DataFrame:
    """Values occurring more than once; with ``limit`` only the top ones."""
    out = value_counts(df, col).where(F.col("count") > 1)
    return out.limit(limit) if limit else out


def _dup_count(chunk):
    # rows - distinct, where NULL (an empty list exploded) counts as one more distinct value
    return (F.count(F.lit(1)) - F.countDistinct(*_hashes(chunk))
            - F.max(F.when(chunk.isNull(), 1).otherwise(0)))


def duplicates_by_title(articles: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """For every repeated title: duplicated chunks among its articles' chunks.

    Left-semi join to the repeated titles, explode, one grouped distinct count:
    one shuffle instead of a loop per title.
    """
    rep = repeated_values(articles, title).select(F.col("value").alias(title))
    chunks = (articles.join(rep, title, "left_semi")
              .select(title, F.explode_outer(content).alias("chunk")))
    return chunks.groupBy(title).agg(_dup_count(F.col("chunk")).alias("duplicated_count"))


def duplicate_totals(articles: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """Total duplicated chunks, those inside repeated titles, the rest, and % of all chunks."""
    chunks = articles.select(F.explode_outer(content).alias("chunk"))
    total = chunks.agg(_dup_count(F.col("chunk")).alias("total_dup"), F.count(F.lit(1)).alias("n_chunks"))
    in_titles = duplicates_by_title(articles, title, content).agg(
        F.coalesce(F.sum("duplicated_count"), F.lit(0)).cast("long").alias("title_dup"))
    both = attach_scalars(total, in_titles)
    return both.select(
        F.col("total_dup").cast("long").alias("total_duplicated"),
        F.col("title_dup").alias("from_repeated_titles"),
        (F.col("total_dup") - F.col("title_dup")).cast("long").alias("from_other_titles"),
        F.round(F.lit(100.0) * F.col("total_dup") / F.col("n_chunks"), 6).alias("duplicated_pct"),
    )


def language_anomalies(df: DataFrame, language: str = "language", langs=("ru", "de")) -> DataFrame:
    """Rows whose detected language is one of ``langs``."""
    return df.where(F.col(language).isin(list(langs)))


def anomaly_chunk_rows(anomalies: DataFrame, profile, key: str = "row_id", content: str = "content", keep: str = "en") -> DataFrame:
    """(key, chunk_no, chunk, chunk_language): every chunk of anomalous articles whose own language is not ``keep``."""
    lang = _chunk_languages(anomalies, profile, key, content)
    return lang.where(F.col("chunk_language").isNull() | (F.col("chunk_language") != keep)).select(key, "chunk_no", "chunk", "chunk_language")


def _chunk_languages(anomalies: DataFrame, profile, key: str, content: str) -> DataFrame:
    from tessera.operators.language import with_language

    chunks = anomalies.select(key, F.posexplode(content).alias("chunk_no", "chunk"))
    return with_language(chunks, [key, "chunk_no"], "chunk", profile, out="chunk_language")


def anomaly_chunks(anomalies: DataFrame, profile, key: str = "row_id", content: str = "content",
                   keep: str = "en") -> DataFrame:
    """Inside anomalous articles: chunks whose own language is not ``keep``, with the share.

    Returns one row: exploded chunks, anomalous chunks, and the percentage; ``anomaly_chunk_rows`` lists them.
    """
    flagged = _chunk_languages(anomalies, profile, key, content).select(
        F.when(F.col("chunk_language").isNull() | (F.col("chunk_language") != keep), 1).otherwise(0).alias("bad"))
    return flagged.agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("bad").cast("long").alias("n_anomalous"),
                       F.round(F.lit(100.0) * F.sum("bad") / F.count(F.lit(1)), 6).alias("anomalous_pct"))
