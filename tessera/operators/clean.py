"""Corpus cleaning.

``clean_corpus`` follows the reference's step order: detect -> parse -> keep
English -> strip tags -> strip special characters -> keep-first dedup ->
regroup -> concatenate -> content id. Detection and cleaning are projections;
the cleaned rows are written once, the keep-first dedup is a hash aggregate on
(content hash, row number) longs joined back by row number, and the regroup by
article id is the second shuffle of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.plan import spread, write_through
from tessera.functions.text import concat_content, content_id, content_key, strip_special, strip_tags, to_list_literal
from tessera.operators.language import LanguageProfile, detector_column, with_language
from tessera.schemas import ARTICLE_COLUMNS, require_columns


def filter_language(df: DataFrame, key: str, text: str, profile: LanguageProfile, keep: str = "en",
                    out: str = "language", detector=None) -> DataFrame:
    """Rows whose detected language is ``keep``, with the language column.

    Rows that the first pass does not find to be ``keep`` are detected again, as the pipeline's second pass over
    the parsed list does. The native detector reads letters only and gives the same answer twice, so it runs once;
    a user ``detector`` that changes its mind gets its second chance.
    """
    first = with_language(df, key, text, profile, out=out, detector=detector)
    return second_pass(first, F.col(text), keep, out, detector).where(F.col(out) == keep)


def second_pass(df: DataFrame, text, keep: str, out: str, detector) -> DataFrame:
    """Detect rows again whose language is not ``keep`` (user detectors only)."""
    if detector is None:
        return df
    again = detector_column(detector, F.when(~F.col(out).eqNullSafe(F.lit(keep)), text))
    return df.withColumn("__again", again).withColumn(
        out, F.when(F.col(out).eqNullSafe(F.lit(keep)), F.col(out)).otherwise(F.col("__again"))).drop("__again")


def clean_text(content_list) -> F.Column:
    """Tags then special characters removed from the space-joined chunk list (C3 + C4)."""
    return strip_special(strip_tags(concat_content(content_list, " ")))


def _content_hash(col):
    """Two independent 64-bit hashes: equal texts by content, as fixed-width keys of a hash aggregate."""
    return F.xxhash64(col).alias("__h1"), F.xxhash64(F.lit(1), col).alias("__h2")


def dedup_keep_first(df: DataFrame, col: str, order: str) -> DataFrame:
    """Drop rows whose ``col`` repeats, keeping the first in ``order``.

    Only (hash, order, row number) is aggregated; the rows follow by a semi-join. NULL contents are one group, a NULL
    order comes last, and rows that tie are settled by the row number.
    """
    rows = write_through(df.withColumn("__row", F.monotonically_increasing_id()), "keep-first")
    narrow = rows.select(*_content_hash(F.col(col)), F.col(order).alias("__o"), "__row")
    keys = ["__h1", "__h2"]
    first = narrow.groupBy(*keys).agg(F.min("__o").alias("__first"))
    winners = (narrow.join(first, keys).where(F.col("__o").eqNullSafe(F.col("__first")))
               .groupBy(*keys).agg(F.min("__row").alias("__row")))
    return rows.join(winners.select("__row"), "__row", "left_semi").drop("__row")


def dedup_chunks(articles: DataFrame, key: str = "row_id", content: str = "content") -> DataFrame:
    """Chunk-level keep-first dedup across the corpus, order (row, position).

    Output: (key, chunk_no, chunk) for the first occurrence of every distinct chunk. NULL keys come last.
    """
    chunks = articles.select(key, F.posexplode(content).alias("chunk_no", "chunk"))
    rows = write_through(chunks.withColumn("__row", F.monotonically_increasing_id()), "chunks")
    keys = ["__h1", "__h2"]
    # a chunk repeated inside one article collapses first, then one article per content
    places = rows.groupBy(*_content_hash(F.col("chunk")), key).agg(F.min("chunk_no").alias("chunk_no"))
    first = places.groupBy(*keys).agg(F.min(key).alias("__first"))
    best = places.join(first, keys).where(F.col(key).eqNullSafe(F.col("__first"))).select(*keys, "__first", "chunk_no")
    at = rows.select(*_content_hash(F.col("chunk")), F.col(key).alias("__k"), F.col("chunk_no").alias("__n"), "__row")
    same = [at[k] == best[k] for k in keys] + [at["__k"].eqNullSafe(best["__first"]), at["__n"] == best["chunk_no"]]
    winners = at.join(best, same, "left_semi").groupBy(*keys).agg(F.min("__row").alias("__row"))
    return rows.join(winners.select("__row"), "__row", "left_semi").select(key, "chunk_no", "chunk")


def regroup_articles(chunks: DataFrame, key: str = "row_id", pos: str = "chunk_no", chunk: str = "chunk",
                     first_of: tuple[str, ...] = ()) -> DataFrame:
    """Group chunk rows back per article in position order; first non-null of ``first_of``.

    NULL keys are dropped and the output is sorted by key, as a pandas groupby does.
    """
    aggs = [F.transform(F.array_sort(F.collect_list(F.struct(pos, chunk))), lambda s: s[chunk]).alias("content")]
    for c in first_of:
        aggs.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(pos))).alias(c))
    return chunks.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def id_collisions(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows, distinct ids, and repeated ids."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(id_col).alias("n_ids"),
                  (F.count(F.lit(1)) - F.countDistinct(id_col)).alias("duplicate_ids"))


def clean_corpus(articles: DataFrame, profile: LanguageProfile, keep_language: str = "en",
                 key: str = "row_id", observe: bool = False, detector=None):
    """CLEAN_ARTICLE rows: row_id, content, language, title, date, author, domain, url, id.

    ``articles`` has ``content`` as array<string>. With ``observe=True`` returns
    ``(df, observations)`` whose metrics (rows in, English rows, kept rows) fill
    once an action has run on ``df``; no extra job is started for them.

    Rows with a NULL id are dropped; rows that share an id are merged. With a user ``detector`` rows that it does
    not call ``keep_language`` are shown to it a second time.
    """
    require_columns(articles, ARTICLE_COLUMNS)
    meta = ["title", "date", "author", "domain", "url"]
    base = spread(articles.select(key, F.col("content").alias("chunks"), *meta), key)
    as_text = F.array_join("chunks", "\n") if detector is None else to_list_literal("chunks")
    obs = {}
    if observe:
        obs["input"] = Observation("input")
        base = base.observe(obs["input"], F.count(F.lit(1)).alias("rows"))

    tagged = second_pass(with_language(base, key, as_text, profile, detector=detector), as_text, keep_language, "language", detector)
    english = tagged.where(F.col("language") == keep_language).select(
        key, clean_text(F.col("chunks")).alias("content"), "language", *meta)
    if observe:
        obs["language"] = Observation("language")
        english = english.observe(obs["language"], F.count(F.lit(1)).alias("rows"))
    # keep-first dedup on narrow rows: (content hash, order) longs; rows with a NULL id go, as the regroup drops them
    rows = write_through(english.where(F.col(key).isNotNull()).withColumn("__row", F.monotonically_increasing_id()), "cleaned")
    first = rows.groupBy(F.xxhash64("content").alias("h1"), F.xxhash64(F.lit(1), "content").alias("h2")).agg(F.min(key).alias(key))
    rows = rows.withColumn("h1", F.xxhash64("content")).withColumn("h2", F.xxhash64(F.lit(1), "content"))
    winners = rows.join(first, ["h1", "h2", key], "left_semi").groupBy("h1", "h2").agg(F.min("__row").alias("__row"))
    kept = rows.drop("h1", "h2").join(winners.select("__row"), "__row", "left_semi")
    if observe:
        obs["dedup"] = Observation("dedup")
        kept = kept.observe(obs["dedup"], F.count(F.lit(1)).alias("rows"))
    # rows that share an id become one article: contents joined in row order, first non-NULL of the rest
    grouped = regroup_articles(kept, key=key, pos="__row", chunk="content", first_of=("language", *meta))
    out = grouped.withColumn("content", concat_content("content", " ")).select(key, "content", "language", *meta) \
        .withColumn("id", content_id("content")) \
        .withColumn("doc_key", content_key("content"))
    return (out, obs) if observe else out
