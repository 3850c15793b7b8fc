"""Chunking (E1-E3).

``recursive_chunk`` implements the recursive character splitter as an Arrow
UDF returning ``array<string>`` (the per-text recursion has no relational
form); ``fixed_chunk`` is the native fixed-window alternative with an exact
SQL equivalent. Long texts are spread by repartitioning on the id first.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.plan import spread
from tessera.schemas import METADATA_COLUMNS, require_columns

# The splitter's separator list, tried in order (fixed values).
SEPARATORS = ["\n\n", "\n", " ", ""]


def _borders(text: str, lo: int, hi: int, sep: str) -> list[int]:
    """Piece borders of text[lo:hi]: a piece starts at ``lo`` and at every separator."""
    cuts, at = [lo], text.find(sep, lo, hi)
    while at >= 0:
        if at > cuts[-1]:
            cuts.append(at)
        at = text.find(sep, at + len(sep), hi)
    cuts.append(hi)
    return cuts


def _pack(text: str, cuts: list[int], size: int, overlap: int):
    """Chunks of consecutive pieces: as many as fit, the next chunk re-using at most ``overlap`` characters."""
    lo = 0
    for k in range(len(cuts) - 1):
        if cuts[k + 1] - cuts[lo] > size and k > lo:
            yield text[cuts[lo]:cuts[k]].strip()
            while cuts[k] - cuts[lo] > overlap or (cuts[k + 1] - cuts[lo] > size and lo < k):
                lo += 1
    yield text[cuts[lo]:cuts[-1]].strip()


def _windows(text: str, lo: int, hi: int, size: int, overlap: int):
    """Chunks where every character is a piece: plain windows."""
    while hi - lo > size:
        yield text[lo:lo + size].strip()
        lo += size - min(overlap, size - 1)
    yield text[lo:hi].strip()


def split_text(text: str, size: int, overlap: int = 0, separators=None) -> list[str]:
    """Recursive character split: pieces <= size (one piece may exceed it when no separator is left).

    Works on offsets of the one text: the first separator that a span holds cuts it, neighbouring pieces below
    ``size`` are packed together, a larger piece is cut by the separators after that one.
    """
    seps = SEPARATORS if separators is None else list(separators)
    out: list[str] = []

    def cut(lo: int, hi: int, level: int) -> None:
        found = next((i for i in range(level, len(seps)) if not seps[i] or text.find(seps[i], lo, hi) >= 0), None)
        if found is not None and not seps[found]:
            out.extend(text[lo:hi] if size == 1 else filter(None, _windows(text, lo, hi, size, overlap)))
            return
        cuts = [lo, hi] if found is None else _borders(text, lo, hi, seps[found])
        run = [cuts[0]]
        for x, y in zip(cuts, cuts[1:]):
            if y - x < size:
                run.append(y)
                continue
            if len(run) > 1:
                out.extend(filter(None, _pack(text, run, size, overlap)))
            if found is None or found + 1 == len(seps):
                out.append(text[x:y])
            else:
                cut(x, y, found + 1)
            run = [y]
        if len(run) > 1:
            out.extend(filter(None, _pack(text, run, size, overlap)))

    if text:
        cut(0, len(text), 0)
    return out


def recursive_chunk(col, size: int, overlap: int = 0) -> Column:
    """Column: array<string> of recursive chunks of the text."""
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _chunks(s: pd.Series) -> pd.Series:
        return pd.Series([split_text(t, size, overlap) if t is not None else [] for t in s])

    return _chunks(F.col(col) if isinstance(col, str) else col)


def _windows_of(c: Column, size: int) -> Column:
    """Windows of ``size`` chars without overlap in one pass; a window by substring() would count the characters before it again."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?s).{{1,{size}}}"), 0)


def fixed_chunk_col(col, size: int, overlap: int = 0) -> Column:
    """Column: array of (chunk_no, text) fixed windows of ``size`` chars stepping ``size - overlap``."""
    c = F.col(col) if isinstance(col, str) else col
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    if overlap == 0:
        return F.transform(_windows_of(c, size), lambda t, i: F.struct(i.alias("chunk_no"), t.alias("text")))
    n = F.length(c)
    last = F.greatest(n - overlap - 1, F.lit(0))
    starts = F.when(n > 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s, i: F.struct(i.alias("chunk_no"), F.substring(c, s + 1, size).alias("text")))


def _documents(df: DataFrame, pieces: Column, none_as: str | None) -> DataFrame:
    """Metadata + pieces; ``__key`` (source row id when present, else the content id) names the chunks,
    so chunk ids stay unique even when two articles share a 10^8 content id."""
    require_columns(df, METADATA_COLUMNS + ("content",))
    meta = [F.coalesce(F.col(c).cast("string"), F.lit(none_as)).alias(c) if none_as is not None
            else F.col(c) for c in ("url", "domain", "title", "author", "date")]
    key = F.col("row_id") if "row_id" in df.columns else F.col("id")
    return df.select(key.cast("string").alias("__key"), F.col("id").cast("long").alias("origin_doc_id"), *meta,
                     pieces.alias("__p"))


def create_documents(df: DataFrame, size: int, overlap: int = 0, none_as: str | None = "None",
                     key: str = "doc_key") -> DataFrame:
    """CHUNK rows: one per recursive chunk with the article's metadata.

    ``None`` metadata become the string 'None' (``none_as=''`` gives the MVP
    notebook's variant). The article key (full content hash when present)
    spreads long texts over partitions before the Python splitter runs.
    """
    src = spread(df, key if key in df.columns else None)
    base = _documents(src, recursive_chunk("content", size, overlap), none_as)
    rows = base.select("*", F.posexplode("__p").alias("chunk_no", "page_content")).drop("__p")
    return rows.select(F.concat(F.col("__key"), F.lit("-"), F.col("chunk_no").cast("string"))
                       .alias("chunk_id"), "origin_doc_id", "chunk_no", "page_content",
                       "url", "domain", "title", "author", "date")


def fixed_chunk(df: DataFrame, size: int, overlap: int = 0, none_as: str | None = "None") -> DataFrame:
    """CHUNK rows from native fixed windows."""
    plain = overlap == 0
    base = _documents(df, _windows_of(F.col("content"), size) if plain else fixed_chunk_col("content", size, overlap), none_as)
    # the outer form: for the inner one Spark adds a filter on the array's size, and that makes every window twice
    rows = base.select("*", F.posexplode_outer("__p").alias("chunk_no", "__w")).drop("__p").where(F.col("__w").isNotNull())
    return rows.select(F.concat(F.col("__key"), F.lit("-"), F.col("chunk_no").cast("string"))
                       .alias("chunk_id"), "origin_doc_id", "chunk_no",
                       (F.col("__w") if plain else F.col("__w.text")).alias("page_content"), "url", "domain", "title", "author", "date")


def chunk_report(chunks: DataFrame, articles: DataFrame) -> DataFrame:
    """Chunks, articles, and chunks as % of articles (E3); two counts, one row."""
    c = chunks.agg(F.count(F.lit(1)).alias("n_chunks"))
    a = articles.agg(F.count(F.lit(1)).alias("n_articles"))
    both = c.crossJoin(a)
    return both.select("n_chunks", "n_articles",
                       F.when(F.col("n_articles") > 0,
                              F.round(F.lit(100.0) * F.col("n_chunks") / F.col("n_articles"), 6)).alias("pct"))
