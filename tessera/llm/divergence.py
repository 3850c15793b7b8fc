"""Divergence of the sources of a language in their use of words (operator 12).

Each document becomes an exact sparse count vector of its terms; vectors are summed per (language, source) inside the
tasks and then by Spark, with the number of documents a term occurs in. A language keeps the terms of at least
``min_docs`` documents, however many they are. Every share is an integer of a thousand millionth, add-one smoothed over
the kept terms, and every sum is exact.

Pairs of sources are evaluated on the sparse vectors. With p0 and q0 the shares of a term that a source lacks, the sum
over all V kept terms is V f(p0, q0), plus for each source's own terms what they differ from that (from a histogram of
its shares), plus a correction for the terms that both have. Only the last needs the terms to meet: per block of terms,
the rows of a term are paired in bounded steps and summed per pair of sources.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import batch as bt
from tessera.llm.store import BROADCAST_ROWS, small, stored
from tessera.llm.words import SLICE, Words, runs

#: Smoothed shares are counted in units of 1 / SCALE.
SCALE = 1_000_000_000
#: Rows of a block of terms on average, and pairs of rows worked on at a time.
BLOCK_ROWS, STEP = 400_000, 1 << 20

#: Bytes between terms: ASCII but the letters.
_BETWEEN = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_EXACT = "decimal(38,0)"


def _grouped(words: Words, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, occurrences, documents) of each term of each group.

    Terms are brought together by key and compared byte by byte; the keys of unequal terms are set apart.
    """
    if not len(words.key):
        return words.s, words.s, words.s
    while True:
        order = np.argsort(bt.mix(words.key + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
        at, first = runs(order, words.key, group)
        odd = words.unlike(first)
        if not len(odd):
            break
        for i in odd:
            name = words.low[words.s[i]:words.e[i]].tobytes()
            words.key[i] = int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little")
    text = words.text[order]
    of_doc = np.ones(len(order), dtype=np.int64)
    of_doc[1:] = text[1:] != text[:-1]
    of_doc[at] = 1
    return order[at], np.diff(np.concatenate([at, [len(order)]])), np.add.reduceat(of_doc, at)


def _count_terms(batches):
    for b in batches:
        langs, sources = b.column(0).dictionary_encode(), b.column(1).dictionary_encode()
        lang, source = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (langs, sources))
        data, off = bt.as_bytes(b.column(2))
        for lo, hi in bt.slices(off, SLICE):
            w = Words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], _BETWEEN, np.zeros(hi - lo, dtype=np.uint64))
            pair = lang[lo:hi] * len(sources.dictionary) + source[lo:hi]
            at, n, docs = _grouped(w, pair[w.text])
            if len(at):
                doc = w.text[at] + lo
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(lang[doc])), sources.dictionary.take(pa.array(source[doc])), w.texts(at),
                     pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): the summed count vectors of each group and its documents with the term."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    rows = texts.mapInArrow(lambda batches: bt.tidy(_count_terms(batches)), "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact."""
    return 1 + F.expr(f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(18,0)) div CAST({total} + {terms} AS DECIMAL(19,0))")


def _apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so the square is a long."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _corrections(rows: pa.Table) -> pa.Table:
    """What the terms that two sources share add to the pair's sum, for one block of terms.

    high * 2^30 + low is the sum; both stay far below 2^53 in each step, so doubles add them exactly.
    """
    terms = rows.column("term").combine_chunks().dictionary_encode()
    sources = rows.column("source").combine_chunks().dictionary_encode()
    order = np.argsort(terms.indices.to_numpy(zero_copy_only=False), kind="stable")
    term = terms.indices.to_numpy(zero_copy_only=False)[order]
    src = sources.indices.to_numpy(zero_copy_only=False)[order].astype(np.int64)
    p, p0 = (rows.column(c).to_numpy()[order] for c in ("p", "p0"))
    start = np.searchsorted(term, term, side="left")
    size = np.searchsorted(term, term, side="right") - start
    ahead = np.concatenate([[0], np.cumsum(size)])
    count = len(sources.dictionary)
    out = []
    lo = 0
    while lo < len(term):
        hi = max(lo + 1, int(np.searchsorted(ahead, ahead[lo] + STEP, side="right")) - 1)
        a = np.repeat(np.arange(lo, hi), size[lo:hi])
        b = np.arange(len(a)) - np.repeat(ahead[lo:hi] - ahead[lo], size[lo:hi]) + np.repeat(start[lo:hi], size[lo:hi])
        a, b = a[src[a] != src[b]], b[src[a] != src[b]]
        x = _f(p[a], p[b]) - _f(p[a], p0[b]) - _f(p0[a], p[b]) + _f(p0[a], p0[b])
        pair, which = np.unique(src[a] * count + src[b], return_inverse=True)
        out.append((pair, *(np.bincount(which, weights=v, minlength=len(pair)).astype(np.int64) for v in (x >> 30, x & ((1 << 30) - 1)))))
        lo = hi
    pair, high, low = (np.concatenate(c) for c in zip(*out))
    lang = rows.column("lang")[0].as_py()
    return pa.Table.from_arrays([pa.array([lang] * len(pair), pa.string()), sources.dictionary.take(pa.array(pair // count)),
                                 sources.dictionary.take(pa.array(pair % count)), pa.array(high), pa.array(low)],
                                ["lang", "a", "b", "high", "low"])


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3,
                      top: int = 200, block_rows: int = BLOCK_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source's use of words is from others of its language.

    p and q are smoothed shares of a term, f = floor((p - q)^2 / q). Part ``pair`` has one row for every other source of
    the language, its value f summed over the language's kept terms; part ``term`` has the ``top`` terms that the source
    has and uses more than its language does. Ranks go by value, then by the item's bytes. Null texts, languages and
    sources are empty strings; a group without terms has its pair rows; a language that keeps no term has pairs of value
    0; repeated rows are documents of their own; an empty table gives no rows; other columns are ignored.
    """
    counts, _ = stored(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    kept, _ = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("c"), F.sum("docs").alias("docs"))
                     .where(F.col("docs") >= min_docs).drop("docs"), "divergence-kept")
    rows, _ = stored(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-vectors")
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))))
    by_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("lang_n"))
    groups = (names.distinct().join(by_lang, "lang", "left").join(rows.groupBy("lang", "source").agg(F.sum("n").alias("total")),
                                                                  ["lang", "source"], "left").na.fill(0, ["v", "lang_n", "total"]))
    groups, _ = stored(groups.withColumn("p0", F.when(F.col("v") > 0, _share("0", "total", "v")).otherwise(1)), "divergence-groups")
    each = small(groups, broadcast_rows)
    vectors, _ = stored(rows.join(each, ["lang", "source"])
                        .select("lang", "source", "term", _share("n", "total", "v").alias("p"), _share("c", "lang_n", "v").alias("q"), "p0"),
                        "divergence-shares")

    def ranked(df, part):
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"),
                         F.row_number().over(order).alias("rank"))

    terms = ranked(vectors.where("p > q").select("lang", "source", F.col("term").alias("item"), _apart("p", "q").alias("value")), "term")
    return terms.where(F.col("rank") <= top).unionByName(ranked(_pair_sums(vectors, groups, block_rows, broadcast_rows), "pair"))


def _pair_sums(vectors: DataFrame, groups: DataFrame, block_rows: int, broadcast_rows: int) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of sources of a language."""
    mine = groups.select("lang", F.col("source").alias("a"), "v", F.col("p0").alias("a0"))
    others = small(groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0")), broadcast_rows)
    base = mine.join(others, "lang").where("a <> b").select(
        "lang", "a", "b", (F.col("v").cast(_EXACT) * _apart("a0", "b0")).cast(_EXACT).alias("value"))
    shares, _ = stored(vectors.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n")), "divergence-shares-of-groups")
    met = shares.join(others, "lang").where("source <> b")
    n = F.col("n").cast(_EXACT)
    as_p = met.select("lang", F.col("source").alias("a"), "b", (n * (_apart("p", "b0") - _apart("p0", "b0"))).cast(_EXACT).alias("value"))
    as_q = met.select("lang", F.col("b").alias("a"), F.col("source").alias("b"),
                      (n * (_apart("b0", "p") - _apart("b0", "p0"))).cast(_EXACT).alias("value"))
    blocks = max(1, -(-vectors.count() // block_rows))
    both = (vectors.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "source", "term", "p", "p0")
            .groupBy("lang", "block").applyInArrow(_corrections, "lang string, a string, b string, high bigint, low bigint")
            .groupBy("lang", "a", "b").agg(F.sum(F.col("high").cast(_EXACT)).alias("high"), F.sum(F.col("low").cast(_EXACT)).alias("low"))
            .select("lang", "a", "b", (F.col("high") * F.lit(1 << 30) + F.col("low")).cast(_EXACT).alias("value")))
    every = base.unionByName(as_p).unionByName(as_q).unionByName(both)
    return every.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
