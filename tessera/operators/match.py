"""Ground-truth mapping (D1-D7): fuzzy best match of each passage against the whole corpus.

Plan for ``best_match``: articles stay where they are, and no (passage, article) row is shuffled or written.

1. The passages' sorted distinct tokens are broadcast (size proved by an aggregate first; a larger passage
   table is cut into blocks of ``PASSAGE_BYTES`` that are matched one after another).
2. First pass (``mapInArrow`` over article partitions): an inverted index from token to passages gives, for a slice
   of articles, the shared token counts and lengths with all passages at once; two of the three ratio terms are
   closed forms of them. Tokens stay in Arrow columns, and a slice has at most ``SLICE_HITS`` shared tokens, so a
   worker's memory does not follow the number of articles. Each partition returns only its best closed score and first order per passage.
3. These reduce to one threshold per passage, which is broadcast with the passages. ``exact=False`` ends here.
4. Second pass: the third term is bounded by ``2(s+1+min(a,b))/(2s+2+a+b)`` (without shared tokens by
   ``2min(a,b)/(a+b)`` and a character count); only pairs whose bound can still win get the exact LCS, and a
   partition returns its best pair per passage.

Ties go to the article that comes first in ``order``. NULL passages and articles count as empty texts;
passages without a positive score get (0, NULL).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import fuzzy
from tessera.functions.plan import spread, write_through
from tessera.functions.text import byte_table, fuzz_normalize, parse_list_literal, token_set, translated, unless_ascii
from tessera.session import ship_package

#: Most bytes of passage tokens in one broadcast block.
PASSAGE_BYTES = 32 << 20
#: Most tokens that a slice of articles can share with the passages, and most articles in it.
SLICE_HITS, SLICE_ARTICLES = 1 << 20, 1024
#: Bytes of normalised articles that are split into tokens at a time, at most about.
SPLIT_BYTES = 1 << 19
_NORMAL = byte_table("_")


def drop_duplicate_rows(df: DataFrame, required=()) -> DataFrame:
    """Drop rows with NULL in ``required``, then whole-row duplicates."""
    if required:
        df = df.dropna(subset=list(required))
    return df.dropDuplicates()


def unwrap_singleton(df: DataFrame, col: str) -> DataFrame:
    """If every value parses as a list literal, replace it by its only element.

    A list with more than one element fails the query; if any value is not a list the column is kept.
    """
    parsed = parse_list_literal(col)
    flags = df.agg(F.coalesce(F.bool_and(parsed.isNotNull()), F.lit(False)).alias("__all_lists"))
    out = df.crossJoin(F.broadcast(flags))
    value = F.when(F.size(parsed) > 1, F.raise_error(F.lit("unwrap_singleton: a list holds more than one element")))\
        .otherwise(F.try_element_at(parsed, F.lit(1)))
    return out.withColumn(col, F.when(F.col("__all_lists"), value).otherwise(F.col(col))).drop("__all_lists")


@F.pandas_udf(T.IntegerType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Exact token-set ratio of two text columns (D3); row-wise on Arrow batches."""
    return pd.Series([fuzzy.token_set_ratio(x, y) for x, y in zip(a, b)], dtype="int32")


def _joined(n, total):
    """Length of n tokens of ``total`` characters joined by spaces."""
    return np.where(n > 0, total + n - 1, 0)


def _ratios(num, den):
    """round_half_even(100 * num / den) with the reference's float evaluation order."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(den > 0, np.rint(100.0 * (num / den)), 0).astype(np.int64)


class Passages:
    """One block of passages with an inverted index from token to passages."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.pid = np.array([p for p, _ in rows], dtype=np.int64)
        self.tokens = [list(t or []) for _, t in rows]
        self.n = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.length = np.array([sum(map(len, t)) for t in self.tokens], dtype=np.int64)
        index: dict[str, list[int]] = {}
        for i, t in enumerate(self.tokens):
            for w in t:
                index.setdefault(w, []).append(i)
        # passages of the j-th word: flat[start[j]:start[j + 1]]
        self.words = pa.array(list(index), type=pa.string())
        self.start = np.cumsum([0, *map(len, index.values())])
        self.flat = np.array([i for v in index.values() for i in v], dtype=np.int64)

    def slices(self, batches):
        """(article orders, token lists) of slices that share at most ``SLICE_HITS`` tokens with the passages."""
        step = max(1, min(SLICE_ARTICLES, SLICE_HITS // max(1, len(self.flat))))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                yield pc.fill_null(part.column("did"), np.iinfo(np.int64).max).to_numpy(), part.column("dtoks")

    def shared(self, lists: pa.Array):
        """(s, a, b, closed score) of each article's distinct tokens with every passage: (articles, passages) arrays."""
        shape = len(lists), len(self.pid)
        tokens = lists.flatten()
        n_of = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        row, size = np.repeat(np.arange(len(lists)), n_of), pc.utf8_length(tokens).to_numpy().astype(np.int64)
        nd, ld = n_of.astype(np.int64)[:, None], np.bincount(row, weights=size, minlength=len(lists)).astype(np.int64)[:, None]
        word = pc.fill_null(pc.index_in(tokens, value_set=self.words), -1).to_numpy()
        known = word >= 0
        row, size, word = row[known], size[known], word[known]
        many = self.start[word + 1] - self.start[word]
        at = np.repeat(self.start[word] - np.cumsum(many) + many, many) + np.arange(many.sum())
        cell = np.repeat(row, many) * shape[1] + self.flat[at]
        ns = np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape)
        ls = np.bincount(cell, weights=np.repeat(size, many), minlength=shape[0] * shape[1]).astype(np.int64).reshape(shape)
        s, a, b = _joined(ns, ls), _joined(self.n - ns, self.length - ls), _joined(nd - ns, ld - ls)
        r1 = np.where(a == 0, 100, _ratios(2 * s, 2 * s + 1 + a))
        r2 = np.where(b == 0, 100, _ratios(2 * s, 2 * s + 1 + b))
        return s, a, b, np.where(ns > 0, np.maximum(r1, r2), 0)


def _tokenised(batches):
    """(did, dtoks) batches from (did, normalised or ASCII text) ones: each text's distinct tokens, those of ``token_set``."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // SPLIT_BYTES)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            part = batch.slice(lo, hi - lo)
            lists = pc.split_pattern(translated(part.column("text"), _NORMAL), " ")
            words = lists.flatten().dictionary_encode()
            n, code = max(1, len(words.dictionary)), words.indices.to_numpy()
            real = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[code]
            row = np.repeat(np.arange(hi - lo), pc.list_value_length(lists).to_numpy())
            pairs = np.sort(row[real] * n + code[real])
            pairs = pairs[np.diff(pairs, prepend=-1) > 0]
            upto = np.cumsum([0, *np.bincount(pairs // n, minlength=hi - lo)], dtype=np.int32)
            tokens = words.dictionary.take(pa.array(pairs % n))
            yield pa.RecordBatch.from_arrays([part.column("did"), pa.ListArray.from_arrays(pa.array(upto), tokens)], names=["did", "dtoks"])


def _better(score, did, best, first):
    """Where (score, did) beats (best, first): a higher score, or the same from an earlier article."""
    return (score > best) | ((score == best) & (score > 0) & (did < first))


def _emit(passages: Passages, best, first) -> pa.RecordBatch:
    at = np.flatnonzero(best > 0)
    return pa.RecordBatch.from_arrays([pa.array(passages.pid[at]), pa.array(best[at].astype("int32")), pa.array(first[at])],
                                      names=["pid", "score", "did"])


def _closed_pass(batches, shared):
    passages, _, _ = shared.value
    best, first = np.zeros(len(passages.pid), dtype=np.int64), np.full(len(passages.pid), np.iinfo(np.int64).max)
    for did, lists in passages.slices(batches):
        scores = passages.shared(lists)[3]
        score = scores.max(axis=0)
        did = np.where(scores == score, did[:, None], np.iinfo(np.int64).max).min(axis=0)
        win = _better(score, did, best, first)
        best[win], first[win] = score[win], did[win]
    yield _emit(passages, best, first)


def _exact_pass(batches, shared):
    passages, best, first = shared.value
    best, first = best.copy(), first.copy()  # thresholds rise with what this partition finds
    for dids, lists in passages.slices(batches):
        s, a, b, _ = passages.shared(lists)
        low = np.minimum(a, b)
        bound = np.where(s > 0, _ratios(2 * (s + 1 + low), 2 * s + 2 + a + b), _ratios(2 * low, a + b))
        able = (a > 0) & (b > 0) & _better(bound, dids[:, None], best, first)
        for j in np.flatnonzero(able.any(axis=1)):
            did, tokens = int(dids[j]), sorted(lists[int(j)].as_py() or [])
            own = set(tokens)
            for i in np.flatnonzero(able[j] & _better(bound[j], did, best, first)):
                mine = set(passages.tokens[i])
                left = " ".join(w for w in passages.tokens[i] if w not in own)
                right = " ".join(w for w in tokens if w not in mine)
                sh, rest = s[j, i], a[j, i] + b[j, i]
                base, total = (sh + 1, 2 * sh + 2 + rest) if sh > 0 else (0, rest)
                # the character bound is cheap and prunes well only without shared tokens
                if sh == 0 and not _better(fuzzy.ratio_from(fuzzy.char_bound(left, right), total), did, best[i], first[i]):
                    continue
                score = fuzzy.ratio_from(base + fuzzy.lcs_len(left, right), total)
                if _better(score, did, best[i], first[i]):
                    best[i], first[i] = score, did
    yield _emit(passages, best, first)


def _reduce(found: DataFrame) -> DataFrame:
    """Per passage the highest score, first article on ties (one long per row: a hash aggregate)."""
    return (found.groupBy("pid").agg(F.max(F.struct("score", (-F.col("did")).alias("neg"))).alias("w"))
            .select("pid", F.col("w.score").alias("score"), (-F.col("w.neg")).alias("did")))


def best_match(passages: DataFrame, articles: DataFrame, pid: str = "example_id", ptext: str = "relevant_chunk",
               order: str = "row_id", content: str = "content", id_col: str = "id",
               exact: bool = True, keys: tuple[str, ...] = ()) -> DataFrame:
    """(pid, best_match_score int, best_match_id long, ``keys``...) for every passage.

    Passage ids may be of any type, null or repeated: passages are numbered inside and each has its row in the result.
    ``order`` is the source order used for ties (first wins) and identifies the article; ``id_col`` is the
    returned id, ``keys`` further article columns to return. ``exact=False`` keeps only the closed-form terms, a
    lower bound of the exact score.
    """
    spark = passages.sparkSession
    ship_package(spark)
    asked = write_through(passages.select(F.col(pid).alias("key"), F.col(ptext).alias("text"))
                          .withColumn("pid", F.monotonically_increasing_id()), "passages")
    p = asked.select("pid", token_set(fuzz_normalize(F.coalesce("text", F.lit("")))).alias("toks"))
    text = F.coalesce(F.col("__c"), F.lit(""))
    d = spread(articles.select(F.col(order).cast("long").alias("did"), F.col(content).alias("__c")), "did").select(
        "did", unless_ascii(text, fuzz_normalize(text)).alias("text"))
    size = F.aggregate("toks", F.lit(0).cast("long"), lambda acc, t: acc + F.octet_length(t) + 64)
    n_bytes = p.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-n_bytes // PASSAGE_BYTES))
    best = None
    for i in range(blocks):
        part = p if blocks == 1 else p.where(F.pmod(F.xxhash64("pid"), F.lit(blocks)) == i)
        held = Passages([(r.pid, r.toks) for r in part.orderBy("pid").collect()])  # at most PASSAGE_BYTES
        none = np.zeros(len(held.pid), dtype=np.int64), np.full(len(held.pid), np.iinfo(np.int64).max)
        shared = spark.sparkContext.broadcast((held, *none))
        found = _reduce(d.mapInArrow(lambda it, s=shared: _closed_pass(_tokenised(it), s), "pid long, score int, did long"))
        if exact:
            closed = {r.pid: (r.score, r.did) for r in found.collect()}  # one row per passage of the block
            at = [closed.get(x, (0, none[1][0])) for x in held.pid.tolist()]
            low = np.array([x[0] for x in at], dtype=np.int64), np.array([x[1] for x in at], dtype=np.int64)
            shared2 = spark.sparkContext.broadcast((held, *low))
            found = _reduce(d.mapInArrow(lambda it, s=shared2: _exact_pass(_tokenised(it), s), "pid long, score int, did long"))
        best = found if best is None else best.unionByName(found)
    ids = articles.select(F.col(order).alias("did"), F.col(id_col).cast("long").alias("best_match_id"), *keys)
    res = asked.select("pid", "key").join(best, "pid", "left").join(ids, "did", "left")
    return res.select(F.col("key").alias(pid),
                      F.coalesce(F.col("score"), F.lit(0)).cast("int").alias("best_match_score"),
                      "best_match_id", *keys)


def to_ground_truth(df: DataFrame) -> DataFrame:
    """Rename ``answer`` (preferred) or ``relevant_chunk`` to ``ground_truth``."""
    if "answer" in df.columns:
        return df.withColumnRenamed("answer", "ground_truth")
    if "relevant_chunk" in df.columns:
        return df.withColumnRenamed("relevant_chunk", "ground_truth")
    return df


def map_eval_set(articles: DataFrame, eval_df: DataFrame, exact: bool = True) -> DataFrame:
    """EVAL_MAPPED: distinct rows, unwrapped passages, best match, renamed ground truth."""
    df = unwrap_singleton(drop_duplicate_rows(eval_df), "relevant_chunk")
    keys = ("doc_key",) if "doc_key" in articles.columns else ()
    best = best_match(df, articles, pid="example_id", ptext="relevant_chunk", exact=exact, keys=keys)
    for k in keys:
        best = best.withColumnRenamed(k, f"best_match_{k.removeprefix('doc_')}")
    return to_ground_truth(df.join(best, "example_id", "left"))


def highlight_matches(eval_df: DataFrame, articles: DataFrame, min_words: int = 2,
                      text: str = "ground_truth", id_col: str = "id", content: str = "content") -> DataFrame:
    """Best-match article text with runs of >= ``min_words`` passage words wrapped in <mark>.

    The pattern is a column (one per passage): its words, quoted, as an
    alternation; a run is ``word (\\s+ word){min_words-1,}``, case-insensitive. With a full content key on
    both sides (``best_match_key``, ``doc_key``) the article is found by it, never by the short id.
    """
    by_key = "best_match_key" in eval_df.columns and "doc_key" in articles.columns
    words = F.filter(F.split(F.col(text), "(?U)[\\s\\x1c-\\x1f]+"), lambda w: w != "")
    quoted = F.transform(words, lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")),
                                                    F.lit("\\E")))
    alt = F.concat(F.lit("\\b(?:"), F.array_join(quoted, "|"), F.lit(")\\b"))
    pattern = F.concat(F.lit("(?iU)"), alt, F.lit("(?:\\s+"), alt, F.lit(f"){{{max(min_words - 1, 0)},}}"))
    on, source = ("best_match_key", "doc_key") if by_key else ("best_match_id", id_col)
    arts = articles.select(F.col(source).alias(on), F.col(content).alias("__content"))
    joined = eval_df.join(arts, on, "left")
    marked = F.when(F.col("__content").isNull(), F.lit("No match found")).when(
        F.size(words) == 0, F.col("__content")).otherwise(
        F.regexp_replace(F.col("__content"), pattern, F.lit("<mark>$0</mark>")))
    return joined.withColumn("highlighted", marked).drop("__content")
