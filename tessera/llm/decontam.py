"""Benchmark decontamination by a BM25 index with block-max WAND (operator 1).

Benchmark items are cut into segments of at most ``SEGMENT`` words. Each (term, segment) posting has a BM25
weight divided by the segment's own total, so a passage that holds all terms of a segment scores 1. Every
training text is cut into blocks of ``SEGMENT`` words; two neighbouring blocks are one passage, so each
occurrence of a segment lies whole in some passage. A passage is a query of its distinct terms:

* WAND: with terms from frequent to rare, all terms before the pivot together give no segment more than half
  the threshold (``rest``); the posting lists of these frequent terms are not read to find candidates;
* block-max: postings stand in blocks of ``POSTING_BLOCK`` segments. The block maxima of the passage's terms from
  the pivot on plus the block's greatest ``rest`` bound every score there; other blocks are skipped;
* segments of the blocks that are left are scored exactly with all terms.

All steps work on whole slices of texts at once with numpy. Hits are verified: at least ``overlap`` of the
word ``GRAM``-grams of the item's question and of its answer must be in the text; an item of one sentence has no
answer of its own. Words are compared in lower case without punctuation and symbols; a character of a script that
is written without blanks is a word, so ``GRAM``-grams are character n-grams there. Items of fewer than ``MIN_WORDS``
words are common phrases rather than test items and are not searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import batch as bt

SEGMENT, GRAM, POSTING_BLOCK = 64, 3, 4
K1, B = 1.2, 0.75
#: Most bytes of item words in one index; a larger benchmark is scanned in several indexes, one after another.
INDEX_BYTES = 32 << 20
#: Least words of an item that is searched.
MIN_WORDS = 5
#: Punctuation, symbols and blanks beyond ASCII (the range stands first: it settles most characters).
OTHER_BREAKS = r"[[\x{80}-\x{10FFFF}]&&[\p{P}\p{S}\p{Z}]]+"
#: Blocks of the scripts written without blanks: Thai and Lao, Myanmar, Khmer, Kana, Han with its extensions.
UNSPACED = (r"[[\x{E00}-\x{10FFFF}]&&[\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}"
            r"\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]]")


def _lower(col: str | Column) -> Column:
    """Lower case; what breaks words beyond ASCII becomes blanks, unspaced characters stand alone. ASCII texts stay."""
    low = F.lower((F.col(col) if isinstance(col, str) else col).cast("string"))
    other = F.regexp_replace(F.regexp_replace(low, OTHER_BREAKS, " "), UNSPACED, " $0 ")
    return F.when(F.length(low) == F.octet_length(low), low).otherwise(other)


def _item_batches(batches: Iterator[pa.RecordBatch], has_answer: bool) -> Iterator[pa.RecordBatch]:
    """(item_id, question, answer) -> (item_id, q, a) as word hashes; without answers the last sentence is one."""
    def hashes(texts):
        h, off = bt.words(*bt.as_bytes(pa.array(texts, pa.large_string())), bt.NO_WORD)
        return [h[off[i]:off[i + 1]].view(np.int64) for i in range(len(texts))]

    for b in batches:
        q = [x or "" for x in b.column("question").to_pylist()]
        a = [x or "" for x in b.column("answer").to_pylist()]
        if not has_answer:
            parts = [[s for s in regex.split(r"(?<=[.!?])\s+|\n+", x) if regex.search(r"\w", s)] for x in q]
            a = [p[-1] if len(p) > 1 else "" for p in parts]
            q = [" ".join(p[:-1] if len(p) > 1 else p) for p in parts]
        yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(hashes(q), pa.list_(pa.int64())),
                                          pa.array(hashes(a), pa.list_(pa.int64()))], ["item_id", "q", "a"])


class Index:
    """Postings of one part of the benchmark as sorted arrays; broadcast to the tasks."""

    def __init__(self, items: list[tuple], id_type: pa.DataType, df: dict[int, int], n_items: int, mean_words: float, threshold: float):
        self.threshold = threshold
        self.ids = pa.array([i for i, _, _ in items], id_type)
        self.q = [np.array(q, dtype=np.int64).view(np.uint64) for _, q, _ in items]
        self.a = [np.array(a, dtype=np.int64).view(np.uint64) for _, _, a in items]
        seg_item, seg_terms = [], []
        for n, (q, a) in enumerate(zip(self.q, self.a)):
            w = np.concatenate([q, a])
            for s in range(0, len(w), SEGMENT):
                seg_item.append(n)
                seg_terms.append(w[s:s + SEGMENT])
        self.seg_item = np.array(seg_item, dtype=np.int64)
        vocab = np.unique(np.concatenate(seg_terms)) if seg_terms else np.zeros(0, np.uint64)
        seen = np.array([df.get(int(v), 1) for v in vocab.view(np.int64)], dtype=np.int64)
        order = np.argsort(-seen, kind="stable")  # term 0 is the most frequent
        self.vocab, self.term_of = vocab, np.empty(len(vocab), dtype=np.int64)
        self.term_of[order] = np.arange(len(vocab))
        idf = np.empty(len(vocab))
        idf[self.term_of] = np.log1p((n_items - seen + 0.5) / (seen + 0.5))
        term, seg, weight = [], [], []
        for s, w in enumerate(seg_terms):
            u, tf = np.unique(w, return_counts=True)
            t = self.term_of[np.searchsorted(vocab, u)]
            x = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / max(mean_words, 1.0)))
            term.append(t), seg.append(np.full(len(t), s)), weight.append(x / max(x.sum(), 1e-300))
        term, seg, weight = (np.concatenate(x) if x else np.zeros(0) for x in (term, seg, weight))
        self.segments, self.blocks = max(len(seg_terms), 1), -(-max(len(seg_terms), 1) // POSTING_BLOCK)
        key = term.astype(np.int64) * self.segments + seg.astype(np.int64)
        at = np.argsort(key)
        self.posting, self.weight = key[at], weight[at]
        block_key = term.astype(np.int64) * self.blocks + seg.astype(np.int64) // POSTING_BLOCK
        self.block_posting, inverse = np.unique(block_key, return_inverse=True)
        self.block_max = np.zeros(len(self.block_posting))
        np.maximum.at(self.block_max, inverse, weight)
        first = np.searchsorted(self.posting, np.arange(len(vocab) + 1) * self.segments)
        rest, self.pivot = np.zeros(self.segments), len(vocab)
        for t in range(len(vocab)):
            at = self.posting[first[t]:first[t + 1]] % self.segments
            more = rest[at] + self.weight[first[t]:first[t + 1]]
            if more.max(initial=0) > threshold / 2:
                self.pivot = t
                break
            rest[at] = more
        pad = np.zeros(self.blocks * POSTING_BLOCK)
        pad[:self.segments] = rest
        self.rest = pad.reshape(self.blocks, POSTING_BLOCK).max(axis=1)
        self.first_block = np.searchsorted(self.block_posting, np.arange(len(vocab) + 1) * self.blocks)
        bits = max(10, int(np.ceil(np.log2(max(len(vocab), 1)))) + 4)
        self.mask, self.slot = np.uint64((1 << bits) - 1), np.full(1 << bits, -1, dtype=np.int32)
        slot = (vocab & self.mask).astype(np.int64)
        self.slot[slot] = np.arange(len(vocab))
        self.crowded = np.zeros(1 << bits, dtype=bool)
        self.crowded[np.flatnonzero(np.bincount(slot, minlength=1 << bits) > 1)] = True

    def terms(self, h: np.ndarray) -> np.ndarray:
        """Term number of each word hash, -1 for words that no item holds."""
        if not len(self.vocab):
            return np.full(len(h), -1)
        slot = (h & self.mask).astype(np.int64)
        at = self.slot[slot].astype(np.int64)
        many = np.flatnonzero(self.crowded[slot])
        at[many] = np.minimum(np.searchsorted(self.vocab, h[many]), len(self.vocab) - 1)
        return np.where((at >= 0) & (self.vocab[at] == h), self.term_of[at], -1)

    def block_sums(self, block: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (text block, posting block) and the sums of the block maxima of essential terms."""
        rare = term >= self.pivot
        block, term = block[rare], term[rare]
        lo, n = self.first_block[term], self.first_block[term + 1] - self.first_block[term]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        key = np.repeat(block, n) * self.blocks + self.block_posting[at] % self.blocks
        value = self.block_max[at]
        if len(key) and (size := int(key.max()) + 1) <= 1 << 23:
            total = np.bincount(key, weights=value, minlength=size)
            keys = np.flatnonzero(total)
            return keys, total[keys]
        order = np.argsort(key, kind="stable")
        keys, heads = np.unique(key[order], return_index=True)
        return keys, np.add.reduceat(value[order], heads) if len(keys) else value

    def search(self, block: np.ndarray, term: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, segment, score) of all scores that reach the threshold.

        Input: distinct (text block, term) pairs in order; ``last`` marks text blocks whose successor is another
        text's. Passage p is text block p with its successor.
        """
        eps = self.threshold - 1e-9
        keys, sums = self.block_sums(block, term)
        found = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        if not len(keys):
            return tuple(found)
        # one of a passage's two text blocks holds at least half of what the bound needs
        strong = keys[sums >= (eps - self.rest[keys % self.blocks]) / 2]
        passages = np.unique(np.concatenate([strong, strong - self.blocks]))
        passages = passages[passages >= 0]
        at_block = passages // self.blocks
        bound = self._lookup(keys, sums, passages) + self.rest[passages % self.blocks]
        bound += np.where(last[at_block], 0.0, self._lookup(keys, sums, passages + self.blocks))
        passages = passages[bound >= eps]
        start = np.searchsorted(block, np.arange(len(last) + 2))
        for part in np.array_split(passages, max(1, len(passages) >> 12)):  # bounded memory
            p = np.repeat(part // self.blocks, POSTING_BLOCK)
            seg = ((part % self.blocks)[:, None] * POSTING_BLOCK + np.arange(POSTING_BLOCK)).ravel()
            ok = seg < self.segments
            p, seg = p[ok], seg[ok]
            n = np.where(last[p], start[p + 1], start[p + 2]) - start[p]
            owner = np.repeat(np.arange(len(seg)), n)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[p], n)
            pair = np.sort(owner * len(self.vocab) + term[at])
            pair = pair[np.diff(pair, prepend=-1) > 0]  # a term of both blocks counts once
            owner, t = pair // max(len(self.vocab), 1), pair % max(len(self.vocab), 1)
            score = np.bincount(owner, weights=self._lookup(self.posting, self.weight, t * self.segments + seg[owner]),
                                minlength=len(seg))
            hit = score >= eps
            found = [np.concatenate(x) for x in zip(found, (p[hit], seg[hit], score[hit]))]
        return tuple(found)

    @staticmethod
    def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0.0)

    def overlap(self, part: np.ndarray, text: np.ndarray) -> float:
        """Share of the part's distinct word n-grams that the text holds; a part without words is held."""
        if not len(part):
            return 1.0
        k = min(GRAM, len(part))
        own, _ = bt.shingles(part, np.array([0, len(part)]), k)
        if len(text) < k:
            return 0.0
        other, _ = bt.shingles(text, np.array([0, len(text)]), k)
        return float(np.isin(np.unique(own), other).mean())

    def find(self, h: np.ndarray, off: np.ndarray, overlap: float) -> list[tuple]:
        """(text number, item number, best score, question overlap, answer overlap) of verified hits."""
        words_of, n = np.diff(off), max(len(self.vocab), 1)
        tid = self.terms(h)
        at = np.flatnonzero(tid >= 0)
        blocks_of = -(-words_of // SEGMENT)
        first = np.cumsum(blocks_of) - blocks_of
        doc = np.repeat(np.arange(len(words_of)), words_of)[at]
        pair = np.sort((first[doc] + (at - off[:-1][doc]) // SEGMENT) * n + tid[at])
        pair = pair[np.diff(pair, prepend=-1) > 0]
        last = np.zeros(int(blocks_of.sum()), dtype=bool)
        last[(first + blocks_of - 1)[blocks_of > 0]] = True
        passage, segment, score = self.search(pair // n, pair % n, last)
        text = np.searchsorted(first + blocks_of, passage, side="right")
        best: dict[tuple[int, int], float] = {}
        for t, i, s in zip(text.tolist(), self.seg_item[segment].tolist(), score.tolist()):
            best[t, i] = max(best.get((t, i), 0.0), s)
        out = []
        for (t, i), s in sorted(best.items()):
            w = h[off[t]:off[t + 1]]
            q, a = self.overlap(self.q[i], w), self.overlap(self.a[i], w)
            if q >= overlap and a >= overlap:
                out.append((t, i, s, q, a))
        return out


def build_indexes(benchmark: DataFrame, threshold: float, id_col: str = "item_id", text_col: str = "text",
                  answer_col: str | None = None, min_words: int = MIN_WORDS) -> list:
    """Broadcast indexes that hold every item of ``min_words`` words or more (rows with a null id are left out).

    Ids may be of any type that can be ordered.
    """
    spark = benchmark.sparkSession
    items = benchmark.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("item_id"), _lower(text_col).alias("question"), _lower(answer_col or F.lit(None)).alias("answer"))
    hashed = items.mapInArrow(lambda it: _item_batches(it, answer_col is not None),
                              f"item_id {dict(items.dtypes)['item_id']}, q array<long>, a array<long>"
                              ).where(F.size("q") + F.size("a") >= max(min_words, 1))
    words = F.concat("q", "a")
    n, total = hashed.agg(F.count("*"), F.coalesce(F.sum(F.size(words)), F.lit(0))).first()
    parts = max(1, -(-8 * total // INDEX_BYTES))
    df = (hashed.select("item_id", "q", "a", F.explode(F.array_distinct(words)).alias("w")).groupBy("w")
          .agg(F.count("*").alias("df")))
    out = []
    for p in range(parts):  # each part is bounded by INDEX_BYTES; parts are scanned one after another
        mine = hashed.where(F.pmod(F.xxhash64("item_id", "q"), F.lit(parts)) == p)
        got = mine.toArrow()
        rows = sorted({(i, tuple(q), tuple(a)) for i, q, a in zip(*(got.column(c).to_pylist() for c in ("item_id", "q", "a")))})
        seen = df.join(mine.select(F.explode(words).alias("w")).distinct(), "w", "left_semi")
        out.append(spark.sparkContext.broadcast(Index(rows, got.schema.field("item_id").type, {r.w: r.df for r in seen.toLocalIterator()}, n, total / max(n, 1), threshold)))
    return out


def _texts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, off = bt.as_bytes(texts)
    for lo, hi in bt.slices(off):
        yield lo, *bt.words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], bt.NO_WORD)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.5, overlap: float = 0.5, **benchmark_columns) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) for every text that holds an item.

    Texts never move: one Arrow pass per index over (id, text). Null and empty texts hold nothing; a repeated
    row is reported for each of its rows; rows with a null id are reported with that null. Ids keep their types. Items that several
    rows repeat word for word under one id count once. An empty benchmark gives no rows.
    """
    lower = docs.select(F.col(id_col).alias("id"), _lower(text_col).alias("text"))

    def scan(batches, index):
        for b in batches:
            hits = [(lo + t, i, s, q, a) for lo, h, off in _texts(b.column("text"))
                    for t, i, s, q, a in index.value.find(h, off, overlap)]
            ids = b.column("id").take(pa.array([x[0] for x in hits], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, index.value.ids.take(pa.array([x[1] for x in hits], pa.int64()))]
                + [pa.array([float(x[c]) for x in hits], pa.float64()) for c in (2, 3, 4)],
                ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    schema = f"doc_id {dict(lower.dtypes)['id']}, item_id {dict(benchmark.dtypes)[benchmark_columns.get('id_col', 'item_id')]}, "
    schema += "score double, question_overlap double, answer_overlap double"
    parts = [lower.mapInArrow(lambda it, ix=ix: bt.tidy(scan(it, ix)), schema) for ix in build_indexes(benchmark, threshold, **benchmark_columns)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = 0.5,
                  overlap: float = 0.5, **benchmark_columns) -> DataFrame:
    """The rows of ``docs`` (all columns, in place, no shuffle) whose text holds no benchmark item."""
    out = docs
    for ix in build_indexes(benchmark, threshold, **benchmark_columns):
        out = out.where(~_holds_item(ix, overlap)(_lower(text_col)))
    return out


def _holds_item(index, overlap: float):
    """A boolean column function of the lower-case text; only the text goes to Python."""
    @F.arrow_udf("boolean")
    def holds(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), dtype=bool)
        for lo, h, off in _texts(text):
            for t, *_ in index.value.find(h, off, overlap):
                out[lo + t] = True
        pa.default_memory_pool().release_unused()
        return pa.array(out)

    return holds.asNondeterministic()  # evaluated once per row
