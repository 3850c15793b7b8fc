"""Phrase collocation mining with vertically partitioned suffix subtrees (operator 13).

Texts are cut into pieces at punctuation and line ends and these into words; counts are kept per language. The suffixes
of the word sequence, cut at five words, form a tree whose nodes are the phrases. It is built in parts that fit memory:

1. Words are counted as text and get a 64-bit key, which is checked to be unique (else all keys are made anew).
2. Pairs of words that may be frequent are counted. Fixed-size bitmaps of the frequent words and pairs tell the tasks
   where a suffix can be cut early: no phrase is frequent beyond an infrequent pair. A bit too many costs time only.
3. The remaining suffixes of three to five words are added up: the leaves. Prefixes with more leaves than the budget of a
   group are prolonged word by word; the prefixes are packed into groups of at most twice the budget.
4. Each group sorts its leaves, which is its part of the suffix tree, and reads the counts of its nodes off leaf totals.

A candidate's cuts then meet the counts of their two parts in joins.
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

MOST_WORDS = 5
#: Bits of the bitmaps of frequent words and pairs: 8 MB each, whatever the corpus.
BITS = 1 << 26
#: Leaves of a group: a task holds at most twice as many rows of six longs.
GROUP_LEAVES = 500_000
KEYS = [f"k{i}" for i in range(1, MOST_WORDS + 1)]

_PIECE_END = np.zeros(256, dtype=bool)
_PIECE_END[[*b".,;:!?", 10, 11, 12, 13]] = True
_BETWEEN = _PIECE_END.copy()
_BETWEEN[[9, 32]] = True


class _Pieces(Words):
    """The words of a slice of texts, and whether a word and the next stand in one piece."""

    def __init__(self, data: np.ndarray, off: np.ndarray, salts: np.ndarray, seed: int):
        super().__init__(data, off, _BETWEEN, salts, seed)
        ends = np.cumsum(_PIECE_END[data], dtype=np.int32)[self.s]
        self.joined = (ends[1:] == ends[:-1]) & (self.text[1:] == self.text[:-1])


def _slices(batches, seed: int):
    """(names of the languages, each text's language, words) of all slices of all batches."""
    for b in batches:
        names = b.column(0).dictionary_encode()
        codes = names.indices.to_numpy(zero_copy_only=False)
        salt = np.array([int.from_bytes(hashlib.blake2b(str(n).encode(), digest_size=8).digest(), "little")
                         for n in names.dictionary.to_pylist()], dtype=np.uint64)
        data, off = bt.as_bytes(b.column(1))
        for lo, hi in bt.slices(off, SLICE):
            part = codes[lo:hi]
            yield names.dictionary, part, _Pieces(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], salt[part], seed)


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(keys).view(np.int64), pa.int64())


def _summed(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows brought together and counted. Rows that only their hash makes neighbours stay apart."""
    h = columns[0].copy()
    for i, c in enumerate(columns[1:], 1):
        h = bt.mix(h + c * np.uint64(2 * i + 1))
    order = np.argsort(h)
    cols = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    at = np.flatnonzero(new)
    return [c[at] for c in cols], np.diff(np.concatenate([at, [len(order)]]))


def _counted_words(seed: int):
    def run(batches):
        for langs, codes, w in _slices(batches, seed):
            if not len(w.key):
                continue
            order = np.argsort(w.key, kind="stable")
            at, first = runs(order, w.key)
            count = np.bincount(first, minlength=len(order))
            odd = w.unlike(first)
            np.subtract.at(count, first[odd], 1)
            rows = np.concatenate([order[at], odd])
            n = np.concatenate([count[order[at]], np.ones(len(odd), dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(codes[w.text[rows]])), w.texts(rows), _signed(w.key[rows]), pa.array(n, pa.int64())],
                ["lang", "word", "key", "n"])
    return lambda batches: bt.tidy(run(batches))


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64(BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a ^ (b << np.uint64(1)) ^ (b >> np.uint64(63))


def _pair_column(a: str, b: str) -> Column:
    """What ``_pair_hash`` gives, as a column."""
    return F.col(a).bitwiseXOR(F.shiftleft(b, 1)).bitwiseXOR(F.shiftrightunsigned(b, 63))


def _bitmap(keys: DataFrame, value: Column) -> np.ndarray:
    """One bit per value modulo ``BITS``; put together by bitmap aggregates, so at most BITS / 8 bytes arrive here."""
    at = F.pmod(value, F.lit(BITS)) + 1
    rows = (keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], dtype=np.uint8)
        at = (r["bucket"] - 1) * 4096
        out[at:at + 4096] = part[:len(out) - at]
    return out


def _good_pairs(w: _Pieces, words: np.ndarray) -> np.ndarray:
    ok = _has(words, w.key)
    return w.joined & ok[1:] & ok[:-1]


def _counted_pairs(seed: int, word_bits):
    def run(batches):
        for _, _, w in _slices(batches, seed):
            at = np.flatnonzero(_good_pairs(w, word_bits.value))
            if len(at):
                (a, b), n = _summed([w.key[at], w.key[at + 1]])
                yield pa.RecordBatch.from_arrays([_signed(a), _signed(b), pa.array(n, pa.int64())], ["k1", "k2", "c"])
    return lambda batches: bt.tidy(run(batches))


def _counted_suffixes(seed: int, word_bits, pair_bits):
    """Suffixes of three to ``MOST_WORDS`` words, ended before the first pair that cannot be frequent (0: no word)."""
    def run(batches):
        for _, _, w in _slices(batches, seed):
            if len(w.key) < 3:
                continue
            pair = _good_pairs(w, word_bits.value)
            at = np.flatnonzero(pair)
            pair[at] = _has(pair_bits.value, _pair_hash(w.key[at], w.key[at + 1]))
            at = np.flatnonzero(pair[:-1] & pair[1:])
            if not len(at):
                continue
            cols, on = [w.key[at], w.key[at + 1], w.key[at + 2]], np.ones(len(at), dtype=bool)
            for j in range(3, MOST_WORDS):
                inside = at + j < len(w.key)
                here = np.where(inside, at + j, 0)
                on = on & inside & pair[np.maximum(here - 1, 0)]
                cols.append(np.where(on, w.key[here], np.uint64(0)))
            cols, n = _summed(cols)
            yield pa.RecordBatch.from_arrays([*map(_signed, cols), pa.array(n, pa.int64())], [*KEYS, "c"])
    return lambda batches: bt.tidy(run(batches))


def _subtree(least: int):
    """The nodes of one group's part of the suffix tree, from its leaves in order."""
    def run(leaves: pa.Table) -> pa.Table:
        cols = [leaves.column(k).to_numpy() for k in KEYS]
        order = np.lexsort(cols[::-1])
        cols = [c[order] for c in cols]
        depth = leaves.column("depth").to_numpy()[order]
        total = np.concatenate([[0], np.cumsum(leaves.column("c").to_numpy()[order])])
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        new[1:] |= (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        phrases, counts = [], []
        for d in range(3, MOST_WORDS + 1):
            new[1:] |= cols[d - 1][1:] != cols[d - 1][:-1]
            at = np.flatnonzero(new)
            a = np.diff(total[np.concatenate([at, [len(order)]])])
            keep = (a >= least) & (cols[d - 1][at] != 0) & (depth[at] <= d)
            at = at[keep]
            flat = np.stack([c[at] for c in cols[:d]], axis=1).ravel()
            phrases.append(pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * d, pa.int32()), pa.array(flat, pa.int64())))
            counts.append(pa.array(a[keep], pa.int64()))
        return pa.Table.from_arrays([pa.chunked_array(phrases), pa.chunked_array(counts)], ["p", "a"])
    return run


def _nodes(leaves: DataFrame, least: int, budget: int, broadcast_rows: int) -> DataFrame:
    """(p, a): phrases of three and more words and their counts, from subtrees built independently."""
    total = leaves.count()
    budget = max(budget, -(-total // broadcast_rows))  # at most broadcast_rows prefixes have more leaves than this
    depth, unit, heavy_nodes = F.lit(2), KEYS[:2], []
    marked, heavy = leaves, None
    for d in range(2, MOST_WORDS):  # prolong the prefixes that have too many leaves
        prefix = KEYS[:d]
        inside = leaves if heavy is None else leaves.join(F.broadcast(heavy), prefix[:-1])
        heavy, _ = stored(inside.groupBy(*prefix).agg(F.count("*").alias("n"), F.sum("c").alias("a")).where(F.col("n") > budget),
                          f"phrases-heavy{d}")
        if not heavy.limit(1).count():
            break
        if d > 2:
            heavy_nodes.append(heavy.where((F.col("a") >= least) & (F.col(prefix[-1]) != 0)).select(F.array(*prefix).alias("p"), "a"))
        heavy = heavy.select(*prefix)
        marked = marked.join(F.broadcast(heavy.withColumn(f"h{d}", F.lit(1))), prefix, "left")
        depth = depth + F.coalesce(F.col(f"h{d}"), F.lit(0))
        unit = [*unit, F.when(F.col(f"h{d}").isNotNull(), F.col(KEYS[d])).otherwise(F.lit(0)).alias(f"p{d + 1}")]
    units = [u if isinstance(u, str) else f"p{i + 1}" for i, u in enumerate(unit)]
    marked = marked.select(*KEYS, "c", depth.alias("depth"), *unit[2:])
    sizes = marked.groupBy(*units).agg(F.count("*").alias("n"))
    bins = max(1, total // (16 * budget))
    before = Window.partitionBy("bin").orderBy(*units).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("bin", F.pmod(F.xxhash64(*units), F.lit(bins)))
    groups, _ = stored(sizes.withColumn("grp", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / F.lit(budget)))
                       .select(*units, "bin", "grp"), "phrases-groups")
    found = (marked.join(small(groups, broadcast_rows), units).select("bin", "grp", *KEYS, "c", "depth")
             .groupBy("bin", "grp").applyInArrow(_subtree(least), "p array<bigint>, a bigint"))
    for nodes in heavy_nodes:
        found = found.unionByName(nodes)
    return found


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100,
                  budget: int = GROUP_LEAVES, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases): frequent words (lang, word, key, n), words of each language (lang, n) and the phrases
    of two to five words with at least ``least`` occurrences as (p, a), p their words' keys."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    for seed in range(16):
        every, _ = stored(texts.mapInArrow(_counted_words(seed), "lang string, word string, key bigint, n bigint")
                          .groupBy("lang", "word", "key").agg(F.sum("n").alias("n")), "phrases-words")
        if not every.groupBy("key").count().where("count > 1 OR key = 0").limit(1).count():
            break
    else:
        raise RuntimeError("no seed gave every word a key of its own")
    totals, _ = stored(every.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    words, _ = stored(every.where(F.col("n") >= least), "phrases-frequent")
    word_bits = spark.sparkContext.broadcast(_bitmap(words, F.col("key")))
    pairs, _ = stored(texts.mapInArrow(_counted_pairs(seed, word_bits), "k1 bigint, k2 bigint, c bigint")
                      .groupBy("k1", "k2").agg(F.sum("c").alias("a")).where(F.col("a") >= least), "phrases-pairs")
    pair_bits = spark.sparkContext.broadcast(_bitmap(pairs, _pair_column("k1", "k2")))
    schema = ", ".join(f"{k} bigint" for k in [*KEYS, "c"])
    leaves, _ = stored(texts.mapInArrow(_counted_suffixes(seed, word_bits, pair_bits), schema)
                       .groupBy(*KEYS).agg(F.sum("c").alias("c")), "phrases-leaves")
    longer = _nodes(leaves, least, budget, broadcast_rows)
    phrases, _ = stored(pairs.select(F.array("k1", "k2").alias("p"), "a").unionByName(longer), "phrases-counts")
    return words, totals, phrases


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, share: int = 100,
                 top: int = 2000, budget: int = GROUP_LEAVES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of a occurrences cut into parts of l and r occurrences scores floor(1000 * a * n / (l * r)), n being the
    language's words; its lowest cut counts (ties: the shorter first part). A phrase goes if a longer one holds its
    words and occurs at least ``share`` percent as often; the longer phrase by one word decides that, as counts only
    fall with length. Score ties go to the greater a, then to the phrase in byte order. Null languages are 'und', null
    texts empty; repeated rows count as often as they occur; empty tables give no rows; other columns are ignored.
    Counts must stay below 10**16; products are decimals of 38 digits.
    """
    words, totals, phrases = phrase_counts(docs, text_col, lang_col, least, budget, broadcast_rows)
    spelled = (phrases.select("p", "a", F.posexplode("p").alias("at", "key"))
               .join(small(words.select("key", "lang", "word"), broadcast_rows), "key")
               .groupBy("p", "a").agg(F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")))
    named, _ = stored(spelled.join(F.broadcast(totals) if totals.count() <= broadcast_rows else totals, "lang")
                      .select("p", "a", "lang", "n", F.array_join(F.col("w.word"), " ").alias("phrase")), "phrases-named")
    parts, _ = stored(words.select(F.array("key").alias("q"), F.col("n").alias("f"))
                      .unionByName(phrases.select(F.col("p").alias("q"), F.col("a").alias("f"))), "phrases-parts")
    parts = small(parts, broadcast_rows)
    size = F.size("p")
    cuts = named.select("p", "a", "lang", "n", "phrase", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = (cuts.withColumn("left", F.slice("p", F.lit(1), F.col("k"))).withColumn("right", F.slice("p", F.col("k") + 1, size - F.col("k")))
            .join(parts.select(F.col("q").alias("left"), F.col("f").alias("l")), "left")
            .join(parts.select(F.col("q").alias("right"), F.col("f").alias("r")), "right"))

    def whole(name):
        return F.col(name).cast("decimal(16,0)")

    cuts = (cuts.withColumn("x", F.lit(1000).cast("decimal(4,0)") * whole("a") * whole("n")).withColumn("y", whole("l") * whole("r"))
            .withColumn("score", F.expr("x div y")).drop("x", "y"))
    cuts, _ = stored(cuts, "phrases-cuts")
    often = F.col("a") * 100
    held = (cuts.where((F.col("k") == size - 1) & (F.col("k") > 1) & (often >= F.col("l") * share)).select(F.col("left").alias("p"))
            .unionByName(cuts.where((F.col("k") == 1) & (size > 2) & (often >= F.col("r") * share)).select(F.col("right").alias("p"))))
    lowest = cuts.groupBy("p", "a", "lang", "n", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    left = lowest.join(held.distinct(), "p", "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
            .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
