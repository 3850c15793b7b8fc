"""Toxicity by weak supervision (operator 7).

Voters: word lists in four languages, counts of list words, words and word beginnings that mark labelled toxic texts,
and the label itself where there is one. A generative label model (class prior, each voter's rate of firing per
class) is fitted by EM; pairs of voters that agree more than independence given the class allows share their weight. Its
posteriors are the targets of a linear classifier over hashed words and word beginnings, which scores every whole
text in one Arrow pass. Inputs of a score come from the text alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import batch as bt
from tessera.llm.store import drop_table, small, stored

#: Most labelled rows that the classifier is fitted on (taken by a hash of the id); voters and label model count all labelled rows.
MOST_LABELS = 20_000
#: Distinct vote patterns that the label model takes to the driver; of more, each round is a pass over their stored counts.
MOST_PATTERNS = 100_000
BUCKETS, PREFIXES = 1 << 18, (3, 4, 5, 6, 7, 8)
FEATURES, MINED_VOTERS, LEAST_TEXTS = 2048, 48, 4

# Insults and slurs-free abuse words per list; each list is one voter.
LEXICONS: dict[str, list[str]] = {
    "en_insult": ["idiot", "idiots", "moron", "morons", "stupid", "dumb", "imbecile", "fool", "dimwit", "halfwit", "clown", "loser",
                  "losers", "jerk", "dunce"],
    "en_contempt": ["pathetic", "worthless", "disgusting", "trash", "scum", "garbage", "vermin", "filth", "filthy", "useless",
                    "despicable", "vile", "parasite", "maggot", "lowlife"],
    "en_hostile": ["hate", "kill", "die", "shut", "damn", "hell", "crap", "bastard", "coward", "liar", "freak", "creep", "pig", "rat"],
    "fr_insult": ["idiote", "imbécile", "stupide", "connard", "crétin", "abruti", "débile", "ordure", "minable", "pathétique",
                  "dégoûtant", "salaud"],
    "de_insult": ["idioten", "dumm", "dummkopf", "trottel", "arschloch", "abschaum", "versager", "blöd", "blödmann", "widerlich",
                  "wertlos", "erbärmlich"],
    "es_insult": ["idiota", "imbécil", "estúpido", "estúpida", "tonto", "basura", "escoria", "patético", "inútil", "asqueroso",
                  "payaso", "perdedor"],
}
LISTS = list(LEXICONS)


def _word_hash(words: list[str]) -> np.ndarray:
    h, _ = bt.words(*bt.as_bytes(pa.array([w.lower() for w in words])), bt.NO_WORD)
    return h


def _lexicon_table() -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate([_word_hash(v) for v in LEXICONS.values()])
    k = np.repeat(np.arange(len(LISTS)), [len(v) for v in LEXICONS.values()])
    order = np.argsort(h)
    return h[order], k[order]


def text_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (text, bucket) pairs as text * BUCKETS + bucket, hits per word list, words per text."""
    s, e, woff = bt.spans(data, off, bt.NO_WORD)
    h = bt.hash_spans(data, s, e)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(woff))
    mask = np.uint64(BUCKETS - 1)
    keys = [owner * BUCKETS + (h & mask).astype(np.int64)]
    for n in PREFIXES:
        long = np.flatnonzero(e - s >= n)
        p = bt.mix(bt.hash_spans(data, s[long], s[long] + n) + np.uint64(n))
        keys.append(owner[long] * BUCKETS + (p & mask).astype(np.int64))
    pair = np.sort(np.concatenate(keys))
    table, of_list = _lexicon_table()
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    hit = np.flatnonzero(table[at] == h)
    hits = np.bincount(owner[hit] * len(LISTS) + of_list[at[hit]], minlength=(len(off) - 1) * len(LISTS)).reshape(-1, len(LISTS))
    return pair[np.diff(pair, prepend=-1) > 0], hits, np.diff(woff)


def dense_inputs(hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Inputs besides the buckets: each list seen, any list seen, share of list words, length, empty."""
    total = hits.sum(axis=1)
    return np.column_stack([hits > 0, total > 0, total > 1, np.minimum(total / np.maximum(words, 1) * 20, 1), np.log1p(words) / 10, words == 0])


def _slices(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        data, off = bt.as_bytes(b.column("text"))
        for lo, hi in bt.slices(off):
            yield b, lo, hi, text_features(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, y) -> (bucket, toxic, clean): numbers of texts, summed per task."""
    seen = np.zeros((2, BUCKETS), dtype=np.int64)
    for b, lo, hi, (pair, _, _) in _slices(batches):
        y = b.column("y").to_numpy(zero_copy_only=False)[lo:hi]
        for c in (0, 1):
            seen[c] += np.bincount(pair[y[pair // BUCKETS] == c] % BUCKETS, minlength=BUCKETS)
    at = np.flatnonzero(seen.any(axis=0))
    for lo in range(0, len(at), 10_000):
        p = at[lo:lo + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(seen[1][p]), pa.array(seen[0][p])], ["bucket", "toxic", "clean"])


def posteriors(votes: np.ndarray, gold: np.ndarray, model: dict) -> np.ndarray:
    """Probability of the toxic class per row; a model without rates knows the labels and the prior alone."""
    prior = model["prior"]
    if "rates" not in model:
        return np.where(gold >= 0, np.where(gold == 1, 0.95, 0.05), prior)
    rates, acc = model["rates"], model["label_accuracy"]
    ratio = model["share"] * np.log(rates[1] / rates[0])
    silent = model["share"] * np.log((1 - rates[1]) / (1 - rates[0]))
    z = np.log(prior / (1 - prior)) + votes @ (ratio - silent) + silent.sum()
    z += np.where(gold >= 0, np.where(gold == 1, 1, -1) * np.log(acc / (1 - acc)), 0)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def vote_sums(votes: np.ndarray, gold: np.ndarray, times: np.ndarray, model: dict) -> np.ndarray:
    """What a round needs of rows that occur ``times`` often, as one vector of sums.

    Per class: rows, firings and co-firings weighted by the posterior; then the labelled rows and how far labels agree.
    """
    post = posteriors(votes, gold, model)
    out = []
    for q in (times * (1 - post), times * post):
        out += [[q.sum()], q @ votes, ((votes * q[:, None]).T @ votes).ravel()]
    right = np.where(gold >= 0, np.where(gold == 1, post, 1 - post), 0)
    return np.concatenate([*out, [times[gold >= 0].sum(), times @ right]])


def fit_label_model(sums: Callable[[dict], np.ndarray], v: int, toxic: float, labelled: float, rounds: int = 50) -> dict:
    """EM over class prior and firing rates; the label is a voter with its own accuracy. ``sums`` gives ``vote_sums`` over all rows.

    A voter's log likelihood ratio is divided by one plus the sum of its positive correlations with other voters given the class.
    """
    model = {"prior": np.clip(toxic / max(labelled, 1), 0.01, 0.5)}
    share, last = np.ones(v), None
    for r in range(rounds):
        got = sums(model)
        n, labelled, right = got[0] + got[1 + v + v * v], got[-2], got[-1]
        rates, excess = np.zeros((2, v)), np.zeros((v, v))
        for c in (0, 1):
            total, fired, both = np.split(got[c * (1 + v + v * v):][:1 + v + v * v], [1, 1 + v])
            total, both = total[0], both.reshape(v, v)
            rate = rates[c] = np.clip((fired + 0.5 * (0.02 if c == 0 else 0.1)) / (total + 0.5), 1e-4, 1 - 1e-4)
            cov = both - np.outer(rate, fired) - np.outer(fired, rate) + total * np.outer(rate, rate)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            excess = np.maximum(excess, cov / sd[:, None] / sd[None])
        if r % 10 == 0:  # dependence given the class
            np.fill_diagonal(excess, 0)
            share = 1 / (1 + np.clip(excess - 0.1, 0, 1).sum(axis=1))
        prior = np.clip(got[1 + v + v * v] / max(n, 1e-9), 1e-3, 0.9)
        acc = np.clip((right + 9.5) / (labelled + 10), 0.6, 0.995)
        model = {"prior": prior, "rates": rates, "share": share, "label_accuracy": acc}
        now = np.concatenate([share * np.log(rates[1] / rates[0]), share * np.log((1 - rates[1]) / (1 - rates[0])), [np.log(prior / (1 - prior)), np.log(acc / (1 - acc))]])
        if last is not None and np.abs(now - last).sum() < 4e-6 and r > 20:  # no posterior moves by 1e-6
            break
        last = now
    return model


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, dict]:
    """Posterior of the toxic class per row from binary ``votes`` and the labels ``gold`` (0, 1; -1 for none), and the model."""
    once = np.ones(len(votes))
    model = fit_label_model(lambda m: vote_sums(votes, gold, once, m), votes.shape[1], (gold == 1).sum(), (gold >= 0).sum(), rounds)
    return posteriors(votes, gold, model), model


def unpacked(pattern: np.ndarray, v: int) -> np.ndarray:
    """Votes (0.0, 1.0) of the bits of each pattern."""
    return (pattern[:, None] >> np.arange(v) & 1).astype(float)


def corpus_label_model(patterns: DataFrame, v: int) -> dict:
    """The label model of all rows of (pattern, gold), from the count of each distinct pair."""
    spark = patterns.sparkSession
    counts, path = stored(patterns.groupBy("pattern", "gold").agg(F.count("*").alias("times")), "vote-patterns")
    rows, toxic, labelled = counts.agg(F.count("*"), F.sum(F.when(F.col("gold") == 1, F.col("times")).otherwise(0)),
                                       F.sum(F.when(F.col("gold") >= 0, F.col("times")).otherwise(0))).first()

    def columns(frame):
        return unpacked(frame.pattern.to_numpy(), v), frame.gold.to_numpy(), frame.times.to_numpy(dtype=float)

    if rows <= MOST_PATTERNS:
        held = columns(counts.toPandas().sort_values(["pattern", "gold"]))
        model = fit_label_model(lambda m: vote_sums(*held, m), v, toxic, labelled)
    else:
        def sums(m):
            def part(batches):
                total = sum((vote_sums(*columns(b.to_pandas()), m) for b in batches), np.zeros(2 * (1 + v + v * v) + 2))
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

            each = counts.mapInArrow(part, "sums array<double>").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s"))
            return each.orderBy("pos").toPandas().s.to_numpy()

        model = fit_label_model(sums, v, toxic, labelled)
    drop_table(spark, path)
    return model


def fit_sparse(rows: np.ndarray, cols: np.ndarray, n: int, k: int, dense: np.ndarray, y: np.ndarray, ridge: float = 2.0,
               rounds: int = 400) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on soft targets: weights of k sparse binary inputs, of the dense ones, and the constant."""
    w, u, c = np.zeros(k), np.zeros(dense.shape[1]), 0.0
    m = [np.zeros(k), np.zeros(dense.shape[1]), 0.0]
    s = [np.zeros(k), np.zeros(dense.shape[1]), 0.0]
    for t in range(1, rounds + 1):
        z = np.bincount(rows, weights=w[cols], minlength=n) + dense @ u + c
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grads = (np.bincount(cols, weights=g[rows], minlength=k) + ridge * w, dense.T @ g + ridge * u, g.sum())
        step = 0.05 if t < rounds * 3 // 4 else 0.01
        new = []
        for i, (x, d) in enumerate(zip((w, u, c), grads)):
            m[i] = 0.9 * m[i] + 0.1 * d
            s[i] = 0.99 * s[i] + 0.01 * d * d
            new.append(x - step * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(s[i] / (1 - 0.99 ** t)) + 1e-9))
        w, u, c = new
    return w, u, float(c)


def best_of_each_side(toxic: pd.DataFrame, clean: pd.DataFrame, most: int = FEATURES) -> pd.DataFrame:
    """The best ``most`` marks (bucket, z), half of each side while it has so many; both tables are sorted, best first."""
    a = max(most // 2, most - len(clean))
    return pd.concat([toxic[:a], clean[:most - min(a, len(toxic))]], ignore_index=True)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str) -> dict:
    """The linear classifier: a weight per bucket, the dense weights and the constant; and the label model's figures."""
    spark = docs.sparkSession
    known = small(labels.where(F.col(label_id).isNotNull() & F.col(label_col).isin(0, 1)).where(~held_out(F.col(label_id)))
                  .select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("y")))
    texts = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col).cast("string")).alias("text"))
    sample = texts.join(known, "id").select("id", "text", "y")  # all labelled rows
    counts = sample.select("text", "y").mapInArrow(_bucket_counts, "bucket long, toxic long, clean long").groupBy("bucket").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    pos, neg = sample.agg(F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0))).first()
    empty = {"weights": np.zeros(BUCKETS), "dense": np.zeros(len(LISTS) + 5), "constant": 0.0, "model": None}
    if not pos or not neg:
        return empty | {"dense": np.array([3.0] * len(LISTS) + [0.0] * 5), "constant": -3.0}
    odds = F.log((F.col("a") + 0.1) / (pos + 0.2)) - F.log((F.col("b") + 0.1) / (neg + 0.2))
    z = odds * F.sqrt(F.col("a") + F.col("b"))
    marks = counts.where(F.col("a") + F.col("b") >= LEAST_TEXTS).select("bucket", z.alias("z"))
    top = best_of_each_side(*(marks.where(F.col("z") * side > 0).orderBy(F.desc(F.col("z") * side), "bucket").limit(FEATURES).toPandas() for side in (1, -1)))
    buckets, z = top.bucket.to_numpy(), top.z.to_numpy()
    order = np.argsort(buckets)
    buckets, z = buckets[order], z[order]

    mined = np.argsort(-z, kind="stable")[:MINED_VOTERS]
    mined = mined[z[mined] > 0]
    v = len(LISTS) + 2 + len(mined)
    place = np.full(len(buckets), -1)
    place[mined] = np.arange(len(mined)) + len(LISTS) + 2

    def found_in(pair):
        """(text, place among the buckets) of the pairs whose bucket is one of them, by text."""
        if not len(buckets):
            return pair[:0], pair[:0]
        at = np.minimum(np.searchsorted(buckets, pair % BUCKETS), len(buckets) - 1)
        ok = buckets[at] == pair % BUCKETS
        return pair[ok] // BUCKETS, at[ok]

    def patterns_of(batches):
        for b, lo, hi, (pair, hits, words) in _slices(batches):
            bits = dense_inputs(hits, words)[:, :len(LISTS) + 2].astype(np.int64) @ (1 << np.arange(len(LISTS) + 2))
            owner, at = found_in(pair)
            fires = place[at] >= 0
            np.bitwise_or.at(bits, owner[fires], 1 << place[at[fires]])
            yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), pa.array(bits)], ["id", "pattern"])

    def rows_of(batches):
        for b, lo, hi, (pair, hits, words) in _slices(batches):
            owner, at = found_in(pair)
            cut = np.searchsorted(owner, np.arange(hi - lo + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").slice(lo, hi - lo), b.column("y").slice(lo, hi - lo),
                 pa.array([at[cut[i]:cut[i + 1]] for i in range(hi - lo)], pa.list_(pa.int64())),
                 pa.array(list(dense_inputs(hits, words).astype(float)), pa.list_(pa.float64()))], ["id", "y", "at", "dense"])

    kind = dict(texts.dtypes)["id"]
    voted = texts.mapInArrow(patterns_of, f"id {kind}, pattern long").join(known, "id")  # rows without a label: see README
    model = corpus_label_model(voted.select("pattern", F.col("y").alias("gold")), v)
    chosen = F.broadcast(known.orderBy(F.xxhash64("id"), "id", "y").limit(MOST_LABELS))
    # a document with several labels or rows gives several examples, MOST_LABELS in all
    examples = texts.join(chosen, "id").select("id", "text", "y").mapInArrow(rows_of, f"id {kind}, y int, at array<long>, dense array<double>")
    got = examples.orderBy(F.xxhash64("id"), "id", "y", "at", "dense").limit(MOST_LABELS).toPandas()
    n = len(got)
    rows = np.repeat(np.arange(n), [len(x) for x in got["at"]])
    cols = np.concatenate([np.asarray(x, dtype=np.int64) for x in got["at"]]) if n else np.zeros(0, np.int64)
    dense, y = np.stack(got.dense.to_numpy()), got.y.to_numpy()
    votes = np.zeros((n, v))
    votes[:, :len(LISTS) + 2] = dense[:, :len(LISTS) + 2]
    fires = place[cols] >= 0
    votes[rows[fires], place[cols[fires]]] = 1
    target = posteriors(votes, y, model)
    w, u, c = fit_sparse(rows, cols, n, len(buckets), dense, target)
    weights = np.zeros(BUCKETS)
    weights[buckets] = w
    return {"weights": weights, "dense": u, "constant": c, "model": model}


def held_out(id_col):
    """Rows whose crc32 of the id as text leaves 2 when divided by 4 (null ids: false)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
                    label_col: str = "toxic", threshold: float = 0.3) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Null and empty texts get the score of a text without words. Repeated rows and null ids stay; labels with null id or label
    and labels of held-out ids are not used. Without labels of both classes only the word lists count. Other columns are ignored.
    """
    fitted = train(docs, labels, id_col, text_col, label_id, label_col)
    model = docs.sparkSession.sparkContext.broadcast((fitted["weights"], fitted["dense"], fitted["constant"]))  # 2 MB, fixed size

    def score(batches):
        weights, dense, constant = model.value
        for b, lo, hi, (pair, hits, words) in _slices(batches):
            z = np.bincount(pair // BUCKETS, weights=weights[pair % BUCKETS], minlength=hi - lo) + dense_inputs(hits, words) @ dense + constant
            yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), b.column("held_out").slice(lo, hi - lo),
                                              pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "held_out", "score"])

    texts = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.lower(F.col(text_col).cast("string")).alias("text"))
    kind = dict(docs.dtypes)[id_col]
    return (texts.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
