"""Quality scores by hierarchical empirical Bayes (operator 6).

1. A logistic classifier on counts taken from the whole text (symbols, case, digits, repetition, word shape) gives each
   document's evidence p. It is fitted on at most ``MOST_LABELS`` labelled rows.
2. Grouped sums of p per (host, path) give means for hosts and paths over all documents. Between-group and within-group
   variances give the prior strengths kappa = within / between: a host is shrunk to the global mean with kappa_host
   pseudo-documents, a path to its host with kappa_path. A document's own p is left out of its site's sums.
3. The score is the document's log odds plus the shift of its path's log odds from the global ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import batch as bt
from tessera.llm.store import numbered, small, stored

#: Most labelled rows that the classifier is fitted on (taken by a hash of the id).
MOST_LABELS = 50_000
_CLASSES = {"symbol": b"%#$&*|@^~<>=+_\\{}[]", "shout": b"!?", "digit": b"0123456789",
            "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "stop": b".,;:", "line": b"\n"}
_MASKS = [np.isin(np.arange(256), np.frombuffer(c, np.uint8)).astype(np.uint8) for c in _CLASSES.values()]
#: Names of the classifier's inputs.
INPUTS = [*(f"{c}_share" for c in _CLASSES), *(f"{c}_root" for c in _CLASSES), "word_bytes", "distinct_share", "top_share",
          "log_words", "is_empty"]


def _sums(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def text_inputs(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, INPUTS) from the whole bytes of each text."""
    n = np.maximum(np.diff(off), 1).astype(float)
    shares = np.stack([_sums(m[data], off) / n for m in _MASKS], axis=1)
    h, woff = bt.words(data, off)
    words = np.diff(woff)
    key = np.sort((np.repeat(np.arange(len(words)), words).astype(np.uint64) << np.uint64(42)) | (h >> np.uint64(22)))
    heads = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)))
    owner = (key[heads] >> np.uint64(42)).astype(np.int64)
    distinct = np.bincount(owner, minlength=len(words))
    top = np.zeros(len(words))
    np.maximum.at(top, owner, np.diff(np.append(heads, len(key))))
    w = np.maximum(words, 1)
    return np.column_stack([shares, np.sqrt(shares), np.minimum(n / w, 40) / 10, distinct / w, top / w, np.log1p(words) / 10, words == 0])


def _input_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, off = bt.as_bytes(b.column("text"))
        for lo, hi in bt.slices(off):
            x = text_inputs(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            rest = [b.column(c).slice(lo, hi - lo) for c in ("node", "id", "host", "path")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(list(x), pa.list_(pa.float64()))], ["node", "id", "host", "path", "x"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30, times: np.ndarray | None = None) -> np.ndarray:
    """Weights (last one the constant) of a logistic regression by Newton steps; the ridge is on standardised inputs.

    Each row counts as often as ``times`` says (once without it).
    """
    t = np.ones(len(x)) if times is None else np.asarray(times, dtype=float)
    mean = (t @ x) / t.sum()
    spread = np.sqrt((t @ (x - mean) ** 2) / t.sum())
    spread = np.where(spread > 1e-9, spread, 1.0)
    x = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (t * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.diag(penalty), x.T @ (t * (y - p)) - penalty * w)
        w += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    w[:-1] /= spread
    w[-1] -= w[:-1] @ mean
    return w


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def _strength(within: float, between: float) -> float:
    return float(min(max(within / max(between, 1e-9), 1.0), 1e6))


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """(node, id, host, path, p) -> the same with host_posterior, path_posterior and score."""
    paths, _ = stored(evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss")),
                      "quality-paths")
    hosts, _ = stored(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("ss").alias("hss"),
                                                F.count("*").alias("paths")), "quality-hosts")
    mean = F.col("hs") / F.col("hn")
    n, s, within, between, groups, squares = hosts.agg(
        F.sum("hn"), F.sum("hs"), F.sum(F.col("hss") - F.col("hn") * mean * mean), F.sum(F.col("hn") * mean * mean), F.count("*"),
        F.sum(F.col("hn") * F.col("hn").cast("double"))).first()
    if not n:
        return evidence.select("*", *(F.lit(None).cast("double").alias(c) for c in ("host_posterior", "path_posterior", "score")))
    base = s / n
    v_host = within / n
    k_host = _strength(v_host, (between - n * base * base - (groups - 1) * v_host) / max(n - squares / n, 1.0))
    of_host = paths.join(
        hosts.select(F.col("host").alias("h"), "hn", "hs"), F.col("host").eqNullSafe(F.col("h")))
    pm, hm = F.col("s") / F.col("n"), F.col("hs") / F.col("hn")
    inside, spread, cells, sq = of_host.agg(
        F.sum(F.col("ss") - F.col("n") * pm * pm), F.sum(F.col("n") * (pm - hm) * (pm - hm)), F.count("*"),
        F.sum(F.col("n") * F.col("n").cast("double") / F.col("hn"))).first()
    v_path = inside / n
    k_path = _strength(v_path, (spread - (cells - groups) * v_path) / max(n - sq, 1.0))
    sites = of_host.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), "n", "s", "hn", "hs")
    out = evidence.join(small(stored(sites, "quality-sites")[0]),
                        F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    host_post = (F.col("hs") - F.col("p") + F.lit(k_host * base)) / (F.col("hn") - 1 + F.lit(k_host))
    path_post = (F.col("s") - F.col("p") + F.lit(k_path) * F.col("host_posterior")) / (F.col("n") - 1 + F.lit(k_path))
    return (out.withColumn("host_posterior", host_post).withColumn("path_posterior", path_post)
            .withColumn("score", _sigmoid(_logit(F.col("p")) + _logit(F.col("path_posterior")) - _logit(F.lit(base))))
            .drop("s_host", "s_path", "n", "s", "hn", "hs"))


def quality_scores(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_id: str = "doc_id", label_col: str = "quality", floor: float = 0.5) -> dict[str, DataFrame]:
    """``rows`` (docs as a struct with a ``node`` per row) and ``scores`` (node, doc_id, p, host_posterior, path_posterior, score, keep).

    ``host`` and ``path`` are expressions over the columns of ``docs``; nulls are a site of their own. Null and empty texts are
    scored as empty. Repeated rows are scored each; labels with null id or label are not used, a document with several
    labels gives several examples. Without labels of both kinds p is 0.5 and everything is kept. ``keep`` is score >= floor.
    """
    rows = numbered(docs.select(F.struct("*").alias("row"), host.cast("string").alias("host"), path.cast("string").alias("path")), "quality-rows")
    inputs, _ = stored(rows.select("node", F.col("row")[id_col].alias("id"), "host", "path", F.col("row")[text_col].cast("string").alias("text"))
                       .mapInArrow(lambda it: bt.tidy(_input_batches(it)), f"node long, id {dict(docs.dtypes)[id_col]}, host string, path string, x array<double>"), "quality-inputs")
    known = (labels.where(F.col(label_id).isNotNull() & F.col(label_col).isin(0, 1))
             .select(F.col(label_id).alias("id"), F.col(label_col).cast("int").alias("y")))
    fit = inputs.join(known, "id").orderBy(F.xxhash64("id"), "id", "node").limit(MOST_LABELS).select("x", "y").toPandas()
    if len(fit) and fit.y.nunique() == 2:
        w = fit_logistic(np.stack(fit.x.to_numpy()), fit.y.to_numpy(dtype=float))
    else:
        w = np.zeros(len(INPUTS) + 1)
    terms = F.transform(F.col("x"), lambda v, i: v * F.element_at(F.array(*(F.lit(float(c)) for c in w[:-1])), (i + 1).cast("int")))
    z = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) + F.lit(float(w[-1]))
    evidence, _ = stored(inputs.select("node", "id", "host", "path", _sigmoid(z).alias("p")), "quality-evidence")
    scored = site_posteriors(evidence).withColumn("keep", F.coalesce(F.col("score") >= floor, F.lit(True)))
    return {"rows": rows, "scores": scored.withColumnRenamed("id", "doc_id")}


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score reaches the floor."""
    q = quality_scores(docs, labels, host, path, **options)
    gone, _ = stored(q["scores"].where("NOT keep").select("node"), "quality-gone")
    return q["rows"].join(small(gone), "node", "left_anti").select("row.*")
