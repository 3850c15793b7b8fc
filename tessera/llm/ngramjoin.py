"""N-gram Jaccard self-join with Bayesian candidate pruning (operator 10).

Texts are compared as sets of word shingles (lower case, ``k`` words). Steps:

1. One Arrow pass hashes words and shingles and takes ``HASHES`` MinHash values per text. Texts with
   the same word sequence form a class; only its representative goes on, with the class size as weight.
2. MinHash values are cut into bands; texts that share a band key are candidates. A true pair at 0.8
   shares none of the 24 bands of 4 with probability 3e-6.
3. Within a bucket, pairs are compared ``STEP`` MinHash values at a time. With a uniform prior the
   posterior of the similarity after m of n agreements is Beta(m + 1, n - m + 1); a pair is dropped as
   soon as P(similarity >= threshold) < ``tolerance``.
4. Surviving pairs connect texts to clusters. Each cluster's shingle sets meet in units of two blocks,
   and every pair there that Bayes keeps is verified exactly (on 64-bit shingle identities).

Buckets and clusters of any size are cut into blocks (``pairs.py``), nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import batch as bt
from tessera.llm.graph import connected_components
from tessera.llm.pairs import block_units, linked_rows, root_edges
from tessera.llm.store import numbered, small, stored

HASHES, ROWS_PER_BAND, STEP = 96, 4, 16
BLOCK_ROWS, BLOCK_SHINGLES, BUCKET_ROWS = 256, 400_000, 1024
_rng = np.random.Generator(np.random.PCG64(41))
_XOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For n = STEP, 2 STEP, ... compared values: the fewest agreements that keep a pair.

    P(Beta(m + 1, n - m + 1) >= t) equals P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, 0
        while m < n:
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def minhash(sh: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, HASHES) minima; rows of texts without shingles are meaningless."""
    full = np.flatnonzero(np.diff(off))
    out = np.zeros((len(off) - 1, HASHES), dtype=np.uint64)
    if len(full):
        at = off[:-1][full]
        for k in range(HASHES):
            out[full, k] = np.minimum.reduceat((sh ^ _XOR[k]) * _MUL[k], at)
    return out


def _signature(mins: np.ndarray) -> np.ndarray:
    return (mins >> np.uint64(48)).astype(np.uint16)


def sign_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(node, text) -> (node, k1, k2, n_sh, sig, bands); texts without words have null sig and bands."""
    for b in batches:
        data, off = bt.as_bytes(b.column("text"))
        node = b.column("node")
        for lo, hi in bt.slices(off):
            h, woff = bt.words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            sh, soff = bt.shingles(h, woff, k)
            k1, k2 = bt.sequence_keys(h, woff)
            n, mins = np.diff(soff), minhash(sh, soff)
            band = np.empty((hi - lo, HASHES // ROWS_PER_BAND), dtype=np.uint64)
            for j in range(band.shape[1]):
                x = mins[:, j * ROWS_PER_BAND:(j + 1) * ROWS_PER_BAND]
                band[:, j] = bt.mix(sum(x[:, i] * bt._STEP[i] for i in range(ROWS_PER_BAND)) + np.uint64(j + 1))
            none = n == 0
            sig = _signature(mins)
            yield pa.RecordBatch.from_arrays([
                node.slice(lo, hi - lo), pa.array(k1), pa.array(k2), pa.array(n, pa.int64()),
                pa.array([None if z else r.tobytes() for r, z in zip(sig, none)], pa.binary()),
                pa.array([None if z else r for r, z in zip(band.view(np.int64), none)], pa.list_(pa.int64())),
            ], ["node", "k1", "k2", "n_sh", "sig", "bands"])


def _bayes(table: pa.Table, least: list[int]):
    """A filter on row pairs: compare signatures STEP values at a time, dropping hopeless pairs."""
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, HASHES)

    def keep(i, j):
        same = np.zeros(len(i), dtype=np.int16)
        for s, m in enumerate(least):
            cols = slice(s * STEP, (s + 1) * STEP)
            same += (sig[i, cols] == sig[j, cols]).sum(axis=1, dtype=np.int16)
            ok = same >= m
            i, j, same = i[ok], j[ok], same[ok]
        return i, j

    return keep


def shingle_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Replace ``text`` by its sorted distinct shingles as bytes."""
    for b in batches:
        data, off = bt.as_bytes(b.column("text"))
        rest = [i for i, name in enumerate(b.schema.names) if name != "text"]
        for lo, hi in bt.slices(off):
            h, woff = bt.words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            sh, soff = bt.shingles(h, woff, k)
            sets = [np.unique(sh[soff[t]:soff[t + 1]]).tobytes() for t in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([*(b.column(i).slice(lo, hi - lo) for i in rest), pa.array(sets, pa.binary())],
                                             [*(b.schema.names[i] for i in rest), "sh"])


def _exact(table: pa.Table, least: list[int], threshold: float):
    """A filter on row pairs: Bayes, the bound from set sizes, then the exact Jaccard similarity."""
    data, off = bt.as_bytes(table.column("sh"))
    sh, off = np.frombuffer(data.tobytes(), dtype=np.uint64), off // 8
    size, bayes = np.diff(off), _bayes(table, least)

    def link(i, j):
        i, j = bayes(i, j)
        ok = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
        i, j = i[ok], j[ok]
        good = np.zeros(len(i), dtype=bool)
        order = np.argsort(i, kind="stable")
        heads = np.flatnonzero(np.diff(i[order], prepend=-1))
        for at in np.split(order, heads[1:]) if len(order) else []:
            own = sh[off[i[at[0]]]:off[i[at[0]] + 1]]
            for part in np.array_split(at, max(1, int(size[j[at]].sum()) >> 21)):
                n = size[j[part]]
                begin = np.cumsum(n) - n
                other = sh[np.arange(int(n.sum())) - np.repeat(begin, n) + np.repeat(off[j[part]], n)]
                hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
                both = np.add.reduceat(hit, begin, dtype=np.int64)
                good[part] = both >= threshold * (len(own) + n - both) - 1e-9
        return i[good], j[good]

    return link


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       threshold: float = 0.8, tolerance: float = 1e-6) -> dict[str, DataFrame]:
    """Link all texts whose shingle sets have a Jaccard similarity of at least ``threshold``.

    Returns ``rows`` (a stored copy of ``docs`` with a unique ``node`` per row), ``members`` (node, id, rep: the
    node that represents all texts with the same word sequence, weight: their number), ``links`` (rep, links:
    rows linked outside the own class) and ``components`` (rep, component; only classes that have links).
    Null and empty texts link with nothing. Repeated rows and null ids stay separate rows. All columns of
    ``docs`` are carried in the struct ``row`` of ``rows``, whatever their names.
    """
    rows = numbered(docs.select(F.struct("*").alias("row")), "njoin-rows")
    text = rows.select("node", F.lower(F.col("row")[text_col].cast("string")).alias("text"))
    least = least_matches(threshold, tolerance)
    signed = stored(text.mapInArrow(lambda it: bt.tidy(sign_batches(it, k)),
                                    "node long, k1 long, k2 long, n_sh long, sig binary, bands array<long>"), "njoin-sigs")[0]
    classes = signed.where("n_sh > 0").groupBy("k1", "k2").agg(F.min("node").alias("rep"), F.count("*").alias("weight"))
    ids = rows.select("node", F.col("row")[id_col].alias("id"))
    members = (signed.select("node", "k1", "k2", "n_sh").join(classes, ["k1", "k2"], "left")
               .select("node", F.when(F.col("n_sh") > 0, F.col("rep")).otherwise(F.col("node")).alias("rep"),
                       F.when(F.col("n_sh") > 0, F.col("weight")).otherwise(F.lit(1)).alias("weight"))
               .join(ids, "node"))
    reps = stored(signed.join(classes.select(F.col("rep").alias("node"), "weight"), "node")
                  .select("node", "weight", "n_sh", "sig", "bands"), "njoin-reps")[0]

    buckets = reps.select("node", F.posexplode("bands").alias("band", "key")).withColumn("key", F.col("key") + F.col("band"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    candidates = buckets.drop("band").join(shared, "key").join(reps.select("node", "sig"), "node")
    unit = ["key", "lo", "hi"]
    units = block_units(candidates, ["key"], F.ceil(F.col("m") / BUCKET_ROWS)).select(*unit, "b", "node", "sig")
    edges = units.mapInArrow(lambda it: bt.tidy(root_edges(it, unit, lambda t: _bayes(t, least))), "a long, b long")

    clusters = stored(connected_components(edges).join(reps.select("node", "weight", "n_sh"), "node"), "njoin-clusters")[0]
    sizes = clusters.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_sh") / BLOCK_SHINGLES)).alias("blocks"))
    held = small(clusters.select("node", "component", "weight"))
    sets = (text.join(held, "node").join(reps.select("node", "sig"), "node")
            .mapInArrow(lambda it: bt.tidy(shingle_sets(it, k)), "node long, component long, weight long, sig binary, sh binary")
            .join(sizes, "component"))
    unit2 = ["component", "lo", "hi"]
    verified = block_units(sets, ["component"], F.col("blocks")).select(*unit2, "b", "node", "weight", "sig", "sh")
    found = stored(verified.mapInArrow(lambda it: bt.tidy(linked_rows(it, unit2, lambda t: _exact(t, least, threshold))),
                                       "a long, b long, links long"), "njoin-links")[0]
    return {"rows": rows, "members": members,
            "links": found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links")),
            "components": connected_components(found.select("a", "b")).withColumnRenamed("node", "rep")}


def link_report(join: dict[str, DataFrame]) -> DataFrame:
    """One row per input row: node, doc_id, class_id, n_links, component_id, kept.

    ``class_id`` is the least id with the same word sequence, ``component_id`` the least id reachable by links
    (copies are linked), ``n_links`` the number of other rows linked directly. ``kept`` marks one row of
    each component: the one with the least id (least node among equals). A group of null ids has null ids.
    """
    m = (join["members"].join(join["links"], "rep", "left").join(join["components"], "rep", "left")
         .withColumn("component", F.coalesce("component", "rep")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node"))
    comp = m.groupBy("component").agg(first.alias("first"))
    cls = m.where("weight > 1").groupBy("rep").agg(F.min("id").alias("class_id"))
    return (m.join(comp, "component").join(cls, "rep", "left")
            .select("node", F.col("id").alias("doc_id"),
                    F.when(F.col("weight") > 1, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
                    (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                    F.col("first.id").alias("component_id"), (F.col("first.node") == F.col("node")).alias("kept")))


def keep_one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) without near-duplicates: one row of each group of linked texts stays.

    The row with the least id stays; rows with null or empty text all stay.
    """
    join = ngram_jaccard_join(docs, **options)
    gone, _ = stored(link_report(join).where("NOT kept").select("node"), "njoin-gone")
    return join["rows"].join(small(gone), "node", "left_anti").select("row.*")
