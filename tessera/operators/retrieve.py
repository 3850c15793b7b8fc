"""Retrieval (F1-F8): exact top-k by inner product, plus the query strategies.

Top-k plan: vectors stay where they are. The query side is written once, its rows
and values are counted by an aggregate, and only within ``broadcast_rows`` and
``broadcast_floats`` is it fetched and broadcast; each vector partition scores the
queries block by block, keeps one top-k over its blocks and returns that, and a
``row_number <= k`` window (planned as WindowGroupLimit) picks the global top-k.
Beyond the budget, queries and vectors are hashed into a grid of cells of at most
about ``cell_floats`` values and cogrouped per (query cell, vector cell), with the
same local top-k; nothing passes through the driver. Ties are broken by
``chunk_id`` after rounding scores to 9 decimals, so the order is engine-independent.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.functions.plan import write_through
from tessera.session import ship_package

ROUND = 9
#: Most values of a broadcast query matrix, of a grid cell, and of one block of scores (8 bytes each).
BROADCAST_FLOATS, CELL_FLOATS, SCORE_BLOCK = 16 << 20, 8 << 20, 4 << 20
#: Scores of a block that are rounded and cut at a time.
CUT_SCORES = 1 << 18
#: A score this far beyond a rounded cut can still round to it.
SLACK = 2 * 10.0 ** -ROUND


def _local_topk(qids, qmat, cids, cmat, k, metric):
    """Top-k rows (qid, chunk_id, score, l2_sq) of one vector block, one frame per block of queries."""
    if len(cids) == 0:
        return
    step = max(1, SCORE_BLOCK // len(cids))
    for lo in range(0, len(qids), step):
        yield _block_topk(qids[lo:lo + step], qmat[lo:lo + step], cids, cmat, k, metric)


def _block_topk(qids, qmat, cids, cmat, k, metric):
    dots = qmat @ cmat.T                                     # (q, c), at most SCORE_BLOCK values
    qids, cids = np.asarray(qids), np.asarray(cids)
    if metric == "l2":
        qn, cn = np.einsum("ij,ij->i", qmat, qmat), np.einsum("ij,ij->i", cmat, cmat)
    out = []
    step = max(1, CUT_SCORES // len(cids))
    for lo in range(0, len(qids), step):  # copies of scores are held for these rows alone
        dot = dots[lo:lo + step]
        if metric == "l2":
            l2 = qn[lo:lo + step, None] + cn[None, :] - 2.0 * dot
            key = np.round(l2, ROUND)
        else:
            key = -np.round(dot, ROUND)
        # every vector tied with a query's k-th key stays, so the global tie-break sees them all
        cut = np.partition(key, k - 1, axis=1)[:, k - 1:k] if k < len(cids) else np.full((len(dot), 1), np.inf)
        qi, ci = np.nonzero(key <= cut)
        out.append((qids[lo + qi], cids[ci], dot[qi, ci], l2[qi, ci] if metric == "l2" else np.full(len(qi), np.nan)))
    return pd.DataFrame({n: np.concatenate(v) for n, v in zip(("qid", "chunk_id", "score", "l2_sq"), zip(*out))})


def _near(cut, qmat, cmat, k, metric):
    """(query, vector, key, score, l2_sq) arrays of a vector block: what may be among a query's best k, given its cut so far."""
    if metric == "l2":
        qn, cn = np.einsum("ij,ij->i", qmat, qmat), np.einsum("ij,ij->i", cmat, cmat)
    step = max(1, SCORE_BLOCK // len(cmat))
    for top in range(0, len(qmat), step):
        dots = qmat[top:top + step] @ cmat.T
        rows = max(1, CUT_SCORES // len(cmat))
        for lo in range(top, top + len(dots), rows):
            dot = dots[lo - top:lo - top + rows]
            far = -dot if metric != "l2" else qn[lo:lo + len(dot), None] + cn[None, :] - 2.0 * dot
            limit = cut[lo:lo + len(dot)] + SLACK
            able = far <= limit[:, None]
            if k < len(cmat) and np.count_nonzero(able) > 4 * k * len(dot):  # no cut yet, or a much better block
                limit = np.fmin(limit, np.partition(far, k - 1, axis=1)[:, k - 1] + SLACK)
                able = far <= limit[:, None]
            qi, ci = np.nonzero(able)
            far = far[qi, ci]
            yield lo + qi, ci, np.round(far, ROUND), dot[qi, ci], far if metric == "l2" else np.full(len(far), np.nan)


def _cut_down(parts, cut, k):
    """The best k of each query, with those tied with the k-th unless they are many; ``cut`` gets the k-th keys."""
    q, cid, key, dot, l2 = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((key, q))
    rank = np.arange(len(q)) - np.searchsorted(q[order], q[order])
    kth = order[rank == k - 1]
    cut[q[kth]] = key[kth]
    keep = np.flatnonzero(key <= cut[q])
    if len(keep) > 8 * k * len(cut):  # the least chunk ids win in the end: only they are held
        by_id = pc.rank(pa.array(cid[keep]), "ascending", null_placement="at_start").to_numpy()
        keep = keep[np.lexsort((by_id, key[keep], q[keep]))]
        keep = keep[np.arange(len(keep)) - np.searchsorted(q[keep], q[keep]) < k]
    return q[keep], cid[keep], key[keep], dot[keep], l2[keep]


def _task_topk(batches, qids, qmat, k, metric, block_rows, schema):
    """Top-k rows of each query among all vectors (cid, cv) of a task; a block's scores only meet the k-th found so far."""
    cut, held, new = np.full(len(qids), np.inf), [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, block_rows):
            part = pa.Table.from_batches([batch.slice(lo, block_rows)])
            cids, cmat = part["cid"].to_numpy(), _matrix(part["cv"])
            for q, c, *scores in _near(cut, qmat, cmat, k, metric):
                held.append((q, cids[c], *scores))
                new += len(q)
                if new > 4 * k * len(qids):
                    held, new = [_cut_down(held, cut, k)], 0
            held, new = ([_cut_down(held, cut, k)], 0) if new else (held[:1], 0)
    if held:
        q, cid, _, dot, l2 = _cut_down(held, cut, k)
        for lo in range(0, len(q), CUT_SCORES):
            at = slice(lo, lo + CUT_SCORES)
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip((qids[q[at]], cid[at], dot[at], l2[at]), schema)],
                                             schema=schema)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of doubles, without a Python object for each."""
    sizes = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(sizes) > 1:
        raise ValueError(f"vectors of {sorted(sizes)} values")
    values = [c.flatten().to_numpy(zero_copy_only=False) for c in vectors.chunks]
    flat = np.concatenate(values, dtype=np.float64) if len(values) != 1 else values[0].astype(np.float64, copy=False)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def _met(qtab: pa.Table, vtab: pa.Table, k: int, metric: str, block_rows: int, schema: pa.Schema) -> pa.Table:
    """Local top-k rows of the queries (qid, qv) and vectors (cid, cv) that meet in one cell."""
    qids, qmat = qtab["qid"].to_numpy(), _matrix(qtab["qv"])
    cids, cmat = vtab["cid"].to_numpy(), _matrix(vtab["cv"])
    found = []
    for i in range(0, len(cids) if len(qids) else 0, block_rows):
        for hits in _local_topk(qids, qmat, cids[i:i + block_rows], cmat[i:i + block_rows], k, metric):
            found.append(pa.Table.from_pandas(hits, schema=schema, preserve_index=False))
    return pa.concat_tables(found) if found else schema.empty_table()


def _hit_schema(q: DataFrame, v: DataFrame) -> tuple[T.StructType, pa.Schema]:
    """The local top-k rows' schema, for Spark and for Arrow."""
    kinds = [q.schema["qid"].dataType, v.schema["cid"].dataType, T.DoubleType(), T.DoubleType()]
    names = ("qid", "chunk_id", "score", "l2_sq")
    return (T.StructType([T.StructField(n, t) for n, t in zip(names, kinds)]),
            pa.schema([(n, to_arrow_type(t)) for n, t in zip(names, kinds)]))


def _stack(series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.vstack([np.asarray(v, dtype=np.float64) for v in series])


def _global_topk(local: DataFrame, k: int, metric: str) -> DataFrame:
    if metric == "l2":
        order = [F.round("l2_sq", ROUND).asc(), F.col("chunk_id").asc()]
    else:
        order = [F.round("score", ROUND).desc(), F.col("chunk_id").asc()]
    w = Window.partitionBy("qid").orderBy(*order)
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def similarity_search(queries: DataFrame, vectors: DataFrame, k: int = 4, qid: str = "question_id",
                      qvec: str = "embedding", cid: str = "chunk_id", cvec: str = "embedding",
                      metric: str = "ip", exclude_self: bool = False, broadcast_floats: int = BROADCAST_FLOATS,
                      broadcast_rows: int = 500_000, block_rows: int = 4096, cell_floats: int = CELL_FLOATS,
                      grid: tuple[int, int] | None = None) -> DataFrame:
    """HIT rows (qid, rank, chunk_id, score, l2_sq): the top-k vectors per query (F1/F2).

    ``metric='ip'`` ranks by inner product (cosine for unit vectors), ``'l2'`` by
    squared distance ascending. ``exclude_self`` drops chunk_id == qid pairs
    (self-search on one table). A NULL vector finds nothing and is found by nothing.
    A worker holds the queries (``broadcast_floats``) or a pair of cells (``cell_floats`` each) and one
    score block of ``SCORE_BLOCK`` values at a time.
    """
    spark = queries.sparkSession
    ship_package(spark)
    q = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("qv")).where(F.col("qv").isNotNull())
    v = vectors.select(F.col(cid).alias("cid"), F.col(cvec).alias("cv")).where(F.col("cv").isNotNull())
    kk = k + 1 if exclude_self else k
    schema = (f"qid {q.schema['qid'].dataType.simpleString()}, chunk_id {v.schema['cid'].dataType.simpleString()}, "
              "score double, l2_sq double")

    if grid is None:
        # the query side is computed once; its size is an aggregate, and only a side within the budget is fetched
        q = write_through(q, "queries")
        n_q, dim = q.agg(F.count(F.lit(1)), F.max(F.size("qv"))).first()
        if n_q == 0:
            return spark.createDataFrame([], f"`{qid}` {q.schema['qid'].dataType.simpleString()}, rank int, " + schema.partition(", ")[2])
        small = n_q <= broadcast_rows and n_q * dim <= broadcast_floats
        # a vector that cannot be compared is an error of the data: name it
        wrong = F.concat(F.lit("vector of "), F.col("cid").cast("string"), F.lit(f" has not {dim} values"))
        v = v.withColumn("cv", F.when(F.size("cv") == dim, F.col("cv")).otherwise(F.raise_error(wrong)))
    else:
        small = False
    if small:
        qpdf = q.toPandas()
        bq = spark.sparkContext.broadcast((qpdf["qid"].to_numpy(), _stack(qpdf["qv"])))

        arrow = _hit_schema(q, v)[1]

        def score_part(batches):
            return _task_topk(batches, *bq.value, kk, metric, block_rows, arrow)

        local = v.mapInArrow(score_part, schema)
    else:
        if grid is None:  # cells of a fixed number of values, however many vectors there are
            n_v = v.count()
            grid = max(1, -(-n_q * dim // cell_floats)), max(1, -(-n_v * dim // cell_floats))
        qb, cb = grid
        qx = q.select("*", F.pmod(F.xxhash64("qid"), F.lit(qb)).alias("qb"),
                      F.explode(F.sequence(F.lit(0), F.lit(cb - 1))).alias("cb"))
        vx = v.select("*", F.pmod(F.xxhash64("cid"), F.lit(cb)).alias("cb"),
                      F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"))

        def score_cell(qpdf, vpdf):
            cids, cmat = vpdf["cid"].to_numpy(), _stack(vpdf["cv"])
            qids, qmat = qpdf["qid"].to_numpy(), _stack(qpdf["qv"])
            found = [hit for i in range(0, len(cids), block_rows)
                     for hit in _local_topk(qids, qmat, cids[i:i + block_rows], cmat[i:i + block_rows], kk, metric)]
            return pd.concat(found) if found else pd.DataFrame({"qid": [], "chunk_id": [], "score": [], "l2_sq": []})

        local = qx.groupBy("qb", "cb").cogroup(vx.groupBy("qb", "cb")).applyInPandas(score_cell, schema)
    if exclude_self:
        local = local.where(F.col("qid") != F.col("chunk_id"))
    top = _global_topk(local, k, metric)
    return top.select(F.col("qid").alias(qid), "rank", "chunk_id", "score", "l2_sq")


def search_with_scores(queries: DataFrame, vectors: DataFrame, k: int = 4, **kw) -> DataFrame:
    """Top-k by squared L2 distance (the store's default), with cosine too (F2)."""
    hits = similarity_search(queries, vectors, k=k, metric="l2", **kw)
    return hits.withColumnRenamed("score", "cosine")


def attach_chunks(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Join hit rows to their chunk text and origin document id."""
    return hits.join(chunks.select("chunk_id", "origin_doc_id", "page_content"), "chunk_id")


def retrieve_batch(hits: DataFrame, chunks: DataFrame, qid: str = "question_id") -> DataFrame:
    """Per question: contexts and origin ids as rank-ordered arrays."""
    rows = attach_chunks(hits, chunks)
    packed = rows.groupBy(qid).agg(F.array_sort(F.collect_list(F.struct("rank", "page_content", "origin_doc_id")))
                                   .alias("r"))
    return packed.select(qid, F.transform("r", lambda x: x["page_content"]).alias("contexts"),
                         F.transform("r", lambda x: x["origin_doc_id"]).alias("contexts_origin_doc_ids"))


def multi_query(variant_hits: DataFrame, chunks: DataFrame, qid: str = "question_id") -> DataFrame:
    """Unique union of the hits of all variants of a question, in a defined order.

    ``variant_hits``: (qid, rank, chunk_id, score). Unique on the chunk's text and metadata: equal chunks of one
    article count once (the least chunk id stands for them). Order (best rank over variants, best score, chunk_id).
    """
    meta = [c for c in ("page_content", "origin_doc_id", "url", "domain", "title", "author", "date") if c in chunks.columns]
    per_chunk = variant_hits.groupBy(qid, "chunk_id").agg(F.min("rank").alias("r"), F.max("score").alias("s"))
    g = (per_chunk.join(chunks.select("chunk_id", *meta), "chunk_id").groupBy(qid, *meta)
         .agg(F.min("chunk_id").alias("chunk_id"), F.min("r").alias("best_rank"), F.max("s").alias("best_score")))
    w = Window.partitionBy(qid).orderBy(F.col("best_rank"), F.round("best_score", ROUND).desc(), F.col("chunk_id"))
    return g.select(qid, "chunk_id", F.row_number().over(w).alias("rank"), F.col("best_score").alias("score"))


def step_back(normal_hits: DataFrame, stepped_hits: DataFrame, chunks: DataFrame, qid: str = "question_id") -> DataFrame:
    """Normal results then step-back results, keeping the first per page text."""
    both = (normal_hits.withColumn("src_ord", F.lit(0)).unionByName(stepped_hits.withColumn("src_ord", F.lit(1))))
    both = attach_chunks(both, chunks)
    first = both.groupBy(qid, "page_content").agg(
        F.min_by(F.struct("chunk_id", "score", "src_ord", "rank"), F.struct("src_ord", "rank")).alias("f"))
    w = Window.partitionBy(qid).orderBy(F.col("f.src_ord"), F.col("f.rank"))
    return first.select(qid, F.col("f.chunk_id").alias("chunk_id"), F.row_number().over(w).alias("rank"),
                        F.col("f.score").alias("score"))


#: Asks a generator for the useful part of a context; the word by which it says that there is none.
COMPRESS_PROMPT = ("Copy, word for word, the parts of the context that help to answer the question. "
                   "Reply NO_OUTPUT if none does.\nQuestion: {question}\nContext:\n{context}\nParts:")
NO_OUTPUT = "NO_OUTPUT"


def compress_contexts(ctx: DataFrame, question: str = "question", context: str = "page_content",
                      qid: str = "question_id", min_overlap: int = 1, extractor=None, generator=None,
                      options: dict | None = None) -> DataFrame:
    """Shorten each context to what serves the question, drop contexts left empty, re-rank densely (F8).

    ``generator``: a language model that is asked for the useful parts of each context (``COMPRESS_PROMPT``).
    ``extractor``: ``Callable[[list[str], list[str]], list[str]]`` (question, context) -> compressed text, run per
    Arrow batch. Neither: the sentences that share >= ``min_overlap`` tokens with the question.
    """
    from tessera.functions.text import word_tokens
    from tessera.operators.generate import generate_batch, render_prompt

    if extractor is not None:
        schema = ctx.schema

        def run(it):
            for pdf in it:
                pdf = pdf.copy()
                pdf[context] = extractor(pdf[question].fillna("").tolist(), pdf[context].fillna("").tolist())
                yield pdf

        out = ctx.mapInPandas(run, schema).where(F.length(F.trim(F.col(context))) > 0)
    elif generator is not None:
        asked = ctx.withColumn("__prompt", render_prompt(COMPRESS_PROMPT, question=question, context=context))
        said = generate_batch(asked, "__prompt", generator, out="__parts", **(options or {}))
        out = (said.withColumn(context, F.trim(F.coalesce("__parts", F.lit("")))).drop("__prompt", "__parts")
               .where((F.length(F.col(context)) > 0) & (F.col(context) != NO_OUTPUT)))
    else:
        sents = F.regexp_extract_all(F.col(context), F.lit("[^.!?]+[.!?]*"), 0)
        qt = word_tokens(question)
        kept = F.filter(sents, lambda s: F.size(F.array_intersect(word_tokens(s), qt)) >= min_overlap)
        out = (ctx.withColumn(context, F.trim(F.array_join(F.transform(kept, lambda s: F.trim(s)), " ")))
               .where(F.length(F.col(context)) > 0))
    w = Window.partitionBy(qid).orderBy("rank")
    return out.withColumn("rank", F.row_number().over(w))
