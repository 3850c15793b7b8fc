"""Coarse-cell search over stored vectors (F1/F2): centroids, one stored collection per cell, probed or exact top-k.

``build_cells`` fits centroids on a bounded sample, puts every vector into the cell of its nearest centroid and writes
the cells as collections of their own, in one commit; a cell of any size is dealt over several files. A last commit
publishes the table of cells (centroid, radius, rows), which is what searches read first.

``cell_search`` with ``probes=p`` scores a query against its p nearest cells only. Without ``probes`` it is exact: the
nearest cells give each query its k-th best score so far, and then every cell whose best possible score (the triangle
bound from centroid and radius) reaches it is searched as well, so results equal those of a full scan. Only the folders
of cells that some query needs are read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.plan import write_through
from tessera.operators.retrieve import BROADCAST_FLOATS, CELL_FLOATS, ROUND, _global_topk, _hit_schema, _local_topk, _met, _stack
from tessera.session import ship_package
from tessera.sources.collections import collection_append, collection_drop, collections_append, read_collection, read_collections, store_state

#: Vectors that centroids are fitted on, at most (by hash of the id); values of the centroid table, at most.
FIT_ROWS, MOST_CENTRE_FLOATS = 200_000, 8 << 20
#: Rows of a file of a cell.
FILE_ROWS = 200_000
#: Vectors of a slice that are scored at a time.
MEET_ROWS = 4096
#: Slack of the bounds, relative to the sizes of the vectors: far above the error of a double.
SLACK = 1e-9


def fit_centroids(vectors: DataFrame, cells: int, vec: str = "embedding", cid: str = "chunk_id", fit_rows: int = FIT_ROWS,
                  rounds: int = 10, seed: int = 42) -> np.ndarray:
    """At most ``cells`` centroids by distributed k-means on the ``fit_rows`` vectors with the least id hashes, about."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    usable = vectors.where(F.col(vec).isNotNull() & (F.size(vec) > 0))
    n, dim = usable.agg(F.count(F.lit(1)), F.max(F.size(vec))).first()
    if not n:
        return np.zeros((0, 0))
    if cells * dim > MOST_CENTRE_FLOATS:
        raise ValueError(f"{cells} centroids of {dim} values are more than {MOST_CENTRE_FLOATS}")
    part = F.pmod(F.xxhash64(F.col(cid), F.lit(seed)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, fit_rows / n)))
    some = write_through(usable.where(part if n > fit_rows else F.lit(True)).select(array_to_vector(F.col(vec)).alias("features")), "cells-sample")
    model = KMeans(k=max(2, cells), maxIter=rounds, seed=seed, initMode="k-means||").fit(some)
    return np.array(model.clusterCenters(), dtype=np.float64)


def _nearest(centres: np.ndarray):
    """(cell, squared distance) of each vector."""
    norms = np.einsum("ij,ij->i", centres, centres)

    @F.pandas_udf("cell int, d2 double")
    def assign(v: pd.Series) -> pd.DataFrame:
        mat = _stack(v)
        cell = np.zeros(len(mat), dtype=np.int32)
        d2 = np.zeros(len(mat))
        step = max(1, (4 << 20) // max(1, len(centres)))
        for lo in range(0, len(mat), step):
            part = mat[lo:lo + step]
            near = norms[None, :] - 2.0 * (part @ centres.T)
            cell[lo:lo + step] = near.argmin(axis=1)
            d2[lo:lo + step] = ((part - centres[cell[lo:lo + step]]) ** 2).sum(axis=1)
        return pd.DataFrame({"cell": cell, "d2": d2})

    return assign


def build_cells(vectors: DataFrame, store: str, name: str, cells: int = 64, cid: str = "chunk_id", vec: str = "embedding",
                centres: np.ndarray | None = None, file_rows: int = FILE_ROWS, **fit) -> int:
    """Write ``vectors`` as cells of collection ``name``; the number of cells that hold rows.

    A second call replaces the cells at once: searches use the old ones until the new table of cells is committed.
    Null vectors are left out (they find nothing); other columns of ``vectors`` are not stored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(cid).alias("chunk_id"), F.col(vec).cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull())
    if centres is None:
        centres = fit_centroids(rows, cells, **fit)
    old = _cell_collections(spark, store, name)
    if not len(centres):
        collection_append(spark.createDataFrame([], _TABLE), store, f"{name}#cells", mode="replace")
        return 0
    near = _nearest(centres)("embedding")
    wrong = F.concat(F.lit("vector of "), F.col("chunk_id").cast("string"), F.lit(f" has not {centres.shape[1]} values"))
    checked = F.when(F.size("embedding") == centres.shape[1], F.col("embedding")).otherwise(F.raise_error(wrong))
    placed = write_through(rows.withColumn("embedding", checked).withColumn("at", near).select("chunk_id", "embedding", "at.cell", "at.d2"), "cells-placed")
    table = write_through(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max("d2")).alias("radius")), "cells-table")
    build = uuid.uuid4().hex[:12]
    sizes = table.select("cell", F.ceil(F.col("n") / file_rows).alias("files"))
    dealt = (placed.join(F.broadcast(sizes), "cell")  # at most as many rows as centroids
             .withColumn("file", F.pmod(F.xxhash64("chunk_id"), F.col("files"))).repartition("cell", "file"))
    named = F.concat(F.lit(f"{name}#{build}#"), F.col("cell").cast("string"))
    collections_append(dealt.select("chunk_id", "embedding", "cell", named.alias("collection")), store)
    listed = [(i, c.tolist()) for i, c in enumerate(centres)]
    centre = spark.createDataFrame(listed, "cell int, centre array<double>")
    out = table.join(F.broadcast(centre), "cell").select("cell", "n", "radius", "centre", F.lit(build).alias("build"))
    collection_append(out.coalesce(1), store, f"{name}#cells", mode="replace")
    if old:
        collection_drop(spark, store, old)
    return table.count()


_TABLE = "cell int, n bigint, radius double, centre array<double>, build string"


def _cell_collections(spark: SparkSession, store: str, name: str) -> list[str]:
    return [c for c in store_state(spark, store)[1] if c.startswith(f"{name}#") and c != f"{name}#cells"]


def _wanted(pdf: pd.DataFrame, cells: np.ndarray, centres: np.ndarray, radius: np.ndarray, metric: str, probes: int) -> pd.DataFrame:
    """(qid, cell) pairs to search. Without a k-th score the ``probes`` nearest cells, else all others that may hold better."""
    q = _stack(pdf["qv"])
    out = []
    step = max(1, (4 << 20) // max(1, len(cells)))
    for lo in range(0, len(q), step):
        part = q[lo:lo + step]
        dots = part @ centres.T
        size = np.sqrt(np.einsum("ij,ij->i", part, part))[:, None]
        far = np.sqrt(np.maximum(size ** 2 + np.einsum("ij,ij->i", centres, centres)[None, :] - 2 * dots, 0))
        # the best that any vector of a cell can score, larger being better
        best = dots + size * radius if metric == "ip" else -np.maximum(far - radius, 0) ** 2
        order = _by_nearness(part, centres, metric)[:, :probes]
        take = np.zeros(best.shape, dtype=bool)
        np.put_along_axis(take, order, True, axis=1)
        if "kth" in pdf:
            kth = pdf["kth"].to_numpy(dtype=np.float64)[lo:lo + step, None]
            slack = SLACK * (1 + size ** 2 + far.max(axis=1, keepdims=True) ** 2 + radius.max() ** 2) + 10.0 ** -ROUND
            take = ~take & ((best + slack >= kth) | np.isnan(kth))
        qi, ci = np.nonzero(take)
        out.append(pd.DataFrame({"qid": pdf["qid"].to_numpy()[lo:lo + step][qi], "cell": cells[ci].astype(np.int32)}))
    return pd.concat(out) if out else pd.DataFrame({"qid": [], "cell": []})


def cell_search(queries: DataFrame, store: str, name: str, k: int = 4, probes: int | None = None, metric: str = "ip",
                qid: str = "question_id", qvec: str = "embedding", exclude_self: bool = False, first_probes: int = 2,
                broadcast_floats: int = BROADCAST_FLOATS, broadcast_rows: int = 500_000, cell_floats: int = CELL_FLOATS) -> DataFrame:
    """HIT rows (qid, rank, chunk_id, score, l2_sq) like ``similarity_search``, reading only the cells needed.

    ``probes``: search each query's nearest cells only (approximate). None: exact, see above. ``metric`` 'ip' ranks by
    inner product, 'l2' by squared distance. Query ids must be unique; null vectors find nothing. ``exclude_self``
    leaves out a query's own id.
    """
    spark = queries.sparkSession
    ship_package(spark)
    listed = read_collection(spark, store, f"{name}#cells").drop("collection").orderBy("cell").toPandas()  # one row per centroid
    q = write_through(queries.select(F.col(qid).alias("qid"), F.col(qvec).cast("array<double>").alias("qv")).where(F.col("qv").isNotNull()), "cells-queries")
    kk = k + 1 if exclude_self else k
    out_schema = f"`{qid}` {q.schema['qid'].dataType.simpleString()}, rank int, chunk_id string, score double, l2_sq double"
    if not len(listed):
        return spark.createDataFrame([], out_schema)
    plan = spark.sparkContext.broadcast((listed["cell"].to_numpy(), _stack(listed["centre"]), listed["radius"].to_numpy(dtype=np.float64)))
    build = listed["build"].iloc[0]
    pair_schema = f"qid {q.schema['qid'].dataType.simpleString()}, cell int"

    def pairs(df, n):
        def run(it):
            for pdf in it:
                yield _wanted(pdf, *plan.value, metric, n)
        return write_through(df.mapInPandas(run, pair_schema), "cells-pairs")

    def search(wanted):
        return _search_pairs(spark, q, wanted, store, f"{name}#{build}#", listed, kk, metric, broadcast_floats, broadcast_rows, cell_floats)

    first = search(pairs(q, probes or first_probes))
    if exclude_self:
        first = first.where(F.col("qid") != F.col("chunk_id"))
    if probes is None:
        best = write_through(_global_topk(first, k, metric).select("qid", "rank", "chunk_id", "score", "l2_sq"), "cells-first")
        value = -F.col("l2_sq") if metric == "l2" else F.col("score")
        kth = best.groupBy("qid").agg(F.when(F.max("rank") == k, F.min(value)).alias("kth"))
        rest = search(pairs(q.join(kth, "qid", "left"), first_probes))
        if exclude_self:
            rest = rest.where(F.col("qid") != F.col("chunk_id"))
        first = best.drop("rank").unionByName(rest)
    return _global_topk(first, k, metric).select(F.col("qid").alias(qid), "rank", "chunk_id", "score", "l2_sq")


def probes_for_recall(queries: DataFrame, store: str, name: str, recall: float = 0.95, k: int = 4, metric: str = "ip",
                      qid: str = "question_id", qvec: str = "embedding", exclude_self: bool = False, most_queries: int = 500) -> int:
    """The least ``probes`` with which a search finds this share of the true top-k of (a sample of) ``queries``.

    The sample, at most about ``most_queries`` by id hash, is searched exactly; each true hit then says how many of its
    query's nearest cells a search must read to find it. Measure it on queries like those to come: vectors without
    clusters need many more cells than clustered ones.
    """
    spark = queries.sparkSession
    n = queries.count()
    part = F.pmod(F.xxhash64(F.col(qid)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, most_queries / max(1, n))))
    some = write_through(queries.where(F.col(qvec).isNotNull() & (part if n > most_queries else F.lit(True))), "cells-recall")
    listed = read_collection(spark, store, f"{name}#cells").orderBy("cell").toPandas()
    if not len(listed):
        return 1
    hits = cell_search(some, store, name, k, metric=metric, qid=qid, qvec=qvec, exclude_self=exclude_self)
    cells = read_collections(spark, store, [f"{name}#{listed['build'].iloc[0]}#{c}" for c in listed["cell"]]).select("chunk_id", "cell")
    ids, centres = listed["cell"].to_numpy(dtype=np.int32), _stack(listed["centre"])

    def places(it):
        for pdf in it:
            order = _by_nearness(_stack(pdf[qvec]), centres, metric)
            yield pd.DataFrame({"q": np.repeat(pdf[qid].to_numpy(), len(ids)), "cell": ids[order.ravel()],
                                "place": np.tile(np.arange(1, len(ids) + 1), len(pdf))})

    order = some.select(qid, qvec).mapInPandas(places, f"q {some.schema[qid].dataType.simpleString()}, cell int, place long")
    found = (hits.select(F.col(qid).alias("q"), "chunk_id").join(cells, "chunk_id").join(order, ["q", "cell"])
             .groupBy("place").count().orderBy("place").collect())  # at most one row per centroid
    total, so_far = sum(r["count"] for r in found), 0
    for r in found:
        so_far += r["count"]
        if so_far >= recall * total:
            return int(r["place"])
    return 1


def _by_nearness(q: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Places of the cells of each query, nearest centroid (or greatest inner product) first."""
    near = -(q @ centres.T)
    if metric == "l2":
        near = np.einsum("ij,ij->i", centres, centres)[None, :] + 2 * near
    return np.argsort(near, axis=1, kind="stable")


def _id_type(spark: SparkSession, store: str, prefix: str) -> str:
    fields = next(c["schema"]["fields"] for n, c in store_state(spark, store)[1].items() if n.startswith(prefix))
    return next(f["type"] for f in fields if f["name"] == "chunk_id")


def _search_pairs(spark, q, wanted, store, prefix, listed, k, metric, broadcast_floats, broadcast_rows, cell_floats) -> DataFrame:
    """Local top-k rows (qid, chunk_id, score, l2_sq) of the wanted (query, cell) pairs."""
    needed = sorted(r["cell"] for r in wanted.select("cell").distinct().collect())  # at most one row per centroid
    n_q, n_pairs, qtype = q.count(), wanted.count(), q.schema["qid"].dataType.simpleString()
    if not needed:
        return spark.createDataFrame([], f"qid {qtype}, chunk_id {_id_type(spark, store, prefix)}, score double, l2_sq double")
    v = read_collections(spark, store, [f"{prefix}{c}" for c in needed]).select(F.col("chunk_id").alias("cid"), F.col("embedding").alias("cv"), "cell")
    schema = f"qid {qtype}, chunk_id {v.schema['cid'].dataType.simpleString()}, score double, l2_sq double"
    dim = len(listed["centre"].iloc[0])
    if n_q * dim <= broadcast_floats and n_pairs <= broadcast_rows:
        held, asked = q.toPandas(), wanted.toPandas()
        place = pd.Series(np.arange(len(held)), index=held["qid"])
        by_cell = {int(c): place[g].to_numpy() for c, g in asked.groupby("cell")["qid"]}
        sent = spark.sparkContext.broadcast((held["qid"].to_numpy(), _stack(held["qv"]), by_cell))

        def score(it):
            qids, qmat, cells = sent.value
            for pdf in it:
                for c, part in pdf.groupby("cell"):
                    at = cells.get(int(c))
                    if at is not None:
                        yield from _local_topk(qids[at], qmat[at], part["cid"].to_numpy(), _stack(part["cv"]), k, metric)

        return v.mapInPandas(score, schema)
    # beyond: queries and vectors of a cell are dealt into slices of a bounded number of values and meet slice by slice
    most = max(1, cell_floats // dim)
    shares = wanted.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).alias("qs")).join(
        spark.createDataFrame(listed[["cell", "n"]]).select(F.col("cell").cast("int").alias("cell"), F.ceil(F.col("n") / most).alias("vs")), "cell")
    shares = F.broadcast(shares)  # one row per centroid
    qx = (wanted.join(q, "qid").join(shares, "cell").withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("qs")))
          .withColumn("vb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("vs") - 1))).select("qid", "qv", "cell", "qb", "vb"))
    vx = (v.join(shares, "cell").withColumn("vb", F.pmod(F.xxhash64("cid"), F.col("vs")))
          .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qs") - 1))).select("cid", "cv", "cell", "qb", "vb"))

    rows, held = _hit_schema(q, v)

    def meet(a, b):
        return _met(a, b, k, metric, MEET_ROWS, held)

    return qx.groupBy("cell", "qb", "vb").cogroup(vx.groupBy("cell", "qb", "vb")).applyInArrow(meet, rows)
