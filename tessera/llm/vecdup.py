"""Embedding near-duplicates: random-hyperplane signs in several tables, exact cosine, components (operator 2).

Vectors are compared only within equal (label, length). Equal vectors of a label form a class with a weight.
``bits`` per table grows with the logarithm of the largest label, so buckets stay small; the number of tables
follows from the wanted recall at the threshold. Rows of a bucket carry only their sign bits: pairs whose
Hamming distance is more than six deviations above its mean at the threshold are dropped, the rest connect
clusters whose vectors meet in block units for the exact cosine in double precision.
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

BLOCK_ROWS, BUCKET_ROWS = 512, 1024


def plan_tables(rows: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits per table, tables): buckets of about 64 unrelated rows; P(no common bucket at threshold) <= miss."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = max(8, math.ceil(math.log2(max(rows, 1) / 64 + 1)))
    return bits, math.ceil(math.log(miss) / math.log(1 - agree ** bits))


def sign_batches(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """(node, grp, vec) -> (node, sig, keys): packed signs against fixed hyperplanes and one key per table."""
    planes: dict[int, np.ndarray] = {}
    for b in batches:
        vec, group = b.column("vec"), b.column("grp").to_numpy(zero_copy_only=False)
        off = np.asarray(vec.offsets)
        flat, dims = np.asarray(vec.values.slice(off[0], off[-1] - off[0]), dtype=np.float64), np.diff(off)
        off = off - off[0]
        for d in np.unique(dims):
            if d not in planes:
                planes[d] = np.random.Generator(np.random.PCG64([5, int(d)])).standard_normal((int(d), bits * tables))
            for at in np.array_split(rows := np.flatnonzero(dims == d), max(1, len(rows) // 2048)):
                if not len(at):
                    continue
                signs = flat[off[at][:, None] + np.arange(d)] @ planes[d] > 0
                sig = np.packbits(signs, axis=1)
                value = signs.reshape(len(at), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
                key = bt.mix(value.astype(np.uint64) * bt._STEP[0] + np.arange(tables, dtype=np.uint64) * bt._STEP[1]
                             + group[at].view(np.uint64)[:, None] * bt._STEP[2])
                yield pa.RecordBatch.from_arrays([
                    b.column("node").take(pa.array(at)), pa.array([r.tobytes() for r in sig], pa.binary()),
                    pa.array(list(key.view(np.int64)), pa.list_(pa.int64()))], ["node", "sig", "keys"])


def _near(table: pa.Table, most: int):
    raw = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint8).reshape(table.num_rows, -1)
    grp = table.column("grp").to_numpy()
    raw = np.pad(raw, ((0, 0), (0, -raw.shape[1] % 8))).copy().view(np.uint64)

    def keep(i, j):
        apart = np.zeros(len(i), dtype=np.int64)
        for c in range(raw.shape[1]):
            apart += np.bitwise_count(raw[i, c] ^ raw[j, c])
        ok = (apart <= most) & (grp[i] == grp[j])
        return i[ok], j[ok]

    return keep


def _cosine(table: pa.Table, threshold: float):
    col = table.column("vec").combine_chunks()
    off = np.asarray(col.offsets)
    flat = np.asarray(col.values, dtype=np.float64)
    dim = int(off[1] - off[0]) if len(off) > 1 else 0
    same = len(off) > 1 and (np.diff(off) == dim).all()
    mat = flat[off[0]:off[-1]].reshape(-1, dim) if same else None
    rows = None if same else [flat[a:z] for a, z in zip(off, off[1:])]
    norm = np.sqrt((mat * mat).sum(1)) if same else np.array([math.sqrt(r @ r) for r in rows])
    grp = table.column("component").to_numpy()

    def link(i, j):
        good = np.zeros(len(i), dtype=bool)
        step = max(1, (1 << 20) // max(dim, 1))
        for a in range(0, len(i), step):
            x, y = i[a:a + step], j[a:a + step]
            dot = (np.einsum("ij,ij->i", mat[x], mat[y]) if same
                   else np.array([rows[p] @ rows[q] if len(rows[p]) == len(rows[q]) else -math.inf for p, q in zip(x, y)]))
            good[a:a + step] = (dot / (norm[x] * norm[y]) >= threshold) & (grp[x] == grp[y])
        return i[good], j[good]

    return link


def embedding_near_dups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        threshold: float = 0.93, miss: float = 1e-6) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null and their cosine is at least ``threshold``. Vectors that
    are null, empty, zero or hold null or non-finite components link with nothing and are kept. Equal vectors of a
    label (repeated rows too) link with each other. Rows with a null id take part; their component's id is the
    least id that is not null. Other columns are ignored.
    """
    v = numbered(vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"),
                                F.col(label_col).alias("label")), "vecdup-rows")
    inf = F.lit(float("inf"))
    usable = (F.col("label").isNotNull() & F.col("vec").isNotNull()
              & F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)), F.lit(False))
              & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False)))
    valid = v.where(usable).select("node", "vec", F.xxhash64(F.col("label").cast("string"), F.size("vec")).alias("grp"),
                                   F.sha2(F.to_json(F.struct(F.transform("vec", lambda x: x + 0.0).alias("v"))), 256).alias("same"))
    classes, _ = stored(valid.groupBy("grp", "same").agg(F.min("node").alias("rep"), F.count("*").alias("weight")), "vecdup-classes")
    reps, _ = stored(valid.select("node", "vec", "grp").join(
        classes.select(F.col("rep").alias("node"), "weight"), "node"), "vecdup-reps")
    most = reps.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(most, threshold, miss)
    signed, _ = stored(reps.select("node", "grp", "vec").mapInArrow(
        lambda it: sign_batches(it, bits, tables), "node long, sig binary, keys array<long>"), "vecdup-sigs")

    keyed = signed.join(reps.select("node", "grp"), "node").select("node", "grp", "sig", F.explode("keys").alias("key"))
    shared = signed.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    unit = ["key", "lo", "hi"]
    units = block_units(keyed.join(shared, "key"), ["key"], F.ceil(F.col("m") / BUCKET_ROWS)).select(*unit, "b", "node", "grp", "sig")
    total, rate = bits * tables, math.acos(threshold) / math.pi
    limit = math.ceil(total * rate + 6 * math.sqrt(total * rate * (1 - rate)))
    edges = units.mapInArrow(lambda it: root_edges(it, unit, lambda t: _near(t, limit)), "a long, b long")

    clusters, _ = stored(connected_components(edges), "vecdup-clusters")
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    unit2 = ["component", "lo", "hi"]
    joined = reps.join(small(clusters), "node").join(sizes, "component")
    verified = block_units(joined, ["component"], F.col("blocks")).select(*unit2, "b", "node", "weight", "vec")
    found, _ = stored(verified.mapInArrow(lambda it: linked_rows(it, unit2, lambda t: _cosine(t, threshold)),
                                          "a long, b long, links long"), "vecdup-links")

    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    comps = connected_components(found.select("a", "b")).withColumnRenamed("node", "rep")
    named = valid.select("node", "grp", "same").join(classes, ["grp", "same"]).select("node", "rep", "weight")
    m = (v.select("node", "vec_id").join(named, "node", "left")
         .withColumn("rep", F.coalesce("rep", "node")).withColumn("weight", F.coalesce("weight", F.lit(1)))
         .join(links, "rep", "left").join(comps, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    least = m.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return m.join(least, "component").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
