"""Token ids in training order as fixed-stride binary shards (operator 3).

Texts are encoded and packed, per input split, into sequences of ``length`` ids (a closing id after each text, the
split's last sequence filled up with it). A first pass counts ids, so each split knows its first sequence number;
a second pass packs. A keyed Feistel permutation with cycle-walking maps sequence numbers one-to-one to slots
[0, n). Slots are cut into ranges of ``per_shard``; each range is one sorted file of records of the same size:
``length`` little-endian ids and one closing line feed. Slot s is record s % per_shard of shard s // per_shard, so a
reader resumes anywhere by arithmetic. Shards are written by Spark's own committed writer.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import batch as bt
from tessera.llm.store import stored
from tessera.llm.tokens import DEFAULT_VOCABULARY, encoder
from tessera.session import ensure_checkpoint_dir

ROUNDS = 6
#: Most input splits (a path and a few longs each) whose sequence numbers are broadcast.
MOST_SPLITS = 2_000_000


def _half_bits(n: int) -> int:
    return max(1, -(-(max(n, 2) - 1).bit_length() // 2))


def _keys(key: int) -> list[np.uint64]:
    return [np.uint64(x) for x in np.random.Generator(np.random.PCG64(key)).integers(0, 1 << 63, ROUNDS, dtype=np.uint64)]


def slots_of(seq: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slot of each sequence number: a permutation of [0, n) that depends on ``key``."""
    return _walk(seq, n, key, False)


def sequences_of(slot: np.ndarray, n: int, key: int) -> np.ndarray:
    """The sequence number in each slot (inverse of ``slots_of``)."""
    return _walk(slot, n, key, True)


def _walk(x: np.ndarray, n: int, key: int, back: bool) -> np.ndarray:
    h = np.uint64(_half_bits(n))
    mask = (np.uint64(1) << h) - np.uint64(1)
    out, todo = np.asarray(x).astype(np.uint64), np.arange(len(x))
    keys = _keys(key)
    while len(todo):
        left, right = out[todo] >> h, out[todo] & mask
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (bt.mix(left + k) & mask), left
            else:
                left, right = right, left ^ (bt.mix(right + k) & mask)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n]  # cycle-walking: again until the value is in range
    return out.astype(np.int64)


def _split_rows(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(doc_id, text, path, start): rows with the input split they are read from, in the split's order."""
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "shards-in")[0]
        id_col, text_col = "doc_id", "text"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def _runs(b: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """Ranges of a batch that come from one split."""
    path = b.column("path").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    start = b.column("start").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(path, prepend=-1) != 0) | (np.diff(start, prepend=-1) != 0)).tolist()
    for lo, hi in zip(cuts, [*cuts[1:], b.num_rows]):
        yield (b.column("path")[lo].as_py(), int(start[lo])), lo, hi


def _count_batches(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """One row per text: where its ids begin in its split, and their number with the closing id."""
    split, used = None, 0
    for b in batches:
        for own, lo, hi in _runs(b):
            if own != split:
                split, used = own, 0
            part = b.slice(lo, hi - lo)
            data, off = bt.as_bytes(part.column("text"))
            for x, y in bt.slices(off):
                n = encoder(vocabulary).counts(data[off[x]:off[y]], off[x:y + 1] - off[x]) + 1
                begin = used + np.cumsum(n) - n
                used += int(n.sum())
                piece = part.slice(x, y - x)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("path"), piece.column("start"),
                                                  pa.array(begin, pa.int64()), pa.array(n, pa.int64())],
                                                 ["doc_id", "path", "start", "begin", "n_ids"])


def _pack_batches(batches: Iterator[pa.RecordBatch], vocabulary: str, length: int, closing: int, n: int, key: int,
                  width: str) -> Iterator[pa.RecordBatch]:
    """(slot, record) of every sequence of the task's splits."""
    split, rest, number, end = None, np.zeros(0, dtype=width), 0, 0

    def records(ids, first):
        if first + len(ids) // length > end:
            raise RuntimeError("a split holds other rows than when it was counted")
        rows = np.empty((len(ids) // length, length * ids.dtype.itemsize + 1), dtype=np.uint8)
        rows[:, :-1] = np.ascontiguousarray(ids[:rows.shape[0] * length]).view(np.uint8).reshape(rows.shape[0], -1)
        rows[:, -1] = 10
        slot = slots_of(np.arange(first, first + len(rows)), n, key)
        return pa.RecordBatch.from_arrays([pa.array(slot), pa.array([r[:-1].tobytes() for r in rows], pa.binary())], ["slot", "record"])

    def close():
        return records(np.concatenate([rest, np.full(-len(rest) % length, closing, dtype=width)]), number)

    for b in batches:
        for own, lo, hi in _runs(b):
            if own != split:
                if len(rest):
                    yield close()
                split, rest = own, np.zeros(0, dtype=width)
                number = b.column("first")[lo].as_py()
                end = number + b.column("sequences")[lo].as_py()
            data, off = bt.as_bytes(b.column("text").slice(lo, hi - lo))
            for x, y in bt.slices(off):
                ids, at = encoder(vocabulary).encode(data[off[x]:off[y]], off[x:y + 1] - off[x])
                size = np.diff(at)
                out = np.full(len(ids) + len(size), closing, dtype=width)
                out[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size)] = ids
                rest = np.concatenate([rest, out])
                if whole := len(rest) // length:
                    yield records(rest[:whole * length], number)
                    number, rest = number + whole, rest[whole * length:]
    if len(rest):
        yield close()


def write_shards(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
                 per_shard: int = 16384, key: int = 1, vocabulary: str = DEFAULT_VOCABULARY, closing: int = 50256,
                 width: str = "<u2") -> dict:
    """Write all texts as shards and return path, length, per_shard, key, stride, sequences and ``index``.

    ``index`` has one row per input row: doc_id, n_ids (closing id included), sequence and position of its first id,
    n_sequences it touches, and slot, shard, byte_offset and file path of the first. Null and empty texts are one closing
    id. Ids may be of any type. Repeated rows are written each time; an empty table writes no shard (sequences 0). Other
    columns are ignored.

    Shards stay when the session ends. Without ``path`` they lie in a new folder below the shared checkpoint folder.
    Beside them is a manifest, from which ``open_shards`` lets a later session read them.
    """
    spark = docs.sparkSession
    path = path or os.path.join(ensure_checkpoint_dir(spark), f"shards-{uuid.uuid4().hex[:12]}")
    rows = _split_rows(docs, text_col, id_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    index, _ = stored(rows.mapInArrow(lambda it: bt.tidy(_count_batches(it, vocabulary)),
                                      f"doc_id {kind}, path string, start long, begin long, n_ids long"), "shards-index")
    splits = index.groupBy("path", "start").agg(F.ceil(F.max(F.col("begin") + F.col("n_ids")) / length).alias("sequences"))
    order = Window.orderBy("path", "start")
    splits, _ = stored(splits.withColumn("first", F.sum("sequences").over(order) - F.col("sequences")), "shards-splits")
    n_splits, n = splits.agg(F.count("*"), F.coalesce(F.sum("sequences"), F.lit(0))).first()
    if n_splits > MOST_SPLITS:
        raise ValueError(f"{n_splits} input splits; read the input in larger splits")
    itemsize = np.dtype(width).itemsize
    stride, shards = length * itemsize + 1, -(-n // per_shard)
    if n:
        packed = rows.drop("doc_id").join(F.broadcast(splits), ["path", "start"]).mapInArrow(
            lambda it: bt.tidy(_pack_batches(it, vocabulary, length, closing, n, key, width)), "slot long, record binary")
        shard = F.floor(F.col("slot") / per_shard).cast("int")
        (packed.withColumn("shard", shard).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot")
         .select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\n").text(path))

    def place(batches):
        for b in batches:
            yield b.append_column("slot", pa.array(slots_of(b.column("sequence").to_numpy(), n, key), pa.int64()))

    seq = F.col("first") + F.floor(F.col("begin") / length)
    placed = (index.join(F.broadcast(splits), ["path", "start"])
              .select("doc_id", "n_ids", seq.alias("sequence"), (F.col("begin") % length).alias("position"),
                      (F.floor((F.col("begin") + F.col("n_ids") - 1) / length) - F.floor(F.col("begin") / length) + 1).alias("n_sequences")))
    placed = placed.mapInArrow(place, f"doc_id {kind}, n_ids long, sequence long, position long, n_sequences long, slot long")
    out = placed.withColumn("shard", F.floor(F.col("slot") / per_shard)).withColumn(
        "byte_offset", (F.col("slot") % per_shard) * stride + F.col("position") * itemsize).withColumn(
        "path", F.concat(F.lit(f"{path}/shard="), F.col("shard").cast("string")))
    manifest = {"path": path, "length": length, "per_shard": per_shard, "key": key, "stride": stride, "sequences": n, "width": width,
                "vocabulary": vocabulary, "closing": closing}
    # written last: shards with a manifest are whole
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}-manifest")
    return {**manifest, "index": out}


def open_shards(spark: SparkSession, path: str) -> dict:
    """What ``write_shards`` returned but the index, read from the manifest beside the shards: for ``read_slots``."""
    return json.loads(spark.read.text(f"{path}-manifest").first()["value"])


def read_slots(spark: SparkSession, shards: dict, first: int = 0, count: int | None = None) -> DataFrame:
    """(slot, ids) in any range of slots: only the shards that hold the range are opened."""
    last = shards["sequences"] if count is None else min(shards["sequences"], first + count)
    schema = "slot long, ids array<long>"
    if last <= first:
        return spark.createDataFrame([], schema)
    per, stride, width = shards["per_shard"], shards["stride"], shards["width"]
    wanted = [f"{shards['path']}/shard={s}" for s in range(first // per, (last - 1) // per + 1)]
    files = (spark.read.format("binaryFile").load(wanted)
             .select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("long").alias("shard"), "content"))

    def cut(batches):
        for b in batches:
            for s, data in zip(b.column("shard").to_pylist(), b.column("content").to_pylist()):
                lo, hi = max(first - s * per, 0), min(last - s * per, len(data) // stride)
                rows = np.frombuffer(data, dtype=np.uint8).reshape(-1, stride)[lo:hi, :-1].copy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(s * per + lo, s * per + hi)), pa.array(list(rows.view(width).astype(np.int64)), pa.list_(pa.int64()))],
                    ["slot", "ids"])

    return files.mapInArrow(cut, schema)
