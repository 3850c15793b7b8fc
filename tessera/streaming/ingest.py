"""Batched collection ingestion (A7) over a file stream.

The reference inserts chunk batches of at most 41,666 rows into a collection.
Here new Parquet files in ``source_dir`` are read as micro-batches
(``maxFilesPerTrigger``), embedded, and appended to the collection with
``foreachBatch``. The query checkpoint (below the shared checkpoint folder) lets a
restarted job resume. A batch is committed under the query's id and its number, so one
that is run again adds nothing. Rows that others added (or an earlier query whose
checkpoint was lost) are told by their chunk ids; a stream never compares with its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.operators.embed import embed
from tessera.sources.collections import MAX_BATCH, collection_append, read_collection, store_state


def ingest_chunks(spark: SparkSession, source_dir: str, schema: T.StructType, store: str, name: str,
                  checkpoint: str, encoder: Callable | None = None, files_per_batch: int = 1,
                  text: str = "page_content", available_now: bool = True):
    """Start the stream (rows have a ``chunk_id``); returns the ``StreamingQuery`` (``availableNow`` drains what exists, then stops)."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(source_dir))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}:"
        held = store_state(spark, store)[1].get(name, {"batches": []})["batches"]
        if any(b["key"] == f"{own}{batch_id}" for b in held):
            return
        new = batch
        if any(b["rows"] and not (b["key"] or "").startswith(own) for b in held):
            others = read_collection(spark, store, name, without_stream=own).select("chunk_id")
            new = batch.join(others, "chunk_id", "left_anti")
        collection_append(embed(new, text, encoder=encoder), store, name, mode="append", batch_size=MAX_BATCH, key=f"{own}{batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
