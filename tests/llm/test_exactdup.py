"""Exact deduplication against a dictionary of texts."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm.exactdup import exact_duplicates

ROWS = [(5, "a b"), (3, "a  b"), (9, "a\t\n b"), (4, " a b"), (8, None), (7, ""), (2, " "), (6, " a b"), (1, "A b"),
        (10, "long " * 30000), (12, "long \r\n" * 30000), (11, "é\x0bé"), (13, "é é")]


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return sorted((i, min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest())
                  for t, ids in groups.items() for i in ids)


def got(df):
    assert df.columns[:5] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bits", [None, 1, 0])
@pytest.mark.parametrize("broadcast_rows", [200_000, 1])
def test_equals_plain_groups(spark, bits, broadcast_rows):
    """With the real hash, and with hashes of one bit and none, where nearly all texts collide."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    how = {} if bits is None else {"content_hash": lambda t: F.xxhash64(t) % F.lit(1 << bits)}
    assert got(exact_duplicates(docs, broadcast_rows=broadcast_rows, **how)) == plain(ROWS)


def test_one_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same  text")
                                    .otherwise(F.concat(F.lit("own "), F.col("id").cast("string"))).alias("text"))
    rows = [tuple(r) for r in docs.collect()]
    assert got(exact_duplicates(docs, broadcast_rows=2)) == plain(rows)


def test_null_and_repeated_ids_keep_one_row(spark):
    docs = spark.createDataFrame([(None, "x"), (None, "x"), (4, "x"), (4, "x"), (None, "y"), (None, "y"), (None, "z")],
                                 "doc_id long, text string")
    out = exact_duplicates(docs).collect()
    assert len(out) == 7
    kept = sorted(((r["keep_id"], r["group_size"]) for r in out if r["kept"]), key=str)
    assert kept == [(4, 4), (None, 1), (None, 2)]
    assert all(r["doc_id"] == 4 for r in out if r["kept"] and r["group_size"] == 4)


def test_text_ids_clashing_columns_and_no_rows(spark):
    docs = spark.createDataFrame([("b", "t", 1, "u"), ("a", "t", 2, "v")], "name string, body string, h int, node string")
    docs = docs.withColumnsRenamed({"node": "kept"}).withColumn("n", F.lit(0)).withColumn("first", F.lit(0))
    out = exact_duplicates(docs, id_col="name", text_col="body").collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in out) == [("a", "a", True), ("b", "a", False)]
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
