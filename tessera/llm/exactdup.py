"""Exact deduplication by content hash with a byte comparison inside the groups (operator 11): DataFrame functions only.

Texts are equal when they are identical after each run of ASCII white space became one space. Rows are grouped by a
128-bit hash of the normalised text; a group's first row (least id, then least row number) stays. Every group of more
than one row is compared byte by byte: its texts are grouped once more by hash and text, which each task does for its
own rows before anything moves, so a group of any size sends one text per task. A hash that stands for several texts
is split by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.store import BROADCAST_ROWS, numbered, small, stored

#: Every run of white space but the single space, which is already right.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of space, tab, line feed to carriage return as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def md5_bytes(text: Column) -> Column:
    """The 128-bit content hash as 16 bytes."""
    return F.unhex(F.md5(text))


def _first() -> Column:
    """Order of the rows of a group: rows with an id by id, then by row number."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "node")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     content_hash: Callable[[Column], Column] = md5_bytes, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    keep_id is the least id of the rows with an equal text (null only if none of them has an id); exactly one row per
    group is kept, also where ids repeat or are null (the first of the stored rows then). Null texts count as empty and
    are equal to each other and to the empty text, not to a text of one space. Ids of any orderable type; other columns
    are ignored, whatever their names; an empty table gives no rows. ``content_hash`` maps the normalised text to a
    hash; results do not depend on how good it is.
    """
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col).cast("string")).alias("t"))
    rows = numbered(texts.select("id", content_hash(F.col("t")).alias("h"), F.sha2("t", 256).alias("sha")), "exact-rows")
    groups = rows.groupBy("h").agg(F.min(_first()).alias("first"), F.count("*").alias("n"))
    shared, _ = stored(groups.where("n > 1"), "exact-groups")
    mixed_hashes, _ = stored(_several_texts(texts, shared, content_hash, broadcast_rows), "exact-collisions")
    out = _report(rows, shared, "h", broadcast_rows)
    if mixed_hashes.limit(1).count():
        held = small(mixed_hashes, broadcast_rows)
        apart = numbered(texts.withColumn("h", content_hash(F.col("t"))).join(held, "h", "left_semi")
                         .select("id", "t", F.sha2("t", 256).alias("sha")), "exact-apart")
        by_text = apart.groupBy("t").agg(F.min(_first()).alias("first"), F.count("*").alias("n")).where("n > 1")
        out = (_report(rows.join(held, "h", "left_anti"), shared, "h", broadcast_rows)
               .unionByName(_report(apart, by_text, "t", broadcast_rows)))
    return out


def _several_texts(texts: DataFrame, shared: DataFrame, content_hash, broadcast_rows: int) -> DataFrame:
    """The hashes (h) under which more than one text was found, of those that several rows share."""
    keys = small(shared.select("h"), broadcast_rows)
    found = (texts.select(content_hash(F.col("t")).alias("h"), "t").join(keys, "h", "left_semi")
             .groupBy("h", "t").agg(F.count("*").alias("copies")))
    return found.groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1").select("h")


def _report(rows: DataFrame, shared: DataFrame, key: str, broadcast_rows: int) -> DataFrame:
    """The rows with their group's first row; a row whose key no other row has is its own group.

    If the groups are too many to broadcast, those of more than a ``broadcast_rows``-th of all rows (fewer than
    ``broadcast_rows`` groups, whatever the table) are, so that a hot group's rows stay where they are; the rows of
    the others meet their group in a join on the key.
    """
    named = shared.select(F.col(key).alias("k"), "first", "n")
    on = F.col(key) == F.col("k")
    if shared.count() <= broadcast_rows:
        return _shape(rows.join(F.broadcast(named), on, "left"))
    large = F.col("n") > rows.count() // broadcast_rows
    hot = rows.join(F.broadcast(named.where(large)), on, "left")
    rest = hot.where("n IS NULL").drop("k", "first", "n").join(named.where(~large), on, "left")
    return _shape(hot.where("n IS NOT NULL")).unionByName(_shape(rest))


def _shape(found: DataFrame) -> DataFrame:
    alone = F.col("n").isNull()
    return found.select(
        F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first.node") == F.col("node"))).alias("kept"), F.col("sha").alias("text_sha256"))
