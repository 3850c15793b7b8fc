"""Driver tables and their mapping onto the reference's input shapes.

``documents`` stands in for the article table: ``row_id = doc_id``, the chunk
list is the text split on newlines, the title is the first line, the domain is
``source``. ``benchmark`` stands in for the evaluation passages.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def table_stamp(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Digest of a table's path and its files' names, sizes and times, read through Hadoop's file system."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    path = fs.makeQualified(path)
    files = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    return hashlib.sha1(repr((path.toString(), files)).encode()).hexdigest()


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ARTICLE rows (row_id, title, date, author, content array, domain, url) plus the given label."""
    d = table(spark, sf_dir, "documents")
    return articles_from_documents(d)


def articles_from_documents(d: DataFrame) -> DataFrame:
    lines = F.split(F.col("text"), "\n", -1)
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.element_at(lines, 1).alias("title"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("string").alias("author"),
        lines.alias("content"),
        F.col("source").alias("domain"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/a/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("lang").alias("label_language"),
    )


def eval_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVAL_RAW rows from ``benchmark``: the whole text of an item is its question and its passage."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(
        F.col("item_id").alias("example_id"),
        F.col("item_id").alias("question_id"),
        F.col("text").alias("question"),
        F.col("text").alias("relevant_chunk"),
        F.lit(None).cast("string").alias("article_url"),
    )
