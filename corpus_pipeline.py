"""A training corpus from the documents table: filter, deduplicate, decontaminate, mix, write shards.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the
columns of ``documents``. ``run`` applies them to ``documents``, each result written as Parquet and read again.
"""

from __future__ import annotations

import functools
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tessera.llm.decontam import decontaminate  # noqa: E402
from tessera.llm.mixing import mixed  # noqa: E402
from tessera.llm.ngramjoin import keep_one_of_each_group  # noqa: E402
from tessera.llm.quality import keep_good  # noqa: E402
from tessera.llm.queries import quality_sites  # noqa: E402
from tessera.llm.shards import write_shards  # noqa: E402
from tessera.llm.store import drop_table, stored, watching  # noqa: E402
from tessera.session import ensure_checkpoint_dir, ship_package  # noqa: E402
from tessera.sources.tables import table  # noqa: E402

#: Classifier, joins and tokenizers have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


#: Rows per Arrow batch between the JVM and Python: whole texts are large rows.
BATCH_ROWS = "2000"
#: Intermediate tables of the stage that ran last; its result is written before the next stage begins.
_left: list[str] = []


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _stage(fn):
    """Make ready, delete what the stage before left, and note what this one leaves."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _ready(spark)
        while _left:
            drop_table(spark, _left.pop())
        with watching() as paths:
            out = fn(spark, docs, sf_dir)
        _left.extend(paths)
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"), **quality_sites())


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one_of_each_group(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixed(docs)


@_stage
def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in training order as binary shards; one row per document with its place in them."""
    return write_shards(docs)["index"]


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("token_shards", token_shards)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
