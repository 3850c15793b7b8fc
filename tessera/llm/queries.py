"""The registered queries opN_<name>: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import sql
from tessera.llm.decontam import find_leaks
from tessera.llm.divergence import source_divergence
from tessera.llm.exactdup import exact_duplicates
from tessera.llm.htmlcut import extract_pages
from tessera.llm.lengths import length_histogram, token_lengths
from tessera.llm.licenses import scan_licenses
from tessera.llm.mixing import mix_plan
from tessera.llm.ngramjoin import link_report, ngram_jaccard_join
from tessera.llm.phrases import collocations
from tessera.llm.quality import quality_scores
from tessera.llm.shards import write_shards
from tessera.llm.toxicity import toxicity_scores
from tessera.llm.vecdup import embedding_near_dups
from tessera.session import ensure_checkpoint_dir, ship_package
from tessera.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op2_embedding_near_dedup": sql.EMBEDDINGS, "op4_mixing": sql.MIXING, "op8_license_scan": sql.LICENSES,
                          "op10_ngram_jaccard_join": sql.NGRAMS, "op11_exact_dedup": sql.EXACT,
                          "op12_source_divergence": sql.DIVERGENCE, "op13_phrase_mining": sql.COLLOCATIONS}


def query(fn):
    """Register ``fn`` under its name; the package is shipped and the shared folder set before it runs."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_embedding_near_dedup(spark, sf_dir):
    return embedding_near_dups(table(spark, sf_dir, "embeddings"))


@query
def op3_token_shards(spark, sf_dir):
    return write_shards(table(spark, sf_dir, "documents"))["index"]


@query
def op4_mixing(spark, sf_dir):
    return mix_plan(table(spark, sf_dir, "documents")).drop("source")


@query
def op5_html_extraction(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages"))


def quality_sites() -> dict:
    """The documents table has no URL: the source is the host, a source's language section the path."""
    return {"host": F.col("source"), "path": F.concat_ws("/", "source", "lang")}


@query
def op6_quality(spark, sf_dir):
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), **quality_sites())["scores"]
    return scores.select("doc_id", "p", "host_posterior", "path_posterior", "score", "keep")


@query
def op7_toxicity(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark, sf_dir):
    return length_histogram(token_lengths(table(spark, sf_dir, "documents")))


@query
def op10_ngram_jaccard_join(spark, sf_dir):
    return link_report(ngram_jaccard_join(table(spark, sf_dir, "documents"))).drop("node")


@query
def op11_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"))


@query
def op13_phrase_mining(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
