"""Plan-shape assertions: native operators stay in the JVM, filters and pruning reach the scan."""
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import chunk as E
from tessera.operators import profile as P
from tessera.sources.tables import table

PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_operators_have_no_python(spark, sf_small):
    d = table(spark, sf_small, "documents")
    native = [
        P.column_profile(d),
        P.histogram(d, "n_chars", 50),
        d.select(tx.strip_special("text"), tx.strip_tags("text"), tx.content_id("text"), tx.word_count("text")),
        d.select(F.col("doc_id").alias("row_id"), F.split("text", "\n").alias("content")).select(
            tx.parse_list_literal(tx.to_list_literal("content"))),
    ]
    for df in native:
        plan = _plan(df)
        assert not any(n in plan for n in PYTHON_NODES), plan


def test_filter_and_projection_reach_parquet_scan(spark, sf_small):
    d = table(spark, sf_small, "documents").where(F.col("lang") == "en").select("doc_id", tx.strip_special("text"))
    plan = _plan(d)
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan


def test_fixed_chunk_is_native(spark, sf_small):
    d = table(spark, sf_small, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("doc_id").alias("id"), F.col("text").alias("content"),
        *[F.lit(None).cast("string").alias(c) for c in ("url", "domain", "title", "author", "date")])
    assert not any(n in _plan(E.fixed_chunk(d, 200, 20)) for n in PYTHON_NODES)


def test_detection_udf_evaluated_once(spark, sf_small):
    from tessera.operators import clean as C
    from tessera.operators.language import train_profile
    from tessera.sources.tables import articles
    prof = train_profile(table(spark, sf_small, "documents"))
    clean = C.clean_corpus(articles(spark, sf_small), prof)
    # detection runs while the cleaned rows are written, once; what is left of the plan reads them
    assert "ArrowEvalPython" not in _plan(clean) and all("/cleaned-" in f for f in clean.inputFiles())
