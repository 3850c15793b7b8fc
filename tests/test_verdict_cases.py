"""Repeated and NULL keys, large ids, second detection pass, answers generated once, HyDE."""
import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import evaluate as EV
from tessera.operators import language as L
from tessera.plans import rag
from tessera.sources.tables import articles, eval_passages, table


def test_detection_keeps_every_row_in_both_forms(spark, sf_small, monkeypatch):
    prof = L.train_profile(table(spark, sf_small, "documents"))
    texts = table(spark, sf_small, "documents").orderBy("doc_id").limit(4).select("text").collect()
    rows = [(1, texts[0].text), (1, texts[1].text), (None, texts[2].text), (2, None), (None, "123")]
    df = spark.createDataFrame(rows, "k long, text string")
    key = [F.col("k"), F.col("language")]
    small = sorted(map(str, L.detect_language(df, "k", "text", prof).select(*key).collect()))
    monkeypatch.setattr(L, "BROADCAST_GRAMS", -1)
    assert sorted(map(str, L.detect_language(df, "k", "text", prof).select(*key).collect())) == small and len(small) == 5


def test_clean_corpus_merges_repeated_ids_and_drops_null_ids(spark, sf_small):
    prof = L.train_profile(table(spark, sf_small, "documents"))
    rows = [(1, ["one text"], None, "a"), (1, ["two text"], "t", "b"), (None, ["three text"], "t", "c"), (2, ["one text"], "t", "d"), (3, ["four"], "t", "e")]
    art = spark.createDataFrame(rows, "row_id long, content array<string>, title string, domain string").select(
        "*", *(F.lit(None).cast("string").alias(c) for c in ("date", "author", "url")))
    out = {r.row_id: r for r in C.clean_corpus(art, prof, detector=lambda s: pd.Series(["en"] * len(s))).collect()}
    assert sorted(out) == [1, 3]
    assert sorted(out[1].content.split(" text")) == ["", " two", "one"] or sorted(out[1].content.split(" text")) == ["", " one", "two"]
    assert out[1].title == "t"


def test_second_pass_gives_a_changing_detector_another_chance(spark, tmp_path):
    marks = str(tmp_path)

    def moody(s: pd.Series) -> pd.Series:
        import os

        def one(t):
            if t is None:
                return None
            seen = os.path.exists(f"{marks}/{t}")
            open(f"{marks}/{t}", "w").close()
            return "en" if seen else "xx"

        return pd.Series([one(t) for t in s])

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, text string")
    assert sorted(r.k for r in C.filter_language(df, "k", "text", None, detector=moody).collect()) == [1, 2]


def test_answers_are_generated_once(spark, tmp_path):
    ev = spark.createDataFrame([(i, f"question {i}?", f"truth {i}.", i) for i in range(5)],
                               "example_id long, question string, ground_truth string, best_match_id long")
    log = str(tmp_path / "prompts")

    def answers(df):
        def ask(it):
            for pdf in it:
                with open(log, "a") as f:
                    f.write("x" * len(pdf))
                pdf["answer"] = pdf["question"] + " yes."
                pdf["contexts"] = [[q] for q in pdf["question"]]
                pdf["contexts_origin_doc_ids"] = [[i] for i in pdf["example_id"]]
                yield pdf[["example_id", "answer", "contexts", "contexts_origin_doc_ids"]]

        return df.select("example_id", "question").mapInPandas(
            ask, "example_id long, answer string, contexts array<string>, contexts_origin_doc_ids array<long>")

    res = EV.run_evaluation(spark, ev, answers, str(tmp_path / "cache"), "Experiment 9: once")
    assert res.count() == 5 and {r.context_precision for r in res.collect()} == {1.0}
    assert len(open(log).read()) == 5


def test_variants_of_large_ids_and_hyde(spark, sf_small):
    from tessera.functions.plan import write_through
    prof = L.train_profile(table(spark, sf_small, "documents"))
    clean = write_through(C.clean_corpus(articles(spark, sf_small), prof), "t")
    chunks, vectors = rag.corpus_index(clean, 1000)
    q = eval_passages(spark, sf_small).limit(5).select((F.col("example_id") + F.lit(2 ** 62)).alias("example_id"), "question")
    q = q.unionByName(spark.createDataFrame([(7, None)], q.schema))
    got = rag.retrieve(q, vectors, chunks, "multi_query").select("example_id").distinct().collect()
    assert len(got) == 5 and all(r.example_id >= 2 ** 62 for r in got)
    base = rag.retrieve(q, vectors, chunks, "base").select("example_id", "rank", "chunk_id").collect()
    hyde = rag.retrieve(q, vectors, chunks, "hyde").select("example_id", "rank", "chunk_id").collect()
    assert len(base) == len(hyde) == 20 and set(base) != set(hyde)
