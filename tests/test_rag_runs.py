"""Every strategy with a user's generator, ids of any type, one search for all strategies, stored collections."""
import pytest
from pyspark.sql import functions as F

from tessera.operators import chunk as E
from tessera.operators import retrieve as R
from tessera.operators.embed import collection_build
from tessera.plans import rag
from tessera.session import scratch_path
from tessera.sources import collections as coll

TEXTS = [(1, "Solar power grows fast. Wind is cheap. Panels need silicon.", 11), (2, "Hydrogen storage is costly. Grids need batteries.", 12),
         (3, "Geothermal heat is steady. Wells are deep.", 13)]


def _clean(spark):
    return spark.createDataFrame([(i, t, "en", f"t{i}", None, None, "d", f"u{i}", n) for i, t, n in TEXTS],
                                 "row_id long, content string, language string, title string, date string, author string, "
                                 "domain string, url string, id long")


def _questions(spark, ids):
    rows = [(ids[0], "Is solar power growing?"), (ids[1], "Why is hydrogen storage costly?")]
    return spark.createDataFrame(rows, f"example_id {'string' if isinstance(ids[0], str) else 'long'}, question string")


def _model(log):
    """A stub language model that writes down every prompt it gets."""
    def answer(prompts):
        out = []
        for p in prompts:
            with open(log, "a") as f:
                f.write(p.replace("\n", "|") + "\n")
            if p.startswith("You are an AI language model"):
                q = p.rsplit("Original question: ", 1)[1]
                out.append(f"{q}\nabout {q}" if "about" not in q else q)
            elif "step back" in p:
                out.append("What is energy?")
            elif "tutorial" in p:
                out.append("Hydrogen storage is costly because tanks are.")
            elif p.startswith("Copy, word for word"):
                context = p.split("Context:\n")[1]
                out.append(context.split(".")[0] + "." if "ydrogen" in context else "NO_OUTPUT")
            else:
                out.append("answer")
        return out
    return answer


@pytest.mark.parametrize("ids", [("q-a", "q-b"), (2**62, -5)])
def test_all_strategies_with_a_generator(spark, tmp_path, ids):
    chunks, vectors = rag.corpus_index(_clean(spark), 30)
    chunks, vectors = chunks.cache(), vectors.cache()
    qs = _questions(spark, ids)
    want = {"base": {"answer": 2}, "multi_query": {"variants": 2 + 4, "answer": 2}, "step_back": {"step back": 2, "answer": 2},
            "hyde": {"tutorial": 2, "answer": 2}, "compression": {"Copy": None, "answer": 2}}
    for strategy, kinds in want.items():
        log = tmp_path / strategy
        log.touch()
        rows = rag.rag_answers(qs, vectors, chunks, strategy, k=2, generator=_model(str(log))).collect()
        assert sorted(r.example_id for r in rows) == sorted(ids) and {r.answer for r in rows} == {"answer"}
        prompts = log.read_text().splitlines()
        assert sum(p.startswith("|") for p in prompts) == kinds["answer"]
        if strategy == "multi_query":  # each question once, then each of its two lines once
            assert sum(p.startswith("You are an AI") for p in prompts) == kinds["variants"]
        elif strategy == "compression":  # every retrieved context once
            assert sum(p.startswith("Copy") for p in prompts) == 4
            assert all("." in c and c.count(".") == 1 for r in rows for c in r.contexts)
        assert len(prompts) == 2 + {"base": 0, "multi_query": 6, "step_back": 2, "hyde": 2, "compression": 4}[strategy]


def test_generator_variants_are_searched(spark, tmp_path):
    chunks, vectors = rag.corpus_index(_clean(spark), 30)
    qs = _questions(spark, ("a", "b"))
    plain = rag.retrieve(qs, vectors, chunks, "base", k=1).select("example_id", "chunk_id").collect()
    both = rag.retrieve(qs, vectors, chunks, "multi_query", k=1, generator=_model(str(tmp_path / "p"))).select("example_id", "chunk_id").collect()
    assert set(plain) <= set(both)


def test_compression_with_an_extractor_through_the_strategy(spark):
    chunks, vectors = rag.corpus_index(_clean(spark), 30)
    rows = rag.retrieve(_questions(spark, (1, 2)), vectors, chunks, "compression", k=3,
                        extractor=lambda qs, cs: [c.upper() if "i" in c else "" for c in cs]).collect()
    assert rows and all(r.page_content == r.page_content.upper() for r in rows)
    assert all(sorted(r["rank"] for r in rows if r.example_id == i) == list(range(1, 1 + sum(r.example_id == i for r in rows))) for i in (1, 2))


def test_questions_under_one_id_are_ranked_apart(spark):
    chunks, vectors = rag.corpus_index(_clean(spark), 30)
    qs = spark.createDataFrame([(1, "Is solar power growing?"), (1, "Why is hydrogen storage costly?")], "example_id long, question string")
    rows = rag.rag_answers(qs, vectors, chunks, "base", k=2).collect()
    assert {r.question: len(r.contexts) for r in rows} == {"Is solar power growing?": 2, "Why is hydrogen storage costly?": 2}
    assert rag.retrieve(qs, vectors, chunks, "base", k=2).count() == 4


def test_all_runs_equal_single_runs_with_one_search(spark, monkeypatch):
    chunks, vectors = rag.corpus_index(_clean(spark), 30)
    chunks, vectors = chunks.cache(), vectors.cache()
    qs = _questions(spark, (1, 2))
    calls, plain = [], R.similarity_search
    monkeypatch.setattr(R, "similarity_search", lambda *a, **k: calls.append(1) or plain(*a, **k))
    together = rag.retrieve_runs(qs, vectors, chunks, k=2).collect()
    assert len(calls) == 2  # all first texts, and the default hypothetical documents made from their hits
    cols = ("example_id", "rank", "chunk_id", "page_content", "score")
    for s in rag.STRATEGIES:
        one = rag.retrieve(qs, vectors, chunks, s, k=2).select(*cols).collect()
        assert sorted(map(tuple, one)) == sorted(tuple(r[c] for c in cols) for r in together if r["strategy"] == s), s
    with pytest.raises(ValueError):
        rag.retrieve(qs, vectors, chunks, "unknown")


def test_retrieval_from_a_stored_collection(spark):
    store = scratch_path(spark, "stored")
    clean = _clean(spark)
    parts = E.fixed_chunk(clean, 30, 0)
    name = collection_build(parts, store, "m", "fixed30")
    assert not coll.collection_is_empty(spark, store, name)
    chunks, vectors = rag.stored_index(spark, store, name)
    fresh = rag.corpus_index(clean, 30)[::-1]
    qs = _questions(spark, (1, 2))
    for s in ("base", "step_back"):
        a = rag.retrieve(qs, vectors, chunks, s, k=3)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, rag.retrieve(qs, *fresh, s, k=3).collect()))
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(collection" in plan and "page_content" not in plan and "Python" not in plan
    coll.collection_append(parts.limit(1).withColumn("embedding", F.array(F.lit(0.0).cast("float"))), store, name, mode="replace")
    assert vectors.count() == parts.count()  # the state that was opened


def test_a_vector_of_another_length_is_named(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "question_id long, embedding array<double>")
    v = spark.createDataFrame([("good", [1.0, 0.0]), ("short", [1.0])], "chunk_id string, embedding array<double>")
    with pytest.raises(Exception, match="vector of short has not 2 values"):
        R.similarity_search(q, v, k=1).collect()
