"""Pluggable models (generator, encoder, detector, judge) and the cached evaluation run."""
import numpy as np
from pyspark.sql import functions as F

from tessera.operators import evaluate as EV
from tessera.operators import generate as G
from tessera.operators.embed import embed
from tessera.operators.language import detect_language, train_profile
from tessera.plans import rag
from tessera.session import scratch_path


def test_generate_batch_with_retrying_generator(spark):
    calls = {"n": 0}

    def flaky(prompts):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("transient")
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([(1, "q one"), (2, "q two")], "id long, prompt string").coalesce(1)
    out = dict(G.generate_batch(df, "prompt", flaky, out="answer", retries=2).select("id", "answer").collect())
    assert out == {1: "Q ONE", 2: "Q TWO"}


def test_render_prompt_keeps_braces_in_data(spark):
    df = spark.createDataFrame([("a {question} b", "what?")], "context string, question string")
    got = df.select(G.render_prompt(G.BASE_PROMPT, context="context", question="question")).first()[0]
    assert got == G.BASE_PROMPT.replace("{context}", "a {question} b").replace("{question}", "what?", 1) \
        or got == G.BASE_PROMPT.format(context="a {question} b", question="what?")


def test_user_encoder(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abcd")], "id long, text string")
    out = embed(df, "text", encoder=lambda xs: np.array([[len(x), 1.0] for x in xs])).orderBy("id").collect()
    assert [list(r["embedding"]) for r in out] == [[2.0, 1.0], [4.0, 1.0]]


def test_user_detector_and_native_profile(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 3,
                                  "text string, lang string")
    prof = train_profile(train)
    df = spark.createDataFrame([(1, "the dog and the cat"), (2, "le chien"), (3, "123 !!")], "id long, text string")
    got = dict(detect_language(df, "id", "text", prof).collect())
    assert got == {1: "en", 2: "fr", 3: None}
    import pandas as pd
    custom = dict(detect_language(df, "id", "text", prof, detector=lambda s: pd.Series(["xx"] * len(s))).collect())
    assert set(custom.values()) == {"xx"}


def _small_index(spark):
    clean = spark.createDataFrame(
        [(1, "Solar power grows fast. Wind is cheap.", "en", "t1", None, None, "d", "u1", 11),
         (2, "Hydrogen storage is costly. Grids need batteries.", "en", "t2", None, None, "d", "u2", 12)],
        "row_id long, content string, language string, title string, date string, author string, domain string, "
        "url string, id long")
    chunks, vectors = rag.corpus_index(clean, 30)
    qs = spark.createDataFrame([(1, "Is solar power growing?"), (2, "Why is hydrogen storage costly?")],
                               "example_id long, question string")
    return clean, chunks, vectors, qs


def test_spot_check_and_strategies(spark):
    _, chunks, vectors, qs = _small_index(spark)
    out = rag.spot_check(qs, ["Is solar power growing?"], vectors, chunks, k=2).collect()
    assert len(out) == 1 and "Solar" in out[0]["answer"]
    for strategy in rag.STRATEGIES:
        rows = rag.rag_answers(qs, vectors, chunks, strategy, k=2).collect()
        assert len(rows) == 2


def test_run_evaluation_cached(spark):
    _, chunks, vectors, qs = _small_index(spark)
    ev = qs.withColumn("ground_truth", F.lit("Solar power grows fast.")).withColumn("best_match_id", F.lit(11).cast("long"))
    built = {"n": 0}

    def answers(df):
        built["n"] += 1
        return rag.rag_answers(df.select("example_id", "question"), vectors, chunks, "base", k=2)

    cache = scratch_path(spark, "eval-cache")
    a = EV.run_evaluation(spark, ev, answers, cache, "Experiment 1: Base", strategy="base-k2")
    b = EV.run_evaluation(spark, ev, answers, cache, "Base", strategy="base-k2")
    assert built["n"] == 1 and a.count() == b.count() == 2
    assert {"rr", "hit_at_2", "answer_correctness", "reasoning"} <= set(b.columns)


def test_judge_reasoning_with_stub_judge(spark):
    df = spark.createDataFrame([(1, "q", "a", ["c1", "c2"])], "example_id long, question string, answer string, "
                                                               "contexts array<string>")
    out = EV.judge_reasoning(df, judge=lambda ps: ["ok: " + str(len(p)) for p in ps]).first()["reasoning"]
    assert out.startswith("ok: ")


def test_factories_build_once_per_worker(spark):
    def enc_factory():
        return lambda xs: np.array([[float(len(x))] for x in xs])

    df = spark.createDataFrame([(1, "abc"), (2, "de")], "id long, text string")
    got = {r["id"]: list(r["embedding"]) for r in embed(df, "text", encoder_factory=enc_factory).collect()}
    assert got == {1: [3.0], 2: [2.0]}

    def gen_factory():
        return lambda prompts: [p[::-1] for p in prompts]

    out = dict(G.generate_batch(df, "text", generator_factory=gen_factory, out="r").select("id", "r").collect())
    assert out == {1: "cba", 2: "ed"}


def test_worker_model_cached_across_copies():
    import pickle

    from pyspark import cloudpickle

    from tessera.functions.plan import model_key, worker_model
    calls = []

    def factory():
        calls.append(1)
        return object()

    key = model_key(factory)
    a = worker_model(factory, key)
    b = worker_model(pickle.loads(cloudpickle.dumps(factory)), key)
    assert a is b and len(calls) == 1


def test_compress_contexts_with_extractor(spark):
    from tessera.operators import retrieve as R
    ctx = spark.createDataFrame([(1, 1, "Solar is cheap. Cats sleep.", "solar?"), (1, 2, "Nothing relevant.", "solar?")],
                                "question_id long, rank int, page_content string, question string")
    native = R.compress_contexts(ctx).orderBy("rank").collect()
    assert [(r["rank"], r["page_content"]) for r in native] == [(1, "Solar is cheap.")]
    upper = R.compress_contexts(ctx, extractor=lambda qs, cs: [c.upper() for c in cs]).orderBy("rank").collect()
    assert [r["page_content"] for r in upper] == ["SOLAR IS CHEAP. CATS SLEEP.", "NOTHING RELEVANT."]
