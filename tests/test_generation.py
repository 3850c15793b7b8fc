"""Generation log, bounded concurrency and time limits, judged verdicts, test-set questions."""
import json
import os
import threading
import time
import types

import pytest
from pyspark.sql import functions as F

from tessera.operators import generate as G
from tessera.operators import judge as J
from tessera.operators.testset import generate_testset


def _counting(folder, answer=str.upper):
    """A generator that leaves one file per call of a prompt."""
    def run(prompts):
        import uuid
        for p in prompts:
            os.makedirs(f"{folder}/{p}", exist_ok=True)
            open(f"{folder}/{p}/{uuid.uuid4().hex}", "w").close()
        return [answer(p) for p in prompts]
    return run


def _calls(folder):
    return {p: len(os.listdir(f"{folder}/{p}")) for p in sorted(os.listdir(folder))}


def _prompts(spark, names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, prompt string")


def test_equal_and_logged_prompts_are_asked_once(spark, tmp_path):
    seen, log = str(tmp_path / "seen"), str(tmp_path / "log")
    df = _prompts(spark, ["a", "b", "a", "c", "b"])
    out = G.generate_batch(df, "prompt", _counting(seen), log=log, batch_rows=2)
    assert [r.answer for r in out.orderBy("id").collect()] == ["A", "B", "A", "C", "B"] and out.count() == 5
    more = _prompts(spark, ["c", "d", None])
    got = G.generate_batch(more.na.drop(), "prompt", _counting(seen), log=log).orderBy("id").collect()
    assert [r.answer for r in got] == ["C", "D"]
    assert _calls(seen) == {"a": 1, "b": 1, "c": 1, "d": 1}
    other = G.generate_batch(df.limit(1), "prompt", _counting(seen, str.lower), log=log, model="other").first()
    assert other.answer == "a" and _calls(seen)["a"] == 2  # another model's answers are its own


def test_answers_before_a_lost_task_are_kept(spark, tmp_path):
    """A worker dies on one prompt; the job fails, but no prompt that was answered is asked again."""
    seen, log = str(tmp_path / "seen"), str(tmp_path / "log")
    names = [f"p{i}" for i in range(12)]

    def deadly(prompts, good=_counting(seen)):
        if "p7" in prompts:
            time.sleep(4)  # the other tasks end first
            os._exit(1)
        return good(prompts)

    with pytest.raises(Exception):
        G.generate_batch(_prompts(spark, names), "prompt", deadly, log=log, batch_rows=1).collect()
    before = _calls(seen)
    assert "p7" not in before and len(before) >= 6
    out = G.generate_batch(_prompts(spark, names), "prompt", _counting(seen), log=log, batch_rows=1)
    assert sorted(r.answer for r in out.collect()) == sorted(n.upper() for n in names)
    assert _calls(seen) == {n: 1 for n in names}


def test_one_bad_prompt_does_not_take_others(spark, tmp_path):
    def picky(prompts):
        if "bad" in prompts:
            raise ValueError("no")
        return [p.upper() for p in prompts]

    df = _prompts(spark, ["a", "bad", "c"]).coalesce(1)
    for log in (None, str(tmp_path / "log")):
        got = G.generate_batch(df, "prompt", picky, retries=0, on_error="null", log=log).orderBy("id").collect()
        assert [r.answer for r in got] == ["A", None, "C"]
        with pytest.raises(Exception, match="no answer"):
            G.generate_batch(df, "prompt", picky, retries=0, log=log).collect()
    assert {r.answer for r in G.logged_answers(spark, str(tmp_path / "log")).collect()} == {"A", "C"}


def test_window_keeps_order_and_its_bound():
    lock, now, most = threading.Lock(), [0], [0]

    def slow(prompts):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05 * (5 - int(prompts[0]) % 5))
        with lock:
            now[0] -= 1
        return prompts

    taken = []

    def source():
        for i in range(20):
            taken.append(i)
            yield [str(i)]

    out = []
    for texts, error in G._Bounded(slow, workers=4).run(source()):
        out += texts
        assert error is None and len(taken) - len(out) <= 4  # nothing is read ahead of the window
    assert out == [str(i) for i in range(20)] and 2 <= most[0] <= 4


def test_time_limits_retries_and_waits(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(G, "time", types.SimpleNamespace(sleep=waits.append))
    stop = threading.Event()

    def hangs(prompts):
        calls.append(prompts)
        if len(calls) < 3:
            stop.wait(30)
        return ["late"]

    assert G._Bounded(hangs, timeout=0.1, retries=3, max_wait=1)._call(["x"]) == (["late"], None)
    assert waits == [1, 1]
    bounded = G._Bounded(lambda p: stop.wait(30), timeout=0.05, retries=9, max_wait=4, most_hanging=3)
    with pytest.raises(G._TooManyHanging):
        bounded._call(["x"])
    stop.set()
    texts, error = G._Bounded(lambda p: p * 2, retries=1)._call(["a"])
    assert texts == [None] and "2 answers" in error


def test_concurrent_generation_in_a_plan(spark):
    def slow(prompts):
        begun = time.time()
        time.sleep(0.5)
        return [f"{p} {begun}" for p in prompts]

    df = spark.range(16).select("id", F.col("id").cast("string").alias("prompt")).coalesce(1)
    got = [(r.id, *r.answer.split()) for r in G.generate_batch(df, "prompt", slow, batch_rows=1, workers=16, timeout=20).collect()]
    assert [(i, p) for i, p, _ in got] == [(i, str(i)) for i in range(16)]
    begun = [float(t) for _, _, t in got]
    assert max(begun) - min(begun) < 16 * 0.5 / 2  # one after the other the last would begin 7.5 s after the first


def _dataset(spark):
    rows = [(1, "who?", "Ann did it. Bob too.", "Ann did it. Cid saw.", ["c1 useful", "c2", "c3 useful"], [1, 2, 3], 1, None),
            (2, "why?", "I do not know.", "Because.", ["c2"], [2], 1, None),
            (3, "broken", "x", "y", [], [], 1, None)]
    return spark.createDataFrame(rows, "example_id long, question string, answer string, ground_truth string, contexts array<string>, "
                                       "contexts_origin_doc_ids array<long>, best_match_id long, question_complexity string")


def _judge():
    def reply_to(prompts):
        """Replies well, but not at once, wrapped in words, and never for the example 'broken'."""
        out = []
        for p in prompts:
            if "Answer: x\n" in p or "Text: y" in p:
                reply = "I would rather not."
            elif "single statements" in p:
                reply = json.dumps({"TP": ["Ann did it"], "FP": ["Bob too"], "FN": ["Cid saw"]} if "who?" in p else {"TP": [], "FP": [], "FN": ["Because"]})
                if "did not have the form" not in p:
                    reply = reply[:-3]  # cut off; right when asked again
            elif "noncommittal" in p:
                reply = json.dumps({"question": "who?", "noncommittal": int("do not know" in p)})
            elif "useful for arriving" in p:
                reply = json.dumps({"verdict": int("useful\n" in p)}) if "c3" not in p or "number 2" in p else '{"verdict": 7}'
            elif "named entities" in p:
                reply = "Here: " + json.dumps({"entities": ["Ann", "Cid", "ANN "]} if "Cid" in p else {"entities": ["ann"]}) + " done"
            else:
                reply = "a reason"
            out.append(reply)
        return out
    return reply_to


def test_judged_metrics_by_hand(spark, tmp_path):
    out = {r.example_id: r for r in J.score_with_judge(_dataset(spark), _judge(), options={"log": str(tmp_path / "log"), "workers": 2}).collect()}
    sim = out[1].answer_similarity
    assert out[1].answer_correctness == pytest.approx(0.75 * 1 / (1 + 0.5 * 2) + 0.25 * sim, abs=1e-6)
    assert out[2].answer_correctness == pytest.approx(0.25 * out[2].answer_similarity, abs=1e-6)
    assert out[3].answer_correctness is None and out[3].answer_relevancy is None and out[3].context_entity_recall is None
    assert out[1].answer_relevancy == pytest.approx(1.0) and out[2].answer_relevancy == 0.0  # noncommittal
    assert out[1].context_precision == pytest.approx((1 + 2 / 3) / 2, abs=1e-6)
    assert out[2].context_precision == 0.0 and out[3].context_precision == 0.0
    assert out[1].context_entity_recall == 0.5 and out[1].reasoning == "a reason" and out[1].rr == 1.0


def test_rejected_replies_are_asked_again_a_bounded_number_of_times(spark, tmp_path):
    seen = tmp_path / "seen"

    def never(prompts):
        with open(seen, "a") as f:
            f.write("x" * len(prompts))
        return ["{}" for _ in prompts]

    df = spark.createDataFrame([(1, "p"), (2, "q")], "id long, prompt string")
    got = J.judged(df, "prompt", never, "verdict int", lambda r: r["verdict"].isNotNull(), rounds=3)
    assert [r.reply for r in got.collect()] == [None, None] and len(seen.read_text()) == 6


def test_verdict_rows(spark):
    rows = J.correctness_verdicts(_dataset(spark), _judge()).collect()
    assert sorted((r.example_id, r.verdict, r.statement) for r in rows) == [
        (1, "FN", "Cid saw"), (1, "FP", "Bob too"), (1, "TP", "Ann did it"), (2, "FN", "Because")]


def test_quotas_are_met_although_the_critic_refuses_half(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"Document {i} has a text. It goes on.") for i in range(8)] + [(8, None), (9, " ")], "k long, t string")

    def writer(prompts):
        return [("Why and how " if "several steps" in p else "What joins " if "both texts" in p else "It is so" if p.startswith("Answer") else "What is in ")
                + p.split("Text: ")[1][:11] for p in prompts]

    def critic(prompts):
        with open(tmp_path / "critic", "a") as f:
            f.write("x" * len(prompts))
        return [json.dumps({"verdict": int(p.split("Text: Document ")[1][0]) % 2}) for p in prompts]

    out = generate_testset(docs, "k", "t", n=12, n_docs=8, generator=writer, critic=critic, rounds=12).collect()
    kinds = [r.kind for r in out]
    assert (kinds.count("simple"), kinds.count("reasoning"), kinds.count("multi_context")) == (6, 3, 3)
    assert all(r.doc % 2 == 1 for r in out) and len({r.slot for r in out}) == 12
    assert all(r.question.startswith({"simple": "What is in", "reasoning": "Why and how", "multi_context": "What joins"}[r.kind]) for r in out)
    assert all(len(r.contexts) == (2 if r.kind == "multi_context" else 1) and (r.second_doc is None) == (r.kind != "multi_context") for r in out)
    assert len((tmp_path / "critic").read_text()) > 12 and max(r["round"] for r in out) > 0
    none = generate_testset(docs, "k", "t", n=4, generator=writer, critic=lambda ps: ['{"verdict": 0}'] * len(ps), rounds=2)
    assert none.collect() == []
    with pytest.raises(ValueError):
        generate_testset(docs, "k", "t", generator=writer)


def test_default_questions_refill(spark):
    docs = spark.createDataFrame([(1, "Hm. Not enough."), (2, "A long enough first sentence is here. Second.")], "k long, t string")
    out = generate_testset(docs, "k", "t", n=8, distribution={"simple": 0.5, "reasoning": 0.5}, rounds=12).collect()
    assert len(out) == 8 and {r.doc for r in out} == {2} and max(r["round"] for r in out) > 0
    assert {r.ground_truth for r in out} == {"A long enough first sentence is here."}
    assert generate_testset(docs.limit(0), "k", "t", n=3).collect() == []
