"""Test-set questions (G18): a chain of generation steps per slot, filtered by a critic and refilled in bounded rounds.

``allocate_testset`` says how many questions of each kind there are. Here every slot gets a question: a seed question
from its document, evolved by its kind (reasoning: one that needs several steps; multi_context: one that needs a second
document), with its answer. A critic accepts or refuses it; refused slots go into the next round with another document.
The work table (slots still open) is written after each round, so a lost executor costs one round's step at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.plan import attach_scalars, write_through
from tessera.operators.compare import DEFAULT_DISTRIBUTION, quotas
from tessera.operators.generate import generate_batch, render_prompt, sentences
from tessera.operators.judge import judged

SEED_PROMPT = "Write one question that the text answers. Reply with the question only.\nText: {context}\nQuestion:"
EVOLVE_PROMPTS = {
    "reasoning": ("Rewrite the question so that answering it takes several steps of reasoning over the text. "
                  "Reply with the question only.\nQuestion: {question}\nText: {context}\nRewritten question:"),
    "multi_context": ("Rewrite the question so that answering it takes both texts. Reply with the question only.\n"
                      "Question: {question}\nText: {context}\nSecond text: {second}\nRewritten question:"),
}
ANSWER_PROMPT = "Answer the question from the text only.\nText: {context}\n{second}\nQuestion: {question}\nAnswer:"
CRITIC_PROMPT = ("Is the question clear, and does the text answer it without anything else? Reply with JSON only: "
                 '{"verdict": 1} or {"verdict": 0}\nQuestion: {question}\nText: {context}\n{second}\n')
#: The default chain: words of a topic, and characters that it must have to be accepted.
TOPIC_WORDS, LEAST_TOPIC = 8, 10


def topic(text: str | Column) -> Column:
    """The first words of the text's first sentence (default chain)."""
    first = F.element_at(sentences(text), 1)
    return F.array_join(F.slice(F.split(first, " "), 1, TOPIC_WORDS), " ")


def _pick(seed: int, round_no: int) -> Column:
    """32 bits of a digest of seed, slot and round; round 0 picks as ``allocate_testset`` does."""
    name = F.concat(F.lit(f"{seed}:"), F.col("slot").cast("string"), F.lit("" if round_no == 0 else f":{round_no}"))
    return F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")


def _default_chain(work: DataFrame) -> DataFrame:
    one, two = topic("context"), topic("second")
    question = (F.when(F.col("kind") == "reasoning", F.concat(F.lit("Why does the text say: "), one, F.lit("?")))
                .when(F.col("kind") == "multi_context", F.concat(F.lit("What connects: "), one, F.lit(" / "), two, F.lit("?")))
                .otherwise(F.concat(F.lit("What does the text say about: "), one, F.lit("?"))))
    truth = F.concat_ws(" ", F.element_at(sentences("context"), 1), F.element_at(sentences("second"), 1))
    ok = (F.length(one) >= LEAST_TOPIC) & ((F.col("kind") != "multi_context") | (F.length(two) >= LEAST_TOPIC))
    return work.withColumn("question", question).withColumn("ground_truth", truth).withColumn("ok", F.coalesce(ok, F.lit(False)))


def _model_chain(work: DataFrame, generator: Callable, critic: Callable, options: dict) -> DataFrame:
    how = {"on_error": "null", **options}
    asked = work.withColumn("p", render_prompt(SEED_PROMPT, context="context"))
    asked = write_through(generate_batch(asked, "p", generator, out="question", **how), "testset-seed")
    prompts = {kind: render_prompt(t, question="question", context="context", second="second") for kind, t in EVOLVE_PROMPTS.items()}
    grown = asked.where(F.col("kind").isin(*prompts)).withColumn("p", F.coalesce(*(F.when(F.col("kind") == k, c) for k, c in prompts.items())))
    grown = generate_batch(grown, "p", generator, out="evolved", **how)
    asked = asked.where(~F.col("kind").isin(*prompts)).unionByName(grown.drop("question").withColumnRenamed("evolved", "question"))
    asked = asked.withColumn("p", render_prompt(ANSWER_PROMPT, context="context", second="second", question="question"))
    asked = write_through(generate_batch(asked, "p", generator, out="ground_truth", **how), "testset-answers")
    asked = asked.withColumn("p", render_prompt(CRITIC_PROMPT, context="context", second="second", question="question"))
    said = judged(asked, "p", critic, "verdict int", lambda r: r["verdict"].isin(0, 1), options=options)
    good = (F.col("reply.verdict") == 1) & (F.length(F.trim("question")) > 0) & (F.length(F.trim("ground_truth")) > 0)
    return said.withColumn("ok", F.coalesce(good, F.lit(False))).drop("p", "reply")


def generate_testset(docs: DataFrame, key: str, text: str, n: int = 10, distribution: dict[str, float] | None = None, n_docs: int = 5,
                     seed: int = 42, generator: Callable | None = None, critic: Callable | None = None, rounds: int = 8,
                     options: dict | None = None) -> DataFrame:
    """(slot, kind, doc, second_doc, question, ground_truth, contexts, round): the accepted question of every slot.

    Documents are the first ``n_docs`` in key order, as in the reference; null or empty texts are no documents. A slot
    that no round filled is left out: with a critic that accepts none there are no rows. ``options`` go to
    ``generate_batch`` (log, workers, timeout). Without a generator the default chain runs, which needs no model.
    """
    if (generator is None) != (critic is None):
        raise ValueError("a generator needs a critic, and a critic a generator")
    spark = docs.sparkSession
    first = docs.where(F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) > 0).select(F.col(key).alias("doc"), F.col(text).alias("context"))
    ranked = write_through(first.orderBy("doc").limit(n_docs).withColumn("pos", F.row_number().over(Window.orderBy("doc")) - 1), "testset-docs")
    m = ranked.agg(F.count(F.lit(1)).alias("m"))
    kinds = [k for k, c in quotas(n, distribution or DEFAULT_DISTRIBUTION) for _ in range(c)]
    open_slots = spark.createDataFrame(list(enumerate(kinds)), "slot int, kind string")
    one = F.broadcast(ranked.select("pos", "doc", "context"))
    two = F.broadcast(ranked.select(F.col("pos").alias("pos2"), F.col("doc").alias("second_doc"), F.col("context").alias("second")))
    done = None
    for i in range(rounds):
        work = attach_scalars(open_slots, m).where(F.col("m") > 0).withColumn("pos", F.pmod(_pick(seed, i), F.col("m")))
        work = work.withColumn("pos2", F.when(F.col("kind") == "multi_context", F.pmod(F.col("pos") + 1, F.col("m"))))
        work = work.join(one, "pos").join(two, "pos2", "left").select("slot", "kind", "doc", "second_doc", "context", "second")
        tried = _default_chain(work) if generator is None else _model_chain(write_through(work, "testset-work"), generator, critic, options or {})
        tried = write_through(tried.withColumn("round", F.lit(i)), "testset-round")
        good = tried.where("ok")
        done = good if done is None else done.unionByName(good)
        open_slots = write_through(open_slots.join(good.select("slot"), "slot", "left_anti"), "testset-open")
        if not open_slots.limit(1).count():
            break
    contexts = F.filter(F.array("context", "second"), lambda c: c.isNotNull())
    return done.select("slot", "kind", "doc", "second_doc", "question", "ground_truth", contexts.alias("contexts"), "round")
