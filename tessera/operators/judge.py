"""Judged metrics (G5-G8): a language model's structured replies as verdict tables.

A judge answers in JSON. Replies are parsed against a schema by Spark and checked by a condition; rows whose reply does
not pass are asked again in a bounded number of rounds, and stay NULL after the last (the metric is NULL then, as a
judge that failed). Every verdict is a row, and the metrics are the formulas of ``evaluate.py`` over these rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.plan import write_through
from tessera.operators import evaluate as EV
from tessera.operators.embed import DIM, hashed_embedding
from tessera.operators.generate import generate_batch, render_prompt

CORRECTNESS_PROMPT = (
    "Break the answer and the reference into single statements and sort them: TP statements of the answer that the "
    "reference supports, FP statements of the answer that it does not support, FN statements of the reference that the "
    'answer lacks. Reply with JSON only: {"TP": [..], "FP": [..], "FN": [..]}\nQuestion: {question}\nAnswer: {answer}\n'
    "Reference: {reference}\n")
RELEVANCY_PROMPT = (
    "Write a question that the answer answers, and say whether the answer is noncommittal (1 if it is evasive, vague or "
    'says that it does not know, else 0). Reply with JSON only: {"question": "..", "noncommittal": 0}\n'
    "Question number {number}.\nAnswer: {answer}\n")
PRECISION_PROMPT = (
    "Was the context useful for arriving at the answer? Reply with JSON only: "
    '{"verdict": 1} or {"verdict": 0}\nQuestion: {question}\nContext: {context}\nAnswer: {answer}\n')
ENTITIES_PROMPT = (
    "List the distinct named entities of the text. Reply with JSON only: "
    '{"entities": [..]}\nText: {text}\n')
AGAIN = "\nYour reply number {round} did not have the form asked for. Reply with that JSON and nothing else.\n"


def judged(df: DataFrame, prompt: str, judge: Callable, schema: str, valid: Callable[[Column], Column], out: str = "reply",
           rounds: int = 3, options: dict | None = None) -> DataFrame:
    """Add ``out``: the judge's reply to ``prompt`` parsed as ``schema``, NULL where no reply of ``rounds`` passed ``valid``.

    The JSON may stand inside other text. A later round asks only the rows that are left, with a note (so a generation
    log does not answer with the reply that failed).
    """
    numbered = write_through(df.withColumn("__n", F.monotonically_increasing_id()), "judged")
    left, accepted = numbered.select("__n", F.col(prompt).alias("__p")), None
    for i in range(rounds):
        asked = left if i == 0 else left.withColumn("__p", F.concat("__p", render_prompt(AGAIN, round=F.lit(str(i)))))
        said = generate_batch(asked, "__p", judge, out="__said", **{"on_error": "null", **(options or {})})
        parsed = F.from_json(F.regexp_extract("__said", r"(?s)\{.*\}", 0), schema, {"mode": "PERMISSIVE"})
        replies = write_through(said.withColumn("__r", parsed).withColumn("__ok", F.coalesce(valid(F.col("__r")), F.lit(False)))
                                .select("__n", "__r", "__ok"), "replies")
        good = replies.where("__ok").select("__n", F.col("__r").alias(out))
        accepted = good if accepted is None else accepted.unionByName(good)
        rejected = replies.where("NOT __ok").select("__n")
        if i + 1 == rounds or not rejected.limit(1).count():
            break
        left = left.join(rejected, "__n", "left_semi")
    return numbered.join(accepted, "__n", "left").drop("__n")


def correctness_verdicts(df: DataFrame, judge: Callable, key: str = "example_id", **how) -> DataFrame:
    """(key, verdict, statement) rows, verdict TP, FP or FN; an example whose replies all failed has none."""
    p = df.withColumn("__prompt", render_prompt(CORRECTNESS_PROMPT, question="question", answer="answer", reference="ground_truth"))
    schema = "TP array<string>, FP array<string>, FN array<string>"

    def whole(r):
        return r["TP"].isNotNull() & r["FP"].isNotNull() & r["FN"].isNotNull()

    said = judged(p.select(key, "__prompt"), "__prompt", judge, schema, whole, **how)

    def tagged(v):
        return F.transform(F.col(f"reply.{v}"), lambda s: F.struct(F.lit(v).alias("verdict"), s.alias("statement")))

    each = F.flatten(F.array(*map(tagged, ("TP", "FP", "FN"))))
    return said.where("reply IS NOT NULL").select(key, F.explode_outer(each).alias("e")).select(key, "e.verdict", "e.statement")


def judged_correctness(df: DataFrame, judge: Callable, key: str = "example_id", weight: float = 0.75, **how) -> DataFrame:
    """G6 with a judge's verdicts; needs ``answer_similarity``. NULL where the judge failed."""
    rows = correctness_verdicts(df, judge, key, **how)
    counts = rows.groupBy(key).agg(*(F.count(F.when(F.col("verdict") == v, 1)).alias(v.lower()) for v in ("TP", "FP", "FN")))
    return EV.answer_correctness(df, weight, counts, key)


def regenerated_questions(df: DataFrame, judge: Callable, key: str = "example_id", strictness: int = 3, **how) -> DataFrame:
    """(key, number, gen_question, noncommittal): ``strictness`` questions per answer."""
    each = df.select(key, "answer", F.explode(F.sequence(F.lit(1), F.lit(strictness))).alias("number"))
    p = each.withColumn("__prompt", render_prompt(RELEVANCY_PROMPT, answer="answer", number=F.col("number").cast("string")))
    said = judged(p, "__prompt", judge, "question string, noncommittal int",
                  lambda r: r["question"].isNotNull() & r["noncommittal"].isin(0, 1), **how)
    return said.where("reply IS NOT NULL").select(key, "number", F.col("reply.question").alias("gen_question"), "reply.noncommittal")


def judged_relevancy(df: DataFrame, judge: Callable, key: str = "example_id", strictness: int = 3, dim: int = DIM, **how) -> DataFrame:
    """Mean cosine of the question and the regenerated ones, 0 if any reply calls the answer noncommittal."""
    gen = regenerated_questions(df, judge, key, strictness, **how)
    q = df.select(key, hashed_embedding("question", dim).alias("qv"))
    sims = gen.select(key, "noncommittal", hashed_embedding("gen_question", dim).alias("gv")).join(q, key)
    rel = sims.groupBy(key).agg((F.avg(EV.cosine(F.col("qv"), F.col("gv"))) * (1 - F.max("noncommittal"))).alias("rel"))
    return df.join(rel, key, "left").withColumn("answer_relevancy", F.round("rel", 6)).drop("rel")


def judged_precision(df: DataFrame, judge: Callable, key: str = "example_id", **how) -> DataFrame:
    """G7 with a verdict per ranked context; NULL if a context has none."""
    each = df.select(key, "question", "answer", F.posexplode("contexts").alias("at", "context"))
    p = each.withColumn("__prompt", render_prompt(PRECISION_PROMPT, question="question", context="context", answer="answer"))
    said = judged(p.select(key, "at", "__prompt"), "__prompt", judge, "verdict int", lambda r: r["verdict"].isin(0, 1), **how)
    rows = write_through(said.select(key, (F.col("at") + 1).alias("rank"), F.col("reply.verdict").alias("verdict")), "precision-verdicts")
    failed = rows.where("verdict IS NULL").select(key).distinct()
    scored = EV.context_precision_long(rows.where("verdict IS NOT NULL"), key).join(failed, key, "left_anti")
    empty = df.where(F.coalesce(F.size("contexts"), F.lit(0)) < 1).select(key, F.lit(0.0).alias("context_precision"))
    return df.join(scored.unionByName(empty), key, "left").withColumn("context_precision", F.round("context_precision", 6))


def judged_entity_recall(df: DataFrame, judge: Callable, key: str = "example_id", **how) -> DataFrame:
    """G8 with the judge's entities (compared without case); NULL without entities in the ground truth or a failed judge."""
    texts = df.select(key, F.explode(F.array(F.struct(F.lit("truth").alias("side"), F.col("ground_truth").alias("text")),
                                             F.struct(F.lit("contexts").alias("side"), F.array_join("contexts", "\n\n").alias("text")))).alias("t"))
    p = texts.select(key, "t.side", render_prompt(ENTITIES_PROMPT, text=F.col("t.text")).alias("__prompt"))
    said = judged(p, "__prompt", judge, "entities array<string>", lambda r: r["entities"].isNotNull(), **how)
    low = F.array_distinct(F.transform("reply.entities", lambda e: F.lower(F.trim(e))))
    both = said.withColumn("low", low).groupBy(key).agg(*(F.max(F.when(F.col("side") == s, F.col("low"))).alias(s) for s in ("truth", "contexts")))
    recall = both.select(key, F.when(F.size("truth") > 0, F.size(F.array_intersect("truth", "contexts")) / F.size("truth")).alias("recall"))
    return df.join(recall, key, "left").withColumn("context_entity_recall", F.round("recall", 6)).drop("recall")


def score_with_judge(ds: DataFrame, judge: Callable, key: str = "example_id", k: int = 2, **how) -> DataFrame:
    """All metrics of RESULT with a judge's verdicts in place of the native rules (keys must be unique)."""
    out = EV.answer_similarity(ds)
    for metric in (judged_relevancy, judged_correctness, judged_precision, judged_entity_recall):
        out = write_through(metric(out, judge, key, **how), "judged-metric")
    out = EV.judge_reasoning(out, judge, {"on_error": "null", **(how.get("options") or {})})
    return out.withColumn("rr", EV.reciprocal_rank()).withColumn(f"hit_at_{k}", EV.hit_at_k(k))
