"""Evaluation metrics (G1-G10) as column formulas over the evaluation dataset.

The judge metrics are written as their formulas over verdict tables; the
default verdicts are deterministic native rules (token overlap, origin-id
match, capitalised-word entities), and every verdict source is pluggable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import entities, word_tokens
from tessera.operators.embed import DIM, hashed_embedding, hashed_embeddings
from tessera.operators.generate import render_prompt, sentences
from tessera.schemas import EVAL_DATASET_COLUMNS, require_columns
from tessera.sources.io import materialize_or_load, table_fingerprint


def build_eval_dataset(eval_df: DataFrame, answers: DataFrame, key: str = "example_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """Evaluation dataset: mapped rows + answer, contexts, origin ids (G1).

    Joined on the example key (questions repeat, so never on question text);
    ``question_complexity`` is NULL when absent. ``extra`` columns of the answers (a run's name) are kept.
    """
    require_columns(eval_df, EVAL_DATASET_COLUMNS)
    if "question_complexity" not in eval_df.columns:
        eval_df = eval_df.withColumn("question_complexity", F.lit(None).cast("string"))
    a = answers.select(key, "answer", "contexts", "contexts_origin_doc_ids", *extra)
    return eval_df.join(a, key, "left").select(
        key, "question", "answer", "contexts", "ground_truth", "contexts_origin_doc_ids", "best_match_id",
        "question_complexity", *extra)


def first_position(ids: str = "contexts_origin_doc_ids", truth: str = "best_match_id") -> Column:
    """1-based position of the first id equal to the truth; 0 when absent or truth NULL."""
    return F.coalesce(F.array_position(F.col(ids), F.col(truth)), F.lit(0))


def reciprocal_rank(ids: str = "contexts_origin_doc_ids", truth: str = "best_match_id") -> Column:
    """1 / first matching position, else 0."""
    p = first_position(ids, truth)
    return F.when(p > 0, F.lit(1.0) / p).otherwise(F.lit(0.0))


def hit_at_k(k: int = 2, ids: str = "contexts_origin_doc_ids", truth: str = "best_match_id") -> Column:
    """1.0 if the first matching position is within k, else 0.0."""
    p = first_position(ids, truth)
    return F.when((p > 0) & (p <= k), F.lit(1.0)).otherwise(F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Inner product in double of two equal-length vectors (unit vectors -> cosine)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, x: acc + x)


def answer_similarity(df: DataFrame, dim: int = DIM) -> DataFrame:
    """Cosine of the answer and ground-truth vectors."""
    return df.withColumn("answer_similarity", F.round(
        cosine(hashed_embedding("answer", dim), hashed_embedding("ground_truth", dim)), 6))


def answer_relevancy(df: DataFrame, key: str = "example_id", regenerated: DataFrame | None = None,
                     dim: int = DIM) -> DataFrame:
    """Mean cosine of the question and the questions regenerated from the answer.

    ``regenerated``: (key, gen_question) rows from a generator; default: the
    answer's sentences. No regenerated question -> 0 (non-committal).
    """
    if regenerated is None:  # within the row: no join, one vector stage for all sentences
        qv = hashed_embedding("question", dim)
        sims = F.transform(F.col("__gen"), lambda g: cosine(F.col("__qv"), g))
        total = F.aggregate(sims, F.lit(0.0), lambda acc, x: acc + x)
        return (df.withColumn("__qv", qv).withColumn("__gen", hashed_embeddings(sentences("answer"), dim))
                .withColumn("answer_relevancy", F.round(F.when(F.size("__gen") > 0, total / F.size("__gen")).otherwise(0.0), 6))
                .drop("__qv", "__gen"))
    q = df.select(key, hashed_embedding("question", dim).alias("qv"))
    g = regenerated.select(key, hashed_embedding("gen_question", dim).alias("gv"))
    rel = g.join(q, key).groupBy(key).agg(F.avg(cosine(F.col("qv"), F.col("gv"))).alias("rel"))
    return df.join(rel, key, "left").withColumn(
        "answer_relevancy", F.round(F.coalesce("rel", F.lit(0.0)), 6)).drop("rel")


def supported(statement: Column, text_tokens: Column, min_share: float = 0.5) -> Column:
    """A statement is supported by a text when at least ``min_share`` of its distinct tokens occur there."""
    st = F.array_distinct(word_tokens(statement))
    return (F.size(st) > 0) & (F.size(F.array_intersect(st, text_tokens)) >= F.lit(min_share) * F.size(st))


def answer_correctness(df: DataFrame, weight: float = 0.75, verdicts: DataFrame | None = None,
                       key: str = "example_id") -> DataFrame:
    """``w * TP/(TP + (FP+FN)/2) + (1-w) * answer_similarity`` (G6); needs ``answer_similarity``.

    ``verdicts``: optional (key, tp, fp, fn) counts from a judge. Default: answer
    sentences supported by the ground truth are TP, the others FP; ground-truth
    sentences not supported by the answer are FN.
    """
    def combined(f1):
        return F.round(F.lit(weight) * f1 + F.lit(1 - weight) * F.col("answer_similarity"), 6)

    def f1_of(tp, fp, fn):
        den = tp + 0.5 * (fp + fn)
        return F.when(den > 0, tp / den).otherwise(F.lit(0.0))

    if verdicts is None:
        gt_t, an_t = word_tokens("ground_truth"), word_tokens("answer")
        tp = F.size(F.filter(sentences("answer"), lambda s: supported(s, gt_t)))
        fp = F.size(sentences("answer")) - tp
        fn = F.size(F.filter(sentences("ground_truth"), lambda s: ~supported(s, an_t)))
        return df.withColumn("answer_correctness", combined(f1_of(tp, fp, fn)))
    scored = verdicts.select(key, f1_of(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))
    return df.join(scored, key, "left").withColumn("answer_correctness", combined(F.col("f1"))).drop("f1")


def context_precision_long(verdicts: DataFrame, key: str = "example_id") -> DataFrame:
    """(key, context_precision) from ranked verdict rows (key, rank, verdict 0/1).

    ``sum_k precision@k * v_k / sum_k v_k``, 0 when no context is useful.
    """
    w = Window.partitionBy(key).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prec = verdicts.withColumn("p_at_k", F.sum("verdict").over(w) / F.col("rank"))
    return prec.groupBy(key).agg(
        F.when(F.sum("verdict") > 0, F.sum(F.col("p_at_k") * F.col("verdict")) / F.sum("verdict"))
        .otherwise(F.lit(0.0)).alias("context_precision"))


def context_precision(df: DataFrame, key: str = "example_id", verdicts: DataFrame | None = None) -> DataFrame:
    """Context precision per example; default verdict: the context comes from the best-match article."""
    if verdicts is None:  # within the row: running hits over the ranked contexts
        state = F.struct(F.lit(0.0).alias("hits"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("n"))

        def step(acc, oid):
            v = F.when(oid == F.col("best_match_id"), 1.0).otherwise(0.0)
            return F.struct((acc["hits"] + v).alias("hits"),
                            (acc["sum"] + v * (acc["hits"] + v) / (acc["n"] + 1)).alias("sum"), (acc["n"] + 1).alias("n"))

        value = F.aggregate("contexts_origin_doc_ids", state, step,
                            lambda acc: F.when(acc["hits"] > 0, acc["sum"] / acc["hits"]).otherwise(0.0))
        return df.withColumn("context_precision", F.round(F.coalesce(value, F.lit(0.0)), 6))
    cp = context_precision_long(verdicts, key)
    return df.join(cp, key, "left").withColumn(
        "context_precision", F.round(F.coalesce("context_precision", F.lit(0.0)), 6))


def context_entity_recall(df: DataFrame, extractor: Callable | None = None) -> DataFrame:
    """Share of ground-truth entities found in the contexts; NULL without entities."""
    ext = extractor or entities
    gt = ext(F.col("ground_truth"))
    ctx = ext(F.array_join(F.col("contexts"), "\n\n"))
    return df.withColumn("context_entity_recall", F.when(
        F.size(gt) > 0, F.round(F.size(F.array_intersect(gt, ctx)) / F.size(gt), 6)))


JUDGE_TEMPLATE = ("Given the question and the reference contexts, grade the prediction from 1 to 10 and give your "
                  "reasoning.\nQuestion: {question}\nReference: {reference}\nPrediction: {prediction}\n")


def judge_reasoning(df: DataFrame, judge: Callable[[list[str]], list[str]] | None = None,
                    options: dict | None = None) -> DataFrame:
    """Add ``reasoning`` (G9): a judge's text rationale; default: a native overlap statement."""
    if judge is not None:
        from tessera.operators.generate import generate_batch
        prompted = df.withColumn("__prompt", render_prompt(
            JUDGE_TEMPLATE, question="question", reference=F.array_join("contexts", "\n\n"), prediction="answer"))
        return generate_batch(prompted, "__prompt", judge, out="reasoning", **(options or {})).drop("__prompt")
    qt = F.array_distinct(word_tokens("question"))
    ct = F.array_distinct(word_tokens(F.array_join("contexts", " ")))
    at = F.array_distinct(word_tokens("answer"))
    return df.withColumn("reasoning", F.format_string(
        "The answer uses %d of %d question tokens and %d of its %d tokens occur in the contexts.",
        F.size(F.array_intersect(at, qt)), F.size(qt), F.size(F.array_intersect(at, ct)), F.size(at)))


def score_dataset(ds: DataFrame, k: int = 2, key: str = "example_id") -> DataFrame:
    """All metrics on an evaluation dataset: judge metrics, reasoning, RR, hit@k (RESULT)."""
    out = answer_similarity(ds)
    out = answer_relevancy(out, key)
    out = answer_correctness(out, key=key)
    out = context_precision(out, key)
    out = context_entity_recall(out)
    out = judge_reasoning(out)
    return out.withColumn("rr", reciprocal_rank()).withColumn(f"hit_at_{k}", hit_at_k(k))


def run_evaluation(spark, eval_df: DataFrame, build_answers: Callable[[DataFrame], DataFrame], cache_dir: str,
                   name: str, strategy: str = "", refresh: bool = False, judge: Callable | None = None, **how) -> DataFrame:
    """Cached evaluation (G10): key = run name (``Experiment N:`` dropped) + strategy + table fingerprint.

    On a miss: answers -> dataset -> metrics, written once under ``cache_dir``. ``judge`` gives the verdicts of G5-G9
    (``how``: rounds and generation options); without one the native rules do. Name the judge in ``strategy``.
    """
    key = table_fingerprint(eval_df, name=name, extra=strategy).first()["cache_key"]
    path = f"{cache_dir.rstrip('/')}/{key}"

    def build():
        # answers are written once: scoring reads them several times and must not generate again
        answers = materialize_or_load(spark, f"{path}-answers", lambda: build_answers(eval_df), refresh=refresh)
        dataset = build_eval_dataset(eval_df, answers)
        if judge is None:
            return score_dataset(dataset)
        from tessera.operators.judge import score_with_judge
        return score_with_judge(dataset, judge, **how)

    return materialize_or_load(spark, path, build, refresh=refresh)
