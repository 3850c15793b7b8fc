"""Explicit schemas for every input shape, and the one column guard (A3)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ARTICLE_CSV = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("content", T.StringType()),  # Python list literal of chunks
    T.StructField("domain", T.StringType()),
    T.StructField("url", T.StringType()),
])

EVAL_RAW = T.StructType([
    T.StructField("example_id", T.LongType(), False),
    T.StructField("question_id", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("relevant_chunk", T.StringType()),
    T.StructField("article_url", T.StringType()),
])

ARTICLE_COLUMNS = ("content", "title", "date", "author", "domain", "url")
METADATA_COLUMNS = ("url", "domain", "title", "author", "date", "id")
EVAL_DATASET_COLUMNS = ("question", "ground_truth", "best_match_id")

# Display names of the seven compared metrics (fixed values, as the reference shows them).
METRIC_DISPLAY = {
    "answer_correctness": "Answer Correctness",
    "answer_relevancy": "Answer Relevancy",
    "answer_similarity": "Answer Similarity",
    "context_precision": "Context Precision",
    "context_entity_recall": "Context Entity Recall",
    "rr": "Reciprocal Rank",
    "hit_at_2": "Hit@2",
}
JUDGE_METRICS = ("answer_correctness", "answer_relevancy", "answer_similarity",
                 "context_precision", "context_entity_recall")
ALL_METRICS = JUDGE_METRICS + ("rr", "hit_at_2")


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Raise ``ValueError`` if any required column is missing; return ``df`` unchanged."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")
    return df
