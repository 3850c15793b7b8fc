"""Prompt rendering and batch generation.

Prompts are rendered by concatenating template parts with columns (never by
nested ``replace``, which would re-expand braces that occur inside the data).
Generators are pluggable ``Callable[[list[str]], list[str]]`` run inside tasks with
bounded concurrency, time limits and retries; their output should be kept in a
generation log (``generate_batch(log=...)``) or materialised, because generation
is costly and not deterministic. The defaults are deterministic native expressions:

* answer: the context sentence sharing most tokens with the question
  (earliest on ties);
* query variants (multi-query): the question, its sorted distinct tokens, and
  each of its sentences;
* step-back question: the question without capitalised words and numbers;
* hypothetical document (HyDE): the extractive answer over the question's own hits (``plans/rag.py``).
"""

from __future__ import annotations

import hashlib
import queue
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.plan import write_through
from tessera.functions.text import word_tokens

# --- prompt templates (fixed values, as the reference writes them) ---------------------------
BASE_PROMPT = ("\nAnswer the question to your best knowledge when looking at the following context:\n"
               "{context}\n                \nQuestion: {question}\n")
MULTI_QUERY_PROMPT = (
    "You are an AI language model assistant. Your task is to generate five \n"
    "different versions of the given user question to retrieve relevant documents from a vector \n"
    "database. By generating multiple perspectives on the user question, your goal is to help\n"
    "the user overcome some of the limitations of the distance-based similarity search. \n"
    "Provide these alternative questions separated by newlines. Original question: {question}")
STEP_BACK_SYSTEM = ("You are an expert at world knowledge. Your task is to step back and paraphrase a question "
                    "to a more generic step-back question, which is easier to answer. Here are a few examples:")
STEP_BACK_EXAMPLES = [
    ("Could the members of The Police perform lawful arrests?", "what can the members of The Police do?"),
    ("Jan Sindel’s was born in what country?", "what is Jan Sindel’s personal history?"),
]
STEP_BACK_ANSWER_PROMPT = (
    "\nYou are an expert of world knowledge. I am going to ask you a question. Your response should be "
    "comprehensive and not contradicted with the following context if they are relevant. Otherwise, ignore "
    "them if they are not relevant.\n\n# {context}\n\n# Original Question: {question}\n# Answer:\n")
HYDE_SYSTEM = ("You are an expert about the Clean Technology Sector.\n            Answer the user question as best "
               "you can. Answer as though you were writing a tutorial that addressed the user question.")


def _messages(*msgs: tuple[str, str]) -> str:
    """Chat messages flattened as 'Role: text' lines (system / few-shot / user)."""
    names = {"system": "System", "human": "Human", "user": "Human", "ai": "AI"}
    return "\n".join(f"{names[r]}: {t}" for r, t in msgs)


STEP_BACK_PROMPT = _messages(("system", STEP_BACK_SYSTEM),
                             *[m for q, a in STEP_BACK_EXAMPLES for m in (("human", q), ("ai", a))],
                             ("user", "{question}"))
HYDE_PROMPT = _messages(("system", HYDE_SYSTEM), ("human", "{question}"))

TEMPLATES = {"base": BASE_PROMPT, "multi_query": MULTI_QUERY_PROMPT, "step_back": STEP_BACK_PROMPT,
             "step_back_answer": STEP_BACK_ANSWER_PROMPT, "hyde": HYDE_PROMPT, "compression": BASE_PROMPT}


def render_prompt(template: str, **cols) -> Column:
    """Fill ``{name}`` slots of ``template`` with columns by concatenation."""
    parts = re.split(r"(\{[a-z_]+\})", template)
    out = []
    for p in parts:
        if p.startswith("{") and p.endswith("}") and p[1:-1] in cols:
            c = cols[p[1:-1]]
            out.append(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
        elif p:
            out.append(F.lit(p))
    return F.concat(*out)


def format_context(col) -> Column:
    """Contexts joined by a blank line."""
    return F.array_join(F.col(col) if isinstance(col, str) else col, "\n\n")


SENTENCE = "[^.!?]+[.!?]*"


def sentences(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.transform(F.regexp_extract_all(c, F.lit(SENTENCE), 0), lambda s: F.trim(s)),
                    lambda s: s != "")


def extractive_answer(question, context) -> Column:
    """Default answer: the context sentence with the most question tokens (first on ties)."""
    qt = word_tokens(question)
    scored = F.transform(sentences(context), lambda s, i: F.struct(
        F.size(F.array_intersect(word_tokens(s), qt)).alias("sc"), (-i).alias("neg"), s.alias("txt")))
    return F.array_max(scored).getField("txt")


def default_variants(question) -> Column:
    """Default multi-query variants: the question, its sorted distinct tokens, each sentence."""
    q = F.col(question) if isinstance(question, str) else question
    bag = F.array_join(F.array_sort(F.array_distinct(word_tokens(q))), " ")
    return F.concat(F.array(q, bag), sentences(q))


def default_step_back(question) -> Column:
    """Default step-back question: capitalised words and numbers removed, spaces collapsed."""
    q = F.col(question) if isinstance(question, str) else question
    generic = F.regexp_replace(q, "\\p{Lu}[\\p{L}\\p{N}]*|\\p{N}[\\p{N}.,]*", "")
    return F.trim(F.regexp_replace(generic, "\\s+", " "))


class _Bounded:
    """Calls of a generator from one task: at most ``workers`` at a time, each with a time limit, answers in order.

    A call that fails or takes too long is tried again after a wait that doubles up to ``max_wait`` seconds. A call of
    several prompts that never succeeds is broken up, so that one bad prompt does not take the others with it. Calls
    that are given up go on in a thread of their own; more than ``most_hanging`` of them fail the task.
    """

    def __init__(self, generator: Callable, workers: int = 1, timeout: float | None = None, retries: int = 3,
                 max_wait: float = 60, most_hanging: int = 64):
        self.generator, self.workers, self.timeout = generator, max(1, workers), timeout
        self.retries, self.max_wait, self.most_hanging = retries, max_wait, most_hanging
        self.hanging = 0

    def _once(self, prompts: list[str]) -> list[str]:
        texts = self.generator(prompts) if self.timeout is None else self._in_time(prompts)
        texts = list(texts)
        if len(texts) != len(prompts):
            raise ValueError(f"{len(prompts)} prompts got {len(texts)} answers")
        return texts

    def _in_time(self, prompts: list[str]) -> list[str]:
        if self.hanging >= self.most_hanging:
            raise _TooManyHanging(f"{self.hanging} calls of the generator hang")
        box: queue.Queue = queue.Queue()

        def call():
            try:
                box.put((self.generator(prompts), None))
            except BaseException as e:  # noqa: BLE001 (handed to the waiting thread)
                box.put((None, e))

        threading.Thread(target=call, daemon=True).start()
        try:
            texts, error = box.get(timeout=self.timeout)
        except queue.Empty:
            self.hanging += 1
            raise TimeoutError(f"no answer within {self.timeout} s") from None
        if error is not None:
            raise error
        return texts

    def _call(self, prompts: list[str]) -> tuple[list[str | None], str | None]:
        """The answers (None where there is none) and the last error."""
        error = None
        for attempt in range(self.retries + 1):
            try:
                return self._once(prompts), None
            except _TooManyHanging:
                raise
            except Exception as e:  # noqa: BLE001
                error = f"{type(e).__name__}: {e}"
            if attempt < self.retries:
                time.sleep(min(2 ** attempt, self.max_wait))
        if len(prompts) == 1:
            return [None], error
        texts: list[str | None] = []
        for p in prompts:
            try:
                texts += self._once([p])
            except _TooManyHanging:
                raise
            except Exception:  # noqa: BLE001
                texts.append(None)
        return texts, error

    def run(self, calls: Iterable[list[str]]) -> Iterator[tuple[list[str | None], str | None]]:
        if self.workers == 1:
            yield from map(self._call, calls)
            return
        pool = ThreadPoolExecutor(self.workers)
        open_calls: deque = deque()
        try:
            for prompts in calls:
                if len(open_calls) == self.workers:
                    yield open_calls.popleft().result()
                open_calls.append(pool.submit(self._call, prompts))
            while open_calls:
                yield open_calls.popleft().result()
        finally:
            pool.shutdown(wait=False, cancel_futures=True)


class _TooManyHanging(RuntimeError):
    pass


def generate_batch(df: DataFrame, prompt: str, generator: Callable[[list[str]], list[str]] | None = None,
                   out: str = "answer", question: str = "question", context: str = "context",
                   retries: int = 3, batch_rows: int = 64, generator_factory: Callable[[], Callable] | None = None,
                   workers: int = 1, timeout: float | None = None, max_wait: float = 60, on_error: str = "raise",
                   log: str | None = None, model: str = "default", rounds: int = 2) -> DataFrame:
    """Add ``out`` = generated text for every row.

    With ``generator`` (or ``generator_factory``, built once per Python worker): called with at most ``batch_rows``
    prompts, at most ``workers`` calls at a time per task, each limited to ``timeout`` seconds and tried
    ``retries`` more times with a wait that doubles up to ``max_wait`` seconds. Rows keep their order within a
    partition. ``on_error='raise'`` fails on a prompt without an answer, ``'null'`` gives NULL.

    ``log`` names a folder on shared storage that keeps every answer under the digest of model and prompt: equal
    prompts are asked once, and a prompt that has an answer there is not asked again, in this run or a later one. Each
    task asks one call's worth of prompts and its answers are kept as soon as it ends, also if the job fails later, so
    a lost executor costs at most the calls it had open. Prompts without an answer are asked again, ``rounds`` times in all.

    Without a generator: the native extractive default.
    """
    if generator is None and generator_factory is None:
        return df.withColumn(out, extractive_answer(question, context))
    if on_error not in ("raise", "null"):
        raise ValueError(f"unknown on_error {on_error}")
    from tessera.functions.plan import model_key, worker_model
    key = model_key(generator_factory) if generator is None else None
    limits = {"workers": workers, "timeout": timeout, "retries": retries, "max_wait": max_wait}

    def bounded() -> _Bounded:
        return _Bounded(generator if generator is not None else worker_model(generator_factory, key), **limits)

    if log is not None:
        return _logged(df, prompt, bounded, out, batch_rows, on_error, log, model, rounds)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])

    def run(it):
        calls = bounded()
        parts: deque = deque()

        def prompts():
            for pdf in it:
                for i in range(0, len(pdf), batch_rows):
                    parts.append(pdf.iloc[i:i + batch_rows].copy())
                    yield parts[-1][prompt].fillna("").tolist()

        for texts, error in calls.run(prompts()):
            if error is not None and on_error == "raise" and None in texts:
                raise RuntimeError(f"a prompt has no answer: {error}")
            part = parts.popleft()
            part[out] = texts
            yield part

    return df.mapInPandas(run, schema)


_LOG_SCHEMA = "key string, prompt string, answer string, error string"


def _log_folder(log: str, model: str) -> str:
    safe = re.sub(r"[^A-Za-z0-9._-]", "_", model)
    return f"{log.rstrip('/')}/{safe}-{hashlib.sha1(model.encode()).hexdigest()[:8]}"


def prompt_key(prompt: Column, model: str) -> Column:
    """Digest of a model's name and a prompt: what the generation log knows an answer by."""
    return F.sha2(F.concat(F.lit(f"{model}\u0000"), F.coalesce(prompt, F.lit(""))), 256)


def logged_answers(spark: SparkSession, log: str, model: str = "default") -> DataFrame:
    """(key, prompt, answer): what the log holds for ``model``, one row per prompt."""
    path = _log_folder(log, model)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "key string, prompt string, answer string")
    rows = spark.read.schema(_LOG_SCHEMA).parquet(path).where("answer IS NOT NULL")
    return rows.groupBy("key").agg(F.min_by("prompt", "answer").alias("prompt"), F.min("answer").alias("answer"))


def _logged(df: DataFrame, prompt: str, bounded: Callable[[], _Bounded], out: str, batch_rows: int, on_error: str, log: str,
            model: str, rounds: int) -> DataFrame:
    spark = df.sparkSession
    df = write_through(df, "prompted")  # what is asked for and what is answered must be the same rows
    keyed = df.withColumn("__key", prompt_key(F.col(prompt), model))
    asked = write_through(keyed.select(F.col("__key").alias("key"), F.coalesce(prompt, F.lit("")).alias("prompt")).distinct(), "asked")

    def ask(batches):
        for b in batches:
            rows = b.to_pydict()
            keys, prompts = rows["key"], rows["prompt"]
            parts = [slice(i, i + batch_rows) for i in range(0, len(keys), batch_rows)]
            for part, (texts, error) in zip(parts, bounded().run(prompts[p] for p in parts)):
                errors = [error if t is None else None for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(prompts[part]), pa.array(texts, pa.string()),
                                                  pa.array(errors, pa.string())], ["key", "prompt", "answer", "error"])

    def missing() -> DataFrame:
        return write_through(asked.join(logged_answers(spark, log, model).select("key"), "key", "left_anti"), "missing")

    left = missing()
    for _ in range(max(1, rounds)):
        n = left.count()
        if not n:
            break
        # committer version 2 moves a task's file into place when the task ends, not when the job does
        (left.repartition(-(-n // batch_rows)).mapInArrow(ask, _LOG_SCHEMA).write.mode("append")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(_log_folder(log, model)))
        left = missing()
    if on_error == "raise" and left.limit(1).count():
        raise RuntimeError(f"{left.count()} prompts have no answer; the log {log} keeps the others")
    answers = logged_answers(spark, log, model).select(F.col("key").alias("__key"), F.col("answer").alias(out))
    return keyed.join(answers, "__key", "left").drop("__key")
