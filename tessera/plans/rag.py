"""Question -> contexts -> prompt -> answer, for every question of a table at once.

Strategies are values, not a code path per question. The texts that any of the wanted strategies searches with (the
question, its variants, its step-back question, its hypothetical document) go through one top-k plan, so a collection's
vectors are scanned once however many strategies run; only the default hypothetical document, which is made from the
question's own hits, needs a second scan. Questions are numbered inside, so their ids may be of any type and repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.plan import spread, write_through
from tessera.operators import chunk as E
from tessera.operators import generate as G
from tessera.operators import retrieve as R
from tessera.operators.embed import embed
from tessera.sources.collections import read_collection

STRATEGIES = ("base", "multi_query", "step_back", "hyde", "compression")


def corpus_index(clean: DataFrame, size: int, overlap: int = 0, splitter: str = "fixed",
                 encoder: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """(chunks, vectors) of a cleaned corpus: fixed windows or the recursive splitter, then E4."""
    chunks = (E.fixed_chunk(clean, size, overlap) if splitter == "fixed"
              else E.create_documents(clean, size, overlap))
    texts = spread(chunks.select("chunk_id", "page_content"), "chunk_id")
    vectors = embed(texts, "page_content", encoder=encoder).select("chunk_id", "embedding")
    return chunks, vectors


def stored_index(spark: SparkSession, store: str, name: str, version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(chunks, vectors) of a collection that ``collection_build`` wrote: nothing is chunked or embedded again.

    Both read only the collection's folders, and of these only the columns they use. The state is the store's last at
    this call, so both see the same rows.
    """
    rows = read_collection(spark, store, name, version).drop("collection")
    return rows.drop("embedding"), rows.select("chunk_id", "embedding")


def _hits_for(texts: DataFrame, vectors: DataFrame, k: int, encoder) -> DataFrame:
    """texts: (qid, text) -> HIT rows (qid, rank, chunk_id, score)."""
    qv = embed(texts, "text", encoder=encoder).select("qid", "embedding")
    return R.similarity_search(qv, vectors, k=k, qid="qid").select("qid", "rank", "chunk_id", "score")


def _lines(q: DataFrame, template: str, generator: Callable, text: str, options: dict) -> DataFrame:
    """(qn, no, line): the generator's answer to ``template`` for each row, one row per line."""
    prompted = q.withColumn("prompt", G.render_prompt(template, question=text))
    raw = G.generate_batch(prompted, "prompt", generator, out="raw", **options)
    return raw.select("qn", "no", F.posexplode(F.split("raw", "\n")).alias("at", "line")).select(
        "qn", F.concat_ws(".", "no", "at").alias("no"), "line")


def _search_texts(q: DataFrame, strategies: Sequence[str], generator: Callable | None, options: dict) -> DataFrame:
    """(qn, kind, no, text): every text to search with; kind q question, v variant, s step-back, h hypothetical document."""
    def whole(kind, text):
        return q.select("qn", F.lit(kind).alias("kind"), F.lit("0").alias("no"), text.alias("text"))

    def written(kind, template):
        prompted = q.withColumn("prompt", G.render_prompt(template, question="question"))
        answers = G.generate_batch(prompted, "prompt", generator, out="text", **options)
        return answers.select("qn", F.lit(kind).alias("kind"), F.lit("0").alias("no"), "text")

    parts = []
    if set(strategies) - {"multi_query"} and (set(strategies) != {"hyde"} or generator is None):
        parts.append(whole("q", F.col("question")))
    if "multi_query" in strategies:
        # Each generated variant goes through a multi-query retriever that expands it once more;
        # the unique union covers the hits of every second-level query.
        if generator is None:
            twice = F.flatten(F.transform(G.default_variants("question"), G.default_variants))
            variants = q.select("qn", F.posexplode(twice).alias("no", "text"))
        else:
            first = _lines(q.withColumn("no", F.lit("")), G.MULTI_QUERY_PROMPT, generator, "question", options)
            variants = _lines(first, G.MULTI_QUERY_PROMPT, generator, "line", options).withColumnRenamed("line", "text")
        parts.append(variants.select("qn", F.lit("v").alias("kind"), F.col("no").cast("string").alias("no"), "text"))
    if "step_back" in strategies:
        parts.append(whole("s", G.default_step_back("question")) if generator is None else written("s", G.STEP_BACK_PROMPT))
    if "hyde" in strategies and generator is not None:
        parts.append(written("h", G.HYDE_PROMPT))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _search(texts: DataFrame, vectors: DataFrame, chunks: DataFrame, k: int, encoder) -> tuple[DataFrame, DataFrame]:
    """(hits, chunks hit): one scan of the vectors and one of the chunk texts for all search texts, both written.

    Equal texts (a question's variants repeat) are embedded and searched once.
    """
    keyed = texts.select("qn", "kind", F.concat_ws(":", "qn", "kind", "no").alias("own"), "text")
    keyed = write_through(keyed.withColumn("qid", F.min("own").over(Window.partitionBy("text"))), "search-texts")
    found = _hits_for(keyed.where(F.col("own") == F.col("qid")).select("qid", "text"), vectors, k, encoder)
    hits = write_through(keyed.select("qn", "kind", "qid").join(found, "qid").select("qn", "kind", "rank", "chunk_id", "score"), "hits")
    return hits, write_through(chunks.join(hits.select("chunk_id").distinct(), "chunk_id", "left_semi"), "hit-chunks")


def _retrieve(q: DataFrame, vectors: DataFrame, chunks: DataFrame, strategies: Sequence[str], k: int, generator,
              encoder, extractor, options: dict) -> dict[str, DataFrame]:
    """(qn, rank, chunk_id, origin_doc_id, page_content, score) rows of each strategy for numbered questions."""
    unknown = [s for s in strategies if s not in STRATEGIES]
    if unknown or not strategies:
        raise ValueError(f"unknown strategy {', '.join(unknown) or 'none'}")
    hits, found = _search(_search_texts(q, strategies, generator, options), vectors, chunks, k, encoder)

    def of(kind):
        return hits.where(F.col("kind") == kind).drop("kind")

    out = {}
    for strategy in strategies:
        texts = found
        if strategy in ("base", "compression"):
            ranked = of("q")
        elif strategy == "multi_query":
            ranked = R.multi_query(of("v"), found, qid="qn")
        elif strategy == "step_back":
            ranked = R.step_back(of("q"), of("s"), found, qid="qn")
        elif generator is not None:
            ranked = of("h")
        else:  # the hypothetical document: the extractive answer over the question's own hits
            own = q.join(pack_contexts(R.attach_chunks(of("q"), found), "qn"), "qn", "left").withColumn("context", G.format_context("contexts"))
            written = own.select("qn", F.lit("h").alias("kind"), F.lit("0").alias("no"),
                                 F.coalesce(G.extractive_answer("question", "context"), "question").alias("text"))
            ranked, texts = _search(written, vectors, chunks, k, encoder)
        rows = R.attach_chunks(ranked, texts).join(q.select("qn", "question"), "qn")
        if strategy == "compression":
            rows = R.compress_contexts(rows, qid="qn", extractor=extractor, generator=generator, options=options)
        out[strategy] = rows.select("qn", "rank", "chunk_id", "origin_doc_id", "page_content", "score")
    return out


def _numbered(questions: DataFrame, key: str) -> DataFrame:
    """(qn, key, question), written once: numbers and texts stay as they are however often they are read."""
    q = questions.select(F.col(key).alias("key"), F.col("question"))
    return write_through(q.withColumn("qn", F.monotonically_increasing_id()), "questions")


def retrieve_runs(questions: DataFrame, vectors: DataFrame, chunks: DataFrame, strategies: Sequence[str] = STRATEGIES, k: int = 4,
                  key: str = "example_id", generator: Callable | None = None, encoder: Callable | None = None,
                  extractor: Callable | None = None, options: dict | None = None) -> DataFrame:
    """(strategy, key, rank, chunk_id, origin_doc_id, page_content, score): ranked contexts under each strategy.

    ``options`` go to ``generate_batch`` (log, concurrency, timeouts). Questions under one id are ranked apart.
    """
    q = _numbered(questions, key)
    found = _retrieve(q, vectors, chunks, strategies, k, generator, encoder, extractor, options or {})
    return _tagged(found).join(q.select("qn", F.col("key").alias(key)), "qn").drop("qn")


def _tagged(found: dict[str, DataFrame]) -> DataFrame:
    every = [df.withColumn("strategy", F.lit(s)) for s, df in found.items()]
    out = every[0]
    for df in every[1:]:
        out = out.unionByName(df)
    return out


def retrieve(questions: DataFrame, vectors: DataFrame, chunks: DataFrame, strategy: str = "base", k: int = 4,
             key: str = "example_id", generator: Callable | None = None, encoder: Callable | None = None,
             extractor: Callable | None = None, options: dict | None = None) -> DataFrame:
    """Ranked context rows (key, rank, chunk_id, origin_doc_id, page_content, score) for every question under ``strategy``."""
    rows = retrieve_runs(questions, vectors, chunks, (strategy,), k, key, generator, encoder, extractor, options)
    return rows.select(key, "rank", "chunk_id", "origin_doc_id", "page_content", "score")


def pack_contexts(rows: DataFrame, *keys: str) -> DataFrame:
    """Rank-ordered context and origin-id arrays per question."""
    keys = keys or ("example_id",)
    packed = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("rank", "page_content", "origin_doc_id"))).alias("r"))
    return packed.select(*keys, F.transform("r", lambda x: x["page_content"]).alias("contexts"),
                         F.transform("r", lambda x: x["origin_doc_id"]).alias("contexts_origin_doc_ids"))


def rag_runs(questions: DataFrame, vectors: DataFrame, chunks: DataFrame, strategies: Sequence[str] = STRATEGIES, k: int = 4,
             key: str = "example_id", generator: Callable | None = None, encoder: Callable | None = None,
             extractor: Callable | None = None, options: dict | None = None) -> DataFrame:
    """(strategy, key, question, contexts, contexts_origin_doc_ids, context, prompt, answer): one row per question and
    strategy; all prompts are answered in one batch plan (F12)."""
    q = _numbered(questions, key)
    found = _retrieve(q, vectors, chunks, strategies, k, generator, encoder, extractor, options or {})
    every = q.withColumn("strategy", F.explode(F.array(*map(F.lit, strategies))))
    packed = every.join(pack_contexts(_tagged(found), "strategy", "qn"), ["strategy", "qn"], "left").select(
        "strategy", F.col("key").alias(key), "question",
        F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"),
        F.coalesce("contexts_origin_doc_ids", F.array().cast("array<bigint>")).alias("contexts_origin_doc_ids"))
    packed = packed.withColumn("context", G.format_context("contexts"))
    stepped = G.render_prompt(G.STEP_BACK_ANSWER_PROMPT, context="context", question="question")
    plain = G.render_prompt(G.BASE_PROMPT, context="context", question="question")
    packed = packed.withColumn("prompt", F.when(F.col("strategy") == "step_back", stepped).otherwise(plain))
    return G.generate_batch(packed, "prompt", generator, out="answer", question="question", context="context", **(options or {}))


def rag_answers(questions: DataFrame, vectors: DataFrame, chunks: DataFrame, strategy: str = "base", k: int = 4,
                key: str = "example_id", generator: Callable | None = None, encoder: Callable | None = None,
                extractor: Callable | None = None, options: dict | None = None) -> DataFrame:
    """(key, question, contexts, contexts_origin_doc_ids, context, prompt, answer) for every question under one strategy."""
    return rag_runs(questions, vectors, chunks, (strategy,), k, key, generator, encoder, extractor, options).drop("strategy")


def spot_check(questions: DataFrame, texts: list[str], vectors: DataFrame, chunks: DataFrame,
               strategy: str = "base", **kw) -> DataFrame:
    """Answers for a handpicked list of question texts."""
    picked = questions.where(F.col("question").isin(texts))
    return rag_answers(picked, vectors, chunks, strategy, **kw)
