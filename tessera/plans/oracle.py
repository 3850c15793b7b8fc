"""DuckDB oracle SQL, one statement per registered query (same column names)."""

from __future__ import annotations

from tessera.plans import sqlparts as S

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


# ---------------------------------------------------------------- A
sql("read_articles", S.with_(S.ARTICLES) + """
SELECT row_id, title, domain, url, CAST(len(content) AS BIGINT) AS n_chunks,
       array_to_string(content, chr(10)) AS text FROM articles""")

sql("table_fingerprint", """
SELECT count(*) AS n_rows, CAST(sum(('0x' || substr(sha256(concat_ws(chr(31),
         coalesce(CAST(o_orderkey AS VARCHAR), chr(0)), coalesce(CAST(o_custkey AS VARCHAR), chr(0)),
         coalesce(o_orderstatus, chr(0)), coalesce(CAST(o_totalprice AS VARCHAR), chr(0)),
         coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), chr(0)), coalesce(o_orderpriority, chr(0)))), 1, 8))::UBIGINT)
       AS VARCHAR) AS fingerprint,
       'Baseline 200_' || CAST(sum(('0x' || substr(sha256(concat_ws(chr(31),
         coalesce(CAST(o_orderkey AS VARCHAR), chr(0)), coalesce(CAST(o_custkey AS VARCHAR), chr(0)),
         coalesce(o_orderstatus, chr(0)), coalesce(CAST(o_totalprice AS VARCHAR), chr(0)),
         coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), chr(0)), coalesce(o_orderpriority, chr(0)))), 1, 8))::UBIGINT)
       AS VARCHAR) AS cache_key
FROM orders""")

sql("sample_exact", """
SELECT doc_id, source, n_chars FROM documents ORDER BY sha256('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 102""")

sql("collection_stats", """
SELECT 'label_' || CAST(label AS VARCHAR) AS collection, count(*) AS n_rows, count(*) = 0 AS is_empty
FROM embeddings GROUP BY label""")

sql("require_columns", """
SELECT doc_id AS row_id, string_split(text, chr(10))[1] AS title, source AS domain,
       'https://' || source || '.example/a/' || CAST(doc_id AS VARCHAR) AS url FROM documents""")

sql("materialize_or_load", """
SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey""")

sql("collection_append", """
SELECT c AS collection, CASE WHEN c = 'extended' THEN 2 ELSE 1 END * (SELECT count(*) FROM embeddings) AS n_rows, false AS is_empty
FROM (VALUES ('kept'), ('extended'), ('rewritten')) t(c)""")

sql("collection_drop", """
SELECT source AS collection, count(*) AS n_rows, false AS is_empty FROM documents
WHERE source > (SELECT min(source) FROM documents) GROUP BY source""")

sql("collection_name", """
SELECT source, translate(lower('cleantech-BAAI/bge-small-en-RecursiveCharacterTextSplitter ' || source || '_dev'),
                         ' /:-', '____') AS collection
FROM (SELECT DISTINCT source FROM documents)""")


# ---------------------------------------------------------------- B
def _profile_sql(tbl: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS total_count, count(*) - count({c}) AS nan_count,
  round(100.0 * (count(*) - count({c})) / count(*), 6) AS nan_pct, count(DISTINCT {c}) AS unique_count,
  round(100.0 * count(DISTINCT {c}) / count(*), 6) AS unique_pct FROM {tbl}""")
    return "\nUNION ALL\n".join(parts)


sql("column_profile", _profile_sql("documents", ["doc_id", "text", "lang", "source", "n_chars"]))
sql("column_profile_orders", _profile_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                    "o_orderdate", "o_orderpriority"]))

sql("parse_list_literal", S.with_(S.ARTICLES) + """
SELECT row_id, CAST(len(content) AS BIGINT) AS n_items, array_to_string(content, chr(10)) AS text, false AS corrupt
FROM articles""")

sql("chunks_per_article", S.with_(S.ARTICLES) + "SELECT row_id, CAST(len(content) AS BIGINT) AS n_chunks FROM articles")

_WORDS = f"""words AS (
  SELECT row_id, CAST(i - 1 AS BIGINT) AS chunk_no, CAST({S.word_count("content[i]")} AS BIGINT) AS n_words
  FROM articles, range(1, len(content) + 1) AS t(i))"""

sql("words_per_chunk", S.with_(S.ARTICLES, _WORDS) + "SELECT * FROM words")


def _hist_sql(src: str, col: str, bins: int) -> str:
    return f"""WITH v AS (SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE))),
st AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS mn,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS mx FROM v),
b0 AS (SELECT x, mn, mx, (mx - mn) / {float(bins)} AS step,
              least(greatest(CAST(floor((x - mn) / ((mx - mn) / {float(bins)})) AS INTEGER), 0), {bins - 1}) AS b
       FROM v, st),
b1 AS (SELECT CASE WHEN b > 0 AND x < (CASE WHEN b >= {bins} THEN mx ELSE CAST(b AS DOUBLE) * step + mn END) THEN b - 1
                   WHEN b < {bins - 1} AND x >= (CASE WHEN b + 1 >= {bins} THEN mx ELSE CAST(b + 1 AS DOUBLE) * step + mn END) THEN b + 1
                   ELSE b END AS bin FROM b0),
cnt AS (SELECT bin, count(*) AS c FROM b1 GROUP BY bin),
grid AS (SELECT CAST(i AS INTEGER) AS bin, mn, mx, (mx - mn) / {float(bins)} AS step FROM range({bins}) t(i), st)
SELECT g.bin, CASE WHEN g.bin >= {bins} THEN mx ELSE CAST(g.bin AS DOUBLE) * step + mn END AS lo,
       CASE WHEN g.bin + 1 >= {bins} THEN mx ELSE CAST(g.bin + 1 AS DOUBLE) * step + mn END AS hi,
       CAST(coalesce(c, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN cnt USING (bin)"""


sql("histogram_chars", _hist_sql("documents", "n_chars", 50))
sql("histogram_price", _hist_sql("lineitem", "l_extendedprice", 150))
sql("histogram_words", S.with_(S.ARTICLES, _WORDS).replace("WITH ", "WITH ", 1)
    + "SELECT * FROM (" + _hist_sql("words", "n_words", 150) + ")")

sql("histogram_words_view", S.with_(S.ARTICLES, _WORDS) + "SELECT * FROM (" + _hist_sql("words", "n_words", 150) + ") WHERE hi >= 0 AND lo <= 500")

sql("value_counts", """
SELECT source AS value, count(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY source""")

sql("repeated_titles", S.with_(S.ARTICLES) + """
SELECT title AS value, count(*) AS count FROM articles WHERE title IS NOT NULL GROUP BY title HAVING count(*) > 1""")

sql("repeated_chunks", S.with_(S.ARTICLES) + """
SELECT chunk AS value, count(*) AS count FROM (SELECT unnest(content) AS chunk FROM articles)
WHERE chunk IS NOT NULL GROUP BY chunk HAVING count(*) > 1 ORDER BY count DESC, value LIMIT 10""")

_DUP_TITLE = """dup_title AS (
  SELECT title, count(*) - count(DISTINCT chunk) - max(CASE WHEN chunk IS NULL THEN 1 ELSE 0 END) AS duplicated_count
  FROM (SELECT title, unnest(CASE WHEN len(content) = 0 THEN [NULL] ELSE content END) AS chunk FROM articles
        WHERE title IN (SELECT title FROM articles WHERE title IS NOT NULL GROUP BY title HAVING count(*) > 1))
  GROUP BY title)"""

sql("duplicates_by_title", S.with_(S.ARTICLES, _DUP_TITLE) + "SELECT * FROM dup_title")

sql("duplicate_totals", S.with_(S.ARTICLES, _DUP_TITLE) + """,
tot AS (SELECT count(*) - count(DISTINCT chunk) - max(CASE WHEN chunk IS NULL THEN 1 ELSE 0 END) AS total_dup,
               count(*) AS n_chunks
        FROM (SELECT unnest(CASE WHEN len(content) = 0 THEN [NULL] ELSE content END) AS chunk FROM articles))
SELECT CAST(total_dup AS BIGINT) AS total_duplicated,
       CAST(coalesce((SELECT sum(duplicated_count) FROM dup_title), 0) AS BIGINT) AS from_repeated_titles,
       CAST(total_dup - coalesce((SELECT sum(duplicated_count) FROM dup_title), 0) AS BIGINT) AS from_other_titles,
       round(100.0 * total_dup / n_chunks, 6) AS duplicated_pct
FROM tot""".replace("WITH articles", "WITH articles", 1))

_LP = S.language_profile_ctes()

sql("detect_language", S.with_(_LP, S.detect_ctes("dl", "documents", "doc_id", "text")) + "SELECT * FROM dl")

_ART_LANG = S.detect_ctes("al", "(SELECT row_id, array_to_string(content, chr(10)) AS raw FROM articles)", "row_id", "raw")

sql("language_anomalies", S.with_(S.ARTICLES, _LP, _ART_LANG) + """
SELECT a.row_id, a.title, l.language FROM articles a JOIN al l USING (row_id) WHERE l.language IN ('ru', 'de')""")

_ANOMALIES = (
    S.ARTICLES, _LP, _ART_LANG,
    """anom AS (SELECT a.row_id, a.content FROM articles a JOIN al l USING (row_id) WHERE l.language IN ('ru', 'de'))""",
    """achunks AS (SELECT row_id * 100000 + (i - 1) AS ck, content[i] AS chunk FROM anom, range(1, len(content) + 1) t(i))""",
    S.detect_ctes("cl", "achunks", "ck", "chunk"))
sql("anomaly_chunk_rows", S.with_(*_ANOMALIES) + """
SELECT cl.ck // 100000 AS row_id, cl.ck % 100000 AS chunk_no, a.chunk, cl.language AS chunk_language FROM cl JOIN achunks a USING (ck)
WHERE cl.language IS NULL OR cl.language <> 'en'""")
sql("anomaly_chunks", S.with_(*_ANOMALIES) + """
SELECT count(*) AS n_chunks, CAST(sum(CASE WHEN language IS NULL OR language <> 'en' THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalous,
       round(100.0 * sum(CASE WHEN language IS NULL OR language <> 'en' THEN 1 ELSE 0 END) / count(*), 6) AS anomalous_pct
FROM cl""")

# ---------------------------------------------------------------- C
sql("filter_language", S.with_(_LP, S.detect_ctes("dl", "documents", "doc_id", "text")) + """
SELECT d.doc_id, d.source, l.language FROM documents d JOIN dl l USING (doc_id) WHERE l.language = 'en'""")

sql("strip_tags", f"SELECT page_id, {S.strip_tags('html')} AS text FROM pages")

sql("strip_special", f"SELECT doc_id, {S.strip_special('text')} AS text FROM documents")

sql("dedup_keep_first", """
SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""")

_FIRST_CHUNKS = """firsts AS (
  SELECT row_id, chunk_no, chunk FROM (
    SELECT row_id, CAST(i - 1 AS BIGINT) AS chunk_no, content[i] AS chunk,
           row_number() OVER (PARTITION BY content[i] ORDER BY row_id, i) AS rn
    FROM articles, range(1, len(content) + 1) t(i)) WHERE rn = 1)"""

sql("dedup_chunks", S.with_(S.ARTICLES, _FIRST_CHUNKS) + "SELECT * FROM firsts")

sql("regroup_articles", S.with_(S.ARTICLES, _FIRST_CHUNKS) + """
SELECT row_id, count(*) AS n_chunks, string_agg(chunk, ' ' ORDER BY chunk_no) AS content FROM firsts GROUP BY row_id""")

sql("content_id", f"SELECT doc_id, {S.content_id('text')} AS id, {S.content_key('text')} AS doc_key FROM documents")

sql("id_collisions", f"""
SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, count(*) - count(DISTINCT id) AS duplicate_ids
FROM (SELECT {S.content_id('text')} AS id FROM documents)""")

sql("clean_corpus", S.with_(S.ARTICLES, S.clean_corpus_ctes()) + "SELECT * FROM clean")

# ---------------------------------------------------------------- D
sql("drop_duplicate_rows", "SELECT DISTINCT * FROM conversations WHERE text IS NOT NULL")

sql("unwrap_singleton", "SELECT item_id, text AS relevant_chunk FROM benchmark")


def _norm_tokens(x: str) -> str:
    n = f"trim(lower(regexp_replace(regexp_replace({x}, '[\\x{{80}}-\\x{{ff}}]', '', 'g'), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')))"
    return f"list_sort(list_distinct(list_filter(string_split_regex({n}, ' +'), lambda t: t <> '')))"


def _jl(n: str, l: str) -> str:
    return f"(CASE WHEN {n} > 0 THEN {l} + {n} - 1 ELSE 0 END)"


def _r(num: str, den: str) -> str:
    return f"CAST(round_even(100.0 * (CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)), 0) AS INTEGER)"


_CLOSED = f"""pn AS (SELECT item_id AS pid, {_norm_tokens('text')} AS toks FROM benchmark),
pst AS (SELECT pid, len(toks) AS np, coalesce(list_sum(list_transform(toks, lambda t: length(t))), 0) AS lp FROM pn),
dn AS (SELECT row_id AS did, {_norm_tokens('content')} AS toks FROM clean),
dst AS (SELECT did, len(toks) AS nd, coalesce(list_sum(list_transform(toks, lambda t: length(t))), 0) AS ld FROM dn),
pt AS (SELECT pid, unnest(toks) AS tok FROM pn),
dt AS (SELECT did, unnest(toks) AS tok FROM dn),
sh AS (SELECT pid, did, count(*) AS ns, sum(length(tok)) AS ls FROM pt JOIN dt USING (tok) GROUP BY pid, did),
pr AS (SELECT pid, did, {_jl('ns', 'ls')} AS s, {_jl('np - ns', 'lp - ls')} AS a, {_jl('nd - ns', 'ld - ls')} AS b
       FROM sh JOIN pst USING (pid) JOIN dst USING (did)),
sc AS (SELECT pid, did, greatest(CASE WHEN a = 0 THEN 100 ELSE {_r('2 * s', '2 * s + 1 + a')} END,
                                 CASE WHEN b = 0 THEN 100 ELSE {_r('2 * s', '2 * s + 1 + b')} END) AS score FROM pr),
win AS (SELECT pid, did, score FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, did) AS rn
        FROM sc WHERE score > 0) WHERE rn = 1)"""

sql("best_match_closed", S.with_(S.ARTICLES, S.clean_corpus_ctes(), _CLOSED) + """
SELECT b.item_id AS example_id, CAST(coalesce(w.score, 0) AS INTEGER) AS best_match_score,
       CAST(c.id AS BIGINT) AS best_match_id
FROM benchmark b LEFT JOIN win w ON w.pid = b.item_id LEFT JOIN clean c ON c.row_id = w.did""")

# ---------------------------------------------------------------- E
from tessera.operators.compare import DEFAULT_DISTRIBUTION, quotas  # noqa: E402

_BASE = [S.ARTICLES, S.clean_corpus_ctes()]
_QS = "qs AS (SELECT item_id AS qid, text AS question FROM benchmark)"
_MAPPED = _CLOSED + """,
mapped AS (SELECT b.item_id AS example_id, b.item_id AS question_id, b.text AS question,
                  b.text AS ground_truth, CAST(coalesce(w.score, 0) AS INTEGER) AS best_match_score,
                  CAST(c.id AS BIGINT) AS best_match_id, c.doc_key AS best_match_key
           FROM benchmark b LEFT JOIN win w ON w.pid = b.item_id LEFT JOIN clean c ON c.row_id = w.did)"""


sql("map_eval_set_closed", S.with_(*_BASE, _MAPPED) + "SELECT * FROM mapped")


def _digest(v: str) -> str:
    return (f"CAST(len(list_filter({v}, lambda x: x <> 0)) AS BIGINT) AS nnz, "
            f"round(sqrt(list_sum(list_transform({v}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm, "
            f"round(list_sum(list_transform({v}, lambda x, i: CAST(x AS DOUBLE) * i)), 6) AS wsum")


sql("fixed_chunk", S.with_(*_BASE, S.fixed_chunks_cte("ch", 1000)) + "SELECT * FROM ch")
sql("fixed_chunk_overlap", S.with_(*_BASE, S.fixed_chunks_cte("ch", 1024, 32)) +
    "SELECT chunk_id, origin_doc_id, chunk_no, CAST(length(page_content) AS BIGINT) AS n_chars FROM ch")
sql("chunk_report", S.with_(*_BASE, S.fixed_chunks_cte("ch", 200)) + """
SELECT (SELECT count(*) FROM ch) AS n_chunks, (SELECT count(*) FROM clean) AS n_articles,
       round(100.0 * (SELECT count(*) FROM ch) / (SELECT count(*) FROM clean), 6) AS pct""")
sql("embed", S.with_(*_BASE, S.fixed_chunks_cte("ch", 1000), S.embed_ctes("cv", "ch", "chunk_id", "page_content"))
    + f"SELECT chunk_id, {_digest('emb')} FROM cv")
sql("l2_normalize", f"""SELECT vec_id, {_digest("list_transform(embedding, lambda x: CASE WHEN n > 0 THEN CAST(x AS DOUBLE) / n ELSE CAST(x AS DOUBLE) END)")}
FROM (SELECT *, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS n FROM embeddings)""")
sql("collection_build", S.with_(*_BASE, S.fixed_chunks_cte("c1", 1000), S.fixed_chunks_cte("c2", 200)) + """
SELECT 'cleantech_baai_bge_small_en_fixed1000_dev' AS collection, (SELECT count(*) FROM c1) AS n_rows, false AS is_empty
UNION ALL
SELECT 'cleantech_baai_bge_small_en_fixed200_dev', (SELECT count(*) FROM c2), false""")


# ---------------------------------------------------------------- F
def _rows_sql(strategy: str, size: int = 1000, t: str = "r") -> list[str]:
    return [*_BASE, _QS, S.fixed_chunks_cte(f"ch{size}", size),
            S.embed_ctes(f"cv{size}", f"ch{size}", "chunk_id", "page_content"),
            *S.rows_ctes(t, strategy, f"ch{size}", f"cv{size}")]


def _hits_select(t: str = "r", extra: str = "") -> str:
    return (f"SELECT qid AS example_id, CAST(rank AS BIGINT) AS rank, chunk_id, origin_doc_id, round(score, 6) AS score"
            f"{extra} FROM {t}_rows")


sql("similarity_search", S.with_(*_rows_sql("base")) + _hits_select())
sql("multi_query", S.with_(*_rows_sql("multi_query")) + _hits_select())
sql("step_back", S.with_(*_rows_sql("step_back")) + _hits_select())
sql("hyde", S.with_(*_rows_sql("hyde")) + _hits_select())
sql("compress_contexts", S.with_(*_rows_sql("compression")) +
    "SELECT qid AS example_id, CAST(rank AS BIGINT) AS rank, chunk_id, page_content FROM r_rows")
sql("compare_chunk_sizes", S.with_(*_rows_sql("base", 1000, "a"), S.fixed_chunks_cte("ch200", 200),
                                   S.embed_ctes("cv200", "ch200", "chunk_id", "page_content"),
                                   *S.rows_ctes("b", "base", "ch200", "cv200"))
    + _hits_select("a", ", 'Baseline' AS evaluator") + "\nUNION ALL\n" + _hits_select("b", ", 'Baseline 200' AS evaluator"))
sql("retrieve_batch", S.with_(*_rows_sql("base"), *S.answer_ctes("r")) + """
SELECT qid AS example_id, CAST(len(contexts) AS BIGINT) AS n_contexts, array_to_string(oids, ',') AS origin_ids,
       context FROM r_ans""")
sql("search_with_scores", """
SELECT vec_id, CAST(rank AS BIGINT) AS rank, hit_id, round(cosine, 6) AS cosine, round(l2_sq, 6) AS l2_sq FROM (
  SELECT q.vec_id, c.vec_id AS hit_id,
         list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS cosine,
         list_sum(list_transform(list_zip(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])),
                                 lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS l2_sq,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_sum(list_transform(list_zip(CAST(q.embedding AS DOUBLE[]),
                                 CAST(c.embedding AS DOUBLE[])), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9), c.vec_id) AS rank
  FROM embeddings q, embeddings c WHERE q.vec_id <> c.vec_id) WHERE rank <= 4""")

sql("cell_search", """
SELECT vec_id, CAST(rank AS BIGINT) AS rank, hit_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 9) DESC, hit_id) AS rank FROM (
    SELECT q.vec_id, c.vec_id AS hit_id, list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS score
    FROM embeddings q, embeddings c WHERE q.vec_id <> c.vec_id)) WHERE rank <= 4""")


def _tmpl_sql(template: str, **cols: str) -> str:
    import re as _re
    parts = []
    for p in _re.split(r"(\{[a-z_]+\})", template):
        if p.startswith("{") and p[1:-1] in cols:
            parts.append(f"coalesce({cols[p[1:-1]]}, '')")
        elif p:
            parts.append("'" + p.replace("'", "''") + "'")
    return " || ".join(parts)


from tessera.operators import generate as _G  # noqa: E402

sql("render_prompt", f"""
SELECT item_id AS example_id,
  {_tmpl_sql(_G.BASE_PROMPT, context='text', question="text")} AS base,
  {_tmpl_sql(_G.MULTI_QUERY_PROMPT, question="text")} AS multi_query,
  {_tmpl_sql(_G.STEP_BACK_PROMPT, question="text")} AS step_back,
  {_tmpl_sql(_G.STEP_BACK_ANSWER_PROMPT, context='text', question="text")} AS step_back_answer,
  {_tmpl_sql(_G.HYDE_PROMPT, question="text")} AS hyde
FROM benchmark""")

sql("generate_batch", S.with_(*_rows_sql("base"), *S.answer_ctes("r")) + "SELECT qid AS example_id, answer FROM r_ans")
sql("rag_answers", S.with_(*_rows_sql("step_back"), *S.answer_ctes("r")) +
    "SELECT qid AS example_id, question, context, answer FROM r_ans")

sql("spot_check", S.with_(*_rows_sql("base"), *S.answer_ctes("r")) + """
SELECT qid AS example_id, question, answer FROM r_ans
WHERE question IN (SELECT arg_min(text, item_id) FROM benchmark UNION ALL SELECT arg_max(text, item_id) FROM benchmark)""")


# ---------------------------------------------------------------- G
def _run_sql(t: str, strategy: str, size: int) -> list[str]:
    return [S.fixed_chunks_cte(f"{t}_ch", size), S.embed_ctes(f"{t}_cv", f"{t}_ch", "chunk_id", "page_content"),
            *S.rows_ctes(t, strategy, f"{t}_ch", f"{t}_cv"), *S.answer_ctes(t), *S.result_ctes(t)]


_G_BASE = [*_BASE, _QS, _MAPPED]
_RES_COLS = ("example_id, answer_correctness, answer_relevancy, answer_similarity, context_precision, "
             "context_entity_recall, rr, hit_at_2")

sql("build_eval_dataset", S.with_(*_G_BASE, *_run_sql("r", "base", 1000)) + """
SELECT example_id, question, answer, ground_truth, best_match_id, CAST(len(contexts) AS BIGINT) AS n_contexts,
       array_to_string(oids, ',') AS origin_ids, CAST(NULL AS VARCHAR) AS question_complexity FROM r_ds""")
sql("reciprocal_rank", S.with_(*_G_BASE, *_run_sql("r", "base", 1000)) + "SELECT example_id, rr, hit_at_2 FROM r_res")
sql("hit_at_k", S.with_(*_G_BASE, *_run_sql("r", "base", 200)) + """
SELECT example_id, CASE WHEN p > 0 AND p <= 1 THEN 1.0 ELSE 0.0 END AS hit_at_1,
       CASE WHEN p > 0 AND p <= 2 THEN 1.0 ELSE 0.0 END AS hit_at_2, CASE WHEN p > 0 AND p <= 4 THEN 1.0 ELSE 0.0 END AS hit_at_4
FROM (SELECT example_id, CASE WHEN best_match_id IS NULL THEN 0 ELSE coalesce(list_position(oids, best_match_id), 0) END AS p
      FROM r_ds)""")
sql("judge_metrics", S.with_(*_G_BASE, *_run_sql("r", "base", 1000)) + f"SELECT {_RES_COLS}, reasoning FROM r_res")
sql("run_evaluation", ORACLE["judge_metrics"])
sql("metric_summary", S.with_(*_G_BASE, *_run_sql("r", "base", 1000)) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS std FROM r_res"
    for m in _RES_COLS.split(", ")[1:]))
sql("metric_summary_lineitem", "\nUNION ALL\n".join(
    f"SELECT '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS std FROM lineitem"
    for m in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))

_RUNS = (("Baseline", "base", 1000), ("Experiment 1: Baseline 200", "base", 200),
         ("Experiment 2: Multi-Query Retrieval", "multi_query", 1000), ("Experiment 3: Step Back", "step_back", 1000),
         ("Experiment 4: HyDE", "hyde", 1000), ("Experiment 5: Contextual Compression", "compression", 1000))
_DISPLAY = {"answer_correctness": "Answer Correctness", "answer_relevancy": "Answer Relevancy",
            "answer_similarity": "Answer Similarity", "context_precision": "Context Precision",
            "context_entity_recall": "Context Entity Recall", "rr": "Reciprocal Rank", "hit_at_2": "Hit@2"}
_ALL_RUNS = [c for i, (_, st, sz) in enumerate(_RUNS) for c in _run_sql(f"e{i}", st, sz)]
_COMBINED = "combined AS (" + "\nUNION ALL\n".join(
    f"SELECT example_id, " + ", ".join(f'{k} AS "{v}"' for k, v in _DISPLAY.items()) + f", '{name}' AS evaluator FROM e{i}_res"
    for i, (name, _, _) in enumerate(_RUNS)) + ")"
_RUNS_WITH = S.with_(*_G_BASE, *_ALL_RUNS, _COMBINED)
_ALL_DISPLAY = list(_DISPLAY.values())
_JUDGE_DISPLAY = _ALL_DISPLAY[:5]


def _melt(metrics) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT evaluator, '{m}' AS metric, CASE WHEN isnan("{m}") THEN NULL ELSE "{m}" END AS value FROM combined"""
        for m in metrics)


sql("combine_runs", _RUNS_WITH + "SELECT * FROM combined")
sql("melt_metrics", _RUNS_WITH + _melt(_JUDGE_DISPLAY))


def _cmp(center: str) -> str:
    return _RUNS_WITH + f""", lg AS ({_melt(_ALL_DISPLAY)})
SELECT evaluator, metric, round(v, 6) AS value, round(sd, 6) AS std, round(greatest(0.0, v - sd), 6) AS lower,
       round(least(1.0, v + sd), 6) AS upper
FROM (SELECT evaluator, metric, {center}(value) AS v, stddev_samp(value) AS sd FROM lg GROUP BY evaluator, metric)"""


sql("comparative_stats", _cmp("avg"))
sql("comparative_stats_median", _cmp("median"))


def _box(src: str, by: list[str], value: str) -> str:
    b = ", ".join(by)
    return f"""base AS (SELECT {b}, CAST({value} AS DOUBLE) AS v FROM {src} WHERE {value} IS NOT NULL AND NOT isnan(CAST({value} AS DOUBLE))),
q AS (SELECT {b}, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM base GROUP BY {b}),
w AS (SELECT {", ".join("base." + x for x in by)}, min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS wlo,
             max(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whi,
             sum(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS nout
      FROM base JOIN q USING ({b}) GROUP BY {", ".join("base." + x for x in by)})
SELECT {b}, CAST(n AS BIGINT) AS n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(wlo, 6) AS whisker_lo, round(whi, 6) AS whisker_hi, CAST(nout AS BIGINT) AS n_outliers
FROM q JOIN w USING ({b})"""


sql("box_stats", _RUNS_WITH + f", lg AS ({_melt(_JUDGE_DISPLAY)}),\n" + _box("lg", ["evaluator", "metric"], "value"))
sql("box_stats_lineitem", "WITH " + _box("lineitem", ["l_returnflag"], "l_extendedprice"))

sql("mean_pair", _RUNS_WITH + """
SELECT evaluator, round(avg("Answer Correctness"), 6) AS mean_x, round(avg("Context Precision"), 6) AS mean_y,
       'precision' AS pair FROM combined GROUP BY evaluator
UNION ALL
SELECT evaluator, round(avg("Answer Correctness"), 6), round(avg("Reciprocal Rank"), 6), 'rr' FROM combined GROUP BY evaluator""")

sql("system_confidence", _RUNS_WITH + f""", lg AS ({_melt(_ALL_DISPLAY)}),
sd AS (SELECT evaluator, metric, stddev_samp(value) AS s FROM lg GROUP BY evaluator, metric),
av AS (SELECT evaluator, avg(s) AS avg_std FROM sd GROUP BY evaluator),
cm AS (SELECT evaluator, avg("Answer Correctness") AS cm FROM combined GROUP BY evaluator)
SELECT evaluator, round(avg_std, 6) AS avg_std, round((SELECT max(avg_std) FROM av) + 1 - avg_std, 6) AS system_confidence,
       round(cm, 6) AS correctness_mean FROM av JOIN cm USING (evaluator)""")

_SLOTS = [k for k, c in quotas(10, DEFAULT_DISTRIBUTION) for _ in range(c)]
sql("allocate_testset", f"""
WITH first AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 5)),
m AS (SELECT count(*) AS m FROM first),
slots AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{k}')" for i, k in enumerate(_SLOTS))}) t(slot, kind)),
s AS (SELECT slot, kind, CAST(('0x' || substr(sha256('42:' || CAST(slot AS VARCHAR)), 1, 8))::UBIGINT % m AS BIGINT) AS pos, m
      FROM slots, m WHERE m > 0)
SELECT CAST(s.slot AS INTEGER) AS slot, s.kind, f1.doc_id AS doc, f2.doc_id AS second_doc
FROM s JOIN first f1 ON f1.pos = s.pos
LEFT JOIN first f2 ON s.kind = 'multi_context' AND f2.pos = (s.pos + 1) % s.m""")

_KINDS40 = [k for k, c in quotas(40, DEFAULT_DISTRIBUTION) for _ in range(c)]
_SENTENCES = "list_filter(list_transform(regexp_extract_all({t}, '[^.!?]+[.!?]*'), lambda s: trim(s, ' ')), lambda s: s <> '')"
sql("testset_questions", f"""
WITH first AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, {_SENTENCES.format(t="text")}[1] AS s
  FROM (SELECT doc_id, text FROM documents WHERE length(trim(coalesce(text, ''), ' ')) > 0 ORDER BY doc_id LIMIT 20)),
topics AS (SELECT *, array_to_string(string_split(s, ' ')[1:8], ' ') AS topic FROM first),
m AS (SELECT count(*) AS m FROM first),
slots AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{k}')" for i, k in enumerate(_KINDS40))}) t(slot, kind)),
tries AS (
  SELECT slot, kind, r AS round, m, CAST(('0x' || substr(sha256('42:' || CAST(slot AS VARCHAR) || CASE WHEN r = 0 THEN '' ELSE ':' || r END), 1, 8))::UBIGINT
         % m AS BIGINT) AS pos FROM slots, m, range(8) x(r) WHERE m > 0),
made AS (
  SELECT t.slot, t.kind, t.round, a.doc_id AS doc, b.doc_id AS second_doc, a.topic AS one, b.topic AS two, a.s AS s1, b.s AS s2
  FROM tries t JOIN topics a ON a.pos = t.pos LEFT JOIN topics b ON t.kind = 'multi_context' AND b.pos = (t.pos + 1) % t.m),
good AS (SELECT * FROM made WHERE length(one) >= 10 AND (kind <> 'multi_context' OR length(two) >= 10)),
best AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY slot ORDER BY round) = 1)
SELECT CAST(slot AS INTEGER) AS slot, kind, doc, second_doc, CASE kind WHEN 'reasoning' THEN 'Why does the text say: ' || one || '?'
       WHEN 'multi_context' THEN 'What connects: ' || one || ' / ' || two || '?' ELSE 'What does the text say about: ' || one || '?' END AS question,
       s1 || CASE WHEN s2 IS NULL THEN '' ELSE ' ' || s2 END AS ground_truth,
       CAST(CASE WHEN kind = 'multi_context' THEN 2 ELSE 1 END AS BIGINT) AS n_contexts, CAST(round AS BIGINT) AS round FROM best""")
