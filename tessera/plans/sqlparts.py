"""Shared DuckDB SQL fragments for the oracle queries (same definitions as the Spark operators)."""

from __future__ import annotations

ARTICLES = """articles AS (
  SELECT doc_id AS row_id, split_part(text, chr(10), 1) AS title, CAST(NULL AS VARCHAR) AS date,
         CAST(NULL AS VARCHAR) AS author, string_split(text, chr(10)) AS content, source AS domain,
         'https://' || source || '.example/a/' || CAST(doc_id AS VARCHAR) AS url, lang AS label_language
  FROM documents)"""

PY_WS = "\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<.*?>', '', 'g')"


def strip_special(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9{PY_WS}]', '', 'g')"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{PY_WS}]+|[{PY_WS}]+$', '', 'g')"


def clean_text(content_list: str) -> str:
    return strip_special(strip_tags(f"array_to_string({content_list}, ' ')"))


def hash_mod(hexpr: str, modulus: int = 10**8) -> str:
    acc = "CAST(0 AS BIGINT)"
    for i in range(8):
        word = f"CAST(('0x' || substr({hexpr}, {8 * i + 1}, 8))::UBIGINT AS BIGINT)"
        acc = f"(({acc} * 4294967296 + {word}) % {modulus})"
    return acc


def content_id(x: str) -> str:
    return hash_mod(f"sha256({py_strip(f'lower({x})')})")


def content_key(x: str) -> str:
    return f"sha256({py_strip(f'lower({x})')})"


def word_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{PY_WS}]+'))"


def trigrams(src: str, key_expr: str, alias: str, text: str) -> str:
    """({alias}, gram) rows: trigrams of space-padded lower-cased letter runs."""
    return f"""SELECT {alias}, unnest(list_transform(range(1, length(w) + 1),
                      lambda i: substring(' ' || w || ' ', i, 3))) AS gram
      FROM (SELECT {key_expr} AS {alias}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}]+')) AS w
            FROM {src})
      WHERE w <> ''"""


def language_profile_ctes(train_src: str = "documents", text: str = "text", lang: str = "lang") -> str:
    return f"""lp_grams AS ({trigrams(f"(SELECT * FROM {train_src} WHERE {lang} IS NOT NULL)", lang, "lang", text)}),
lp_cnt AS (SELECT lang, gram, count(*) AS c FROM lp_grams GROUP BY lang, gram),
lp_voc AS (SELECT count(DISTINCT gram) AS v FROM lp_cnt),
lp_k AS (SELECT lang, CAST(round(ln(sum(c) + (SELECT v FROM lp_voc)) * 1000000) AS BIGINT) AS k
         FROM lp_cnt GROUP BY lang),
lp_w AS (SELECT lang, gram, CAST(round(ln(c + 1) * 1000000) AS BIGINT) AS w FROM lp_cnt),
lp_vocab AS (SELECT DISTINCT gram FROM lp_cnt)"""


def detect_ctes(name: str, src: str, key: str, text: str) -> str:
    """CTE ``{name}`` = ({key}, language) for every row of src; needs language_profile_ctes."""
    return f"""{name}_f AS ({trigrams(src, key, "k", text)}),
{name}_n AS (SELECT k, count(*) AS n FROM {name}_f JOIN lp_vocab USING (gram) GROUP BY k),
{name}_s AS (SELECT k, lang, sum(w) AS s FROM {name}_f JOIN lp_w USING (gram) GROUP BY k, lang),
{name}_sc AS (SELECT kn.k, lk.lang, coalesce(s.s, 0) - kn.n * lk.k AS score
              FROM {name}_n kn CROSS JOIN lp_k lk LEFT JOIN {name}_s s ON s.k = kn.k AND s.lang = lk.lang),
{name}_b AS (SELECT k, lang FROM (SELECT k, lang, row_number() OVER (PARTITION BY k ORDER BY score DESC, lang DESC) AS rn
             FROM {name}_sc) WHERE rn = 1),
{name} AS (SELECT src.{key}, b.lang AS language FROM {src} src LEFT JOIN {name}_b b ON b.k = src.{key})"""


def clean_corpus_ctes() -> str:
    """``clean`` = CLEAN_ARTICLE rows of the documents stand-in; needs ARTICLES."""
    return f"""{language_profile_ctes()},
{detect_ctes("art_lang", "(SELECT row_id, array_to_string(content, chr(10)) AS raw FROM articles)", "row_id", "raw")},
art_clean AS (SELECT a.*, {clean_text("a.content")} AS cleaned FROM articles a),
art_en AS (SELECT c.*, l.language FROM art_clean c JOIN art_lang l USING (row_id) WHERE l.language = 'en'),
art_keep AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cleaned ORDER BY row_id) AS rn FROM art_en)
             WHERE rn = 1),
clean AS (SELECT row_id, cleaned AS content, language, title, date, author, domain, url,
                 {content_id("cleaned")} AS id, {content_key("cleaned")} AS doc_key FROM art_keep)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- retrieval / evaluation fragments
def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


def sentences(x: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all({x}, '[^.!?]+[.!?]*'), lambda s: trim(s)), lambda s: s <> '')"


def entities(x: str) -> str:
    return (f"list_distinct(list_filter(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+'), "
            f"lambda t: regexp_full_match(t, '\\p{{Lu}}[\\p{{L}}\\p{{N}}]+|\\p{{N}}+')))")


def embed_ctes(name: str, src: str, keys: str, text: str, dim: int = 64) -> str:
    """CTE ``{name}`` = ({keys}, emb FLOAT[]) hashed bag-of-words vectors."""
    return f"""{name}_b AS (SELECT {keys}, list_transform({tokens(text)},
                lambda t: CAST((('0x' || substr(sha256(t), 1, 8))::UBIGINT % {dim}) AS INTEGER)) AS bk FROM {src}),
{name}_c AS (SELECT {keys}, CASE WHEN bk IS NULL THEN NULL ELSE list_transform(range({dim}),
                lambda i: CAST(len(list_filter(bk, lambda z: z = i)) AS DOUBLE)) END AS cnt FROM {name}_b),
{name} AS (SELECT {keys}, list_transform(cnt, lambda c: CAST(CASE WHEN nrm > 0 THEN c / nrm ELSE c END AS FLOAT)) AS emb
           FROM (SELECT *, sqrt(list_sum(list_transform(cnt, lambda c: c * c))) AS nrm FROM {name}_c))"""


def dot(a: str, b: str) -> str:
    return f"list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def fixed_chunks_cte(name: str, size: int, overlap: int = 0, src: str = "clean") -> str:
    step = size - overlap
    return f"""{name} AS (
  SELECT CAST(row_id AS VARCHAR) || '-' || CAST(s // {step} AS VARCHAR) AS chunk_id, CAST(id AS BIGINT) AS origin_doc_id,
         CAST(s // {step} AS BIGINT) AS chunk_no, substring(content, s + 1, {size}) AS page_content,
         coalesce(url, 'None') AS url, coalesce(domain, 'None') AS domain, coalesce(title, 'None') AS title,
         coalesce(author, 'None') AS author, coalesce(date, 'None') AS date
  FROM (SELECT *, unnest(CASE WHEN length(content) > 0
                              THEN generate_series(0, greatest(length(content) - {overlap} - 1, 0), {step})
                              ELSE [] END) AS s FROM {src}))"""


def topk_cte(name: str, qv: str, cv: str, k: int = 4) -> str:
    return f"""{name} AS (SELECT qid, chunk_id, score, rank FROM (
    SELECT q.qid, c.chunk_id, {dot('q.emb', 'c.emb')} AS score,
           row_number() OVER (PARTITION BY q.qid ORDER BY round({dot('q.emb', 'c.emb')}, 9) DESC, c.chunk_id) AS rank
    FROM {qv} q, {cv} c) WHERE rank <= {k})"""


def step_back_text(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace({x}, '\\p{{Lu}}[\\p{{L}}\\p{{N}}]*|\\p{{N}}[\\p{{N}}.,]*', '', 'g'), "
            f"'\\s+', ' ', 'g'))")


def rows_ctes(t: str, strategy: str, ch: str, cv: str, k: int = 4) -> list[str]:
    """CTE ``{t}_rows`` = (qid, rank, chunk_id, origin_doc_id, page_content, score) for one strategy."""
    out: list[str] = []
    if strategy == "hyde":  # the extractive answer over the question's own hits is searched
        b = f"{t}_b"
        out += [*rows_ctes(b, "base", ch, cv, k), *answer_ctes(b),
                f"{t}_hq AS (SELECT qid, coalesce(answer, question) AS text FROM {b}_ans)",
                embed_ctes(f"{t}_qv", f"{t}_hq", "qid", "text"), topk_cte(f"{t}_hits", f"{t}_qv", cv, k)]
        hits = f"{t}_hits"
    elif strategy in ("base", "compression"):
        out += [embed_ctes(f"{t}_qv", "qs", "qid", "question"), topk_cte(f"{t}_hits", f"{t}_qv", cv, k)]
        hits = f"{t}_hits"
    elif strategy == "multi_query":
        def variants(x: str) -> str:
            return (f"list_concat([{x}, array_to_string(list_sort(list_distinct({tokens(x)})), ' ')], "
                    f"{sentences(x)})")
        out.append(f"""{t}_var AS (SELECT CAST(qid AS VARCHAR) || ':' || CAST(generate_subscripts(v, 1) - 1 AS VARCHAR) AS qid, unnest(v) AS text FROM (
            SELECT qid, flatten(list_transform({variants('question')}, lambda vq: {variants('vq')})) AS v FROM qs))""")
        out += [embed_ctes(f"{t}_qv", f"{t}_var", "qid", "text"), topk_cte(f"{t}_vh", f"{t}_qv", cv, k)]
        out.append(f"""{t}_g AS (SELECT CAST(split_part(v.qid, ':', 1) AS BIGINT) AS qid, min(chunk_id) AS chunk_id,
            min(rank) AS best_rank, max(score) AS best_score FROM {t}_vh v JOIN {ch} c USING (chunk_id)
            GROUP BY split_part(v.qid, ':', 1), page_content, origin_doc_id, url, domain, title, author, date)""")
        out.append(f"""{t}_hits AS (SELECT qid, chunk_id, best_score AS score,
            row_number() OVER (PARTITION BY qid ORDER BY best_rank, round(best_score, 9) DESC, chunk_id) AS rank FROM {t}_g)""")
        hits = f"{t}_hits"
    elif strategy == "step_back":
        out += [embed_ctes(f"{t}_qv", "qs", "qid", "question"), topk_cte(f"{t}_n", f"{t}_qv", cv, k)]
        out.append(f"{t}_sbq AS (SELECT qid, {step_back_text('question')} AS text FROM qs)")
        out += [embed_ctes(f"{t}_sv", f"{t}_sbq", "qid", "text"), topk_cte(f"{t}_s", f"{t}_sv", cv, k)]
        out.append(f"""{t}_both AS (SELECT h.*, 0 AS src_ord, c.page_content FROM {t}_n h JOIN {ch} c USING (chunk_id)
            UNION ALL SELECT h.*, 1 AS src_ord, c.page_content FROM {t}_s h JOIN {ch} c USING (chunk_id))""")
        out.append(f"""{t}_first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, page_content
            ORDER BY src_ord, rank) AS rn FROM {t}_both) WHERE rn = 1)""")
        out.append(f"""{t}_hits AS (SELECT qid, chunk_id, score,
            row_number() OVER (PARTITION BY qid ORDER BY src_ord, rank) AS rank FROM {t}_first)""")
        hits = f"{t}_hits"
    else:
        raise ValueError(strategy)
    out.append(f"""{t}_r0 AS (SELECT h.qid, h.rank, h.chunk_id, c.origin_doc_id, c.page_content, h.score
        FROM {hits} h JOIN {ch} c USING (chunk_id))""")
    if strategy == "compression":
        kept = (f"trim(array_to_string(list_transform(list_filter(regexp_extract_all(r.page_content, '[^.!?]+[.!?]*'), "
                f"lambda s: len(list_intersect({tokens('s')}, {tokens('q.question')})) >= 1), lambda s: trim(s)), ' '))")
        out.append(f"""{t}_r1 AS (SELECT r.qid, r.rank, r.chunk_id, r.origin_doc_id, {kept} AS page_content, r.score
            FROM {t}_r0 r JOIN qs q USING (qid))""")
        out.append(f"""{t}_rows AS (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY rank) AS rank, chunk_id,
            origin_doc_id, page_content, score FROM {t}_r1 WHERE length(page_content) > 0)""")
    else:
        out.append(f"{t}_rows AS (SELECT * FROM {t}_r0)")
    return out


def answer_ctes(t: str) -> list[str]:
    """``{t}_ans`` = (qid, question, contexts, oids, context, answer) with the extractive default answer."""
    return [
        f"""{t}_pk AS (SELECT q.qid, q.question,
              coalesce(list(r.page_content ORDER BY r.rank) FILTER (WHERE r.qid IS NOT NULL), []) AS contexts,
              coalesce(list(r.origin_doc_id ORDER BY r.rank) FILTER (WHERE r.qid IS NOT NULL), []) AS oids
            FROM qs q LEFT JOIN {t}_rows r USING (qid) GROUP BY q.qid, q.question)""",
        f"""{t}_ans AS (SELECT *, struct_extract(list_max(list_transform({sentences('context')}, lambda s, i:
              {{'sc': len(list_intersect({tokens('s')}, {tokens('question')})), 'neg': -i, 'txt': s}})), 'txt') AS answer
            FROM (SELECT *, array_to_string(contexts, chr(10) || chr(10)) AS context FROM {t}_pk))""",
    ]


def supported(stmt: str, text_tokens: str) -> str:
    st = f"list_distinct({tokens(stmt)})"
    return f"(len({st}) > 0 AND len(list_intersect({st}, {text_tokens})) >= 0.5 * len({st}))"


def result_ctes(t: str) -> list[str]:
    """``{t}_res``: RESULT metrics per example for run ``t`` (needs ``mapped`` and ``{t}_ans``)."""
    pos = "(CASE WHEN best_match_id IS NULL THEN 0 ELSE coalesce(list_position(oids, best_match_id), 0) END)"
    ds = f"""{t}_ds AS (SELECT m.example_id, m.question, a.answer, a.contexts, m.ground_truth, a.oids, m.best_match_id
        FROM mapped m LEFT JOIN {t}_ans a ON a.qid = m.example_id)"""
    emb = [embed_ctes(f"{t}_ea", f"{t}_ds", "example_id", "answer"),
           embed_ctes(f"{t}_eg", f"{t}_ds", "example_id", "ground_truth"),
           embed_ctes(f"{t}_eq", f"{t}_ds", "example_id", "question")]
    regen = [f"{t}_rq AS (SELECT example_id, unnest({sentences('answer')}) AS gq FROM {t}_ds)",
             embed_ctes(f"{t}_er", f"{t}_rq", "example_id, gq", "gq"),
             f"""{t}_rel AS (SELECT r.example_id, avg({dot('q.emb', 'r.emb')}) AS rel FROM {t}_er r
                 JOIN {t}_eq q USING (example_id) GROUP BY r.example_id)"""]
    cp = [f"""{t}_v AS (SELECT example_id, i AS rank, CASE WHEN oids[i] = best_match_id THEN 1 ELSE 0 END AS v
              FROM {t}_ds, range(1, len(oids) + 1) t(i))""",
          f"""{t}_cp AS (SELECT example_id, CASE WHEN sum(v) > 0 THEN sum(pk * v) / sum(v) ELSE 0.0 END AS cp FROM
              (SELECT *, sum(v) OVER (PARTITION BY example_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                         / rank AS pk FROM {t}_v) GROUP BY example_id)"""]
    gt_t, an_t = tokens("d.ground_truth"), tokens("d.answer")
    tp = f"len(list_filter({sentences('d.answer')}, lambda s: {supported('s', gt_t)}))"
    fp = f"(len({sentences('d.answer')}) - {tp})"
    fn = f"len(list_filter({sentences('d.ground_truth')}, lambda s: NOT {supported('s', an_t)}))"
    sim = f"round({dot('ea.emb', 'eg.emb')}, 6)"
    at, qt = f"list_distinct({tokens('d.answer')})", f"list_distinct({tokens('d.question')})"
    ct = f"list_distinct({tokens(chr(39) + ' ' + chr(39) + ' || ' + 'array_to_string(d.contexts, ' + chr(39) + ' ' + chr(39) + ')')})"
    ct = f"list_distinct({tokens('array_to_string(d.contexts, ' + chr(39) + ' ' + chr(39) + ')')})"
    gte, cte = entities("d.ground_truth"), entities("array_to_string(d.contexts, chr(10) || chr(10))")
    res = f"""{t}_res AS (SELECT d.example_id, sim AS answer_similarity,
          round(coalesce(rl.rel, 0.0), 6) AS answer_relevancy,
          round(0.75 * (CASE WHEN tp + 0.5 * (fp + fn) > 0 THEN tp / (tp + 0.5 * (fp + fn)) ELSE 0.0 END) + 0.25 * sim, 6)
            AS answer_correctness,
          round(coalesce(cp.cp, 0.0), 6) AS context_precision,
          CASE WHEN len({gte}) > 0 THEN round(len(list_intersect({gte}, {cte})) / len({gte}), 6) END AS context_entity_recall,
          printf('The answer uses %d of %d question tokens and %d of its %d tokens occur in the contexts.',
                 len(list_intersect({at}, {qt})), len({qt}), len(list_intersect({at}, {ct})), len({at})) AS reasoning,
          CASE WHEN {pos} > 0 THEN 1.0 / {pos} ELSE 0.0 END AS rr,
          CASE WHEN {pos} > 0 AND {pos} <= 2 THEN 1.0 ELSE 0.0 END AS hit_at_2
        FROM (SELECT d.*, {sim} AS sim, {tp} AS tp, {fp} AS fp, {fn} AS fn FROM {t}_ds d
              JOIN {t}_ea ea USING (example_id) JOIN {t}_eg eg USING (example_id)) d
        LEFT JOIN {t}_rel rl USING (example_id) LEFT JOIN {t}_cp cp USING (example_id))"""
    return [ds] + emb + regen + cp + [res]
