"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tessera.llm import licenses as lic
from tessera.llm.mixing import OFFSETS


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def mixing_sql(docs: str = "documents", key: str = "doc_id", seed: int = 1, cap: int = 3) -> str:
    """Common table expressions ending in ``plan`` (key, source, size, source_size, target, copies)."""
    return f"""
WITH sized AS (
  SELECT {key} AS k, source, length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{seed}|' || coalesce(CAST({key} AS VARCHAR), '')) AS tie FROM {docs}),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight, {cap} * source_size AS cap FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM weighed WINDOW b AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
settled AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), (SELECT level FROM settled) * weight) AS target,
         CAST(CAST('0x' || substr(md5('{seed}|offset|' || coalesce(source, '')), 1, 8) AS BIGINT) AS DOUBLE)
           / (4294967296.0::DOUBLE * {OFFSETS}) AS start FROM weighed),
ranked AS (
  SELECT s.k, s.source, s.size, t.source_size, t.target, t.start,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS r,
         row_number() OVER (PARTITION BY s.source ORDER BY s.tie, s.k, s.size) AS rank
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
tried AS (
  SELECT source, start + j / {OFFSETS} AS off, abs(sum(size * (floor(start + j / {OFFSETS} + rank * r)
         - floor(start + j / {OFFSETS} + (rank - 1) * r))) - any_value(target)) AS miss, j
  FROM ranked CROSS JOIN (SELECT unnest(range({OFFSETS})) AS j) GROUP BY source, start, j),
chosen AS (SELECT source, arg_min(off, miss + j * 1e-9) AS off FROM tried GROUP BY source),
plan AS (
  SELECT r.k, r.source, r.size, r.source_size, r.target,
         CAST(floor(c.off + r.rank * r.r) - floor(c.off + (r.rank - 1) * r.r) AS BIGINT) AS copies
  FROM ranked r JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source)
"""


def licenses_sql(docs: str = "documents") -> str:
    """The same three readings and the same covering from the longest rule down, one replaced text per rule."""
    known, patterns = lic.known_sentences(lic.RULES)
    table = "[" + ", ".join(map(_quoted, known)) + "]"
    rules: dict[str, list[str]] = {}
    for name, ids in sorted(patterns, key=lambda x: -x[1].count(",")):
        rules.setdefault("," + ids.strip(",").replace(",", ",,") + ",", []).append(name)

    def numbers(text: str, end: str = lic.SENTENCE_END) -> str:
        return (f"array_to_string(list_filter(list_transform(regexp_split_to_array({text}, {_quoted(end)}), "
                f"lambda s: coalesce(list_position({table}, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), 0)), lambda n: n > 0), ',')")

    low = "lower(text)"
    for pattern, spelt in lic.SPELLINGS:
        low = f"regexp_replace({low}, {_quoted(pattern)}, {_quoted(spelt.format(chr(92) + '1', chr(92) + '2'))}, 'g')"
    mark = "chr(57344)"  # a character of private use stands before each start of the clause
    named = (f"array_to_string(list_transform(string_split(regexp_replace(t, '({lic.HOLDER_START})', {mark} || '\\1', 'g'), {mark}), "
             f"lambda s: regexp_replace(s, '(?s)\\A{lic.HOLDER_START}(.+?){lic.HOLDER_END}', '{lic.NAMED.format(chr(92) + '1')}')), '')")
    keys = "abc"
    texts = [numbers("named"), numbers("named", lic.PARAGRAPH_END), numbers(f"regexp_replace(named, '{lic.WRAP}', ' ', 'g')")]
    seen = [f"CASE WHEN hit THEN {x} ELSE '' END AS {k}" for k, x in zip(keys, texts)]
    part = {k: " OR ".join(f"(contains(w{j}, w{k}) AND ({j} <> {k} OR {str(j > k).lower()}))" for j in keys if j != k) for k in keys}
    steps = "".join(f",\nr{n + 1} AS (SELECT * REPLACE (replace(rest, '{ids}', ',0,') AS rest, CASE WHEN contains(rest, '{ids}') "
                    f"THEN list_concat(names, [{', '.join(map(_quoted, names))}]) ELSE names END AS names) FROM r{n})"
                    for n, (ids, names) in enumerate(rules.items()))
    return f"""
WITH low AS (SELECT doc_id, regexp_matches(lower(text), '{lic.RAW_HINT}') AS hit, {low} AS t FROM {docs}),
named AS (SELECT *, {named} AS named FROM low),
seen AS (SELECT doc_id, {', '.join(seen)} FROM named),
whole AS (SELECT *, {', '.join(f"',' || replace({k}, ',', ',,') || ',' AS w{k}" for k in keys)} FROM seen),
r0 AS (
  SELECT doc_id, coalesce({', '.join(f"nullif({k}, '')" for k in keys)}, '') AS ids, CAST([] AS VARCHAR[]) AS names,
         concat_ws('|', {', '.join(f"CASE WHEN NOT ({part[k]}) THEN w{k} END" for k in keys)}) AS rest FROM whole){steps}
SELECT doc_id, ids AS sentence_ids, CAST(CASE WHEN ids = '' THEN 0 ELSE len(string_split(ids, ',')) END AS BIGINT) AS n_sentences,
       CASE WHEN ids = '' THEN '' ELSE array_to_string(list_sort(list_distinct(names)), ',') END AS licenses
FROM r{len(rules)}"""


MIXING = mixing_sql() + "SELECT k AS doc_id, size, source_size, target, copies, copies * size AS taken FROM plan"
LICENSES = licenses_sql()

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.n AS a, b.n AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.n <> b.n
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT n AS a, n AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT r.a, min(v.vec_id) AS component_id FROM reach r JOIN v ON r.b = v.n GROUP BY r.a),
deg AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(d.n_links, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN comp c ON v.n = c.a LEFT JOIN deg d ON v.n = d.a"""

NGRAMS = """
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT n, doc_id, w, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
         ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s FROM w),
grams AS (SELECT n, unnest(s) AS g FROM sets),
counted AS (SELECT a.n AS a, b.n AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.n < b.n GROUP BY a.n, b.n),
pairs AS (
  SELECT x.a, x.b FROM counted x JOIN sets p ON x.a = p.n JOIN sets q ON x.b = q.n WHERE x.c >= 0.8 * (len(p.s) + len(q.s) - x.c) - 1e-9),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT n AS a, n AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT r.a, min(w.doc_id) AS component_id FROM reach r JOIN w ON r.b = w.n GROUP BY r.a),
deg AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
classes AS (SELECT n, CASE WHEN len(w) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY w) END AS class_id FROM w)
SELECT w.doc_id, k.class_id, CAST(coalesce(d.n_links, 0) AS BIGINT) AS n_links, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN comp c ON w.n = c.a JOIN classes k ON k.n = w.n LEFT JOIN deg d ON d.a = w.n"""

EXACT = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t"""

COLLOCATIONS = """
WITH low AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM low),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
runs AS (
  SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda m: list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])))) AS p
  FROM w),
f AS (SELECT lang, p, count(*) AS f FROM runs GROUP BY lang, p HAVING count(*) >= 100),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, l.f AS l, r.f AS r, t.n, CAST(1000 * CAST(c.f AS HUGEINT) * t.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1) c JOIN total t USING (lang)
  JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:]),
best AS (SELECT DISTINCT ON (lang, p) * FROM cuts ORDER BY lang, p, score, k),
held AS (
  SELECT lang, p[1:len(p) - 1] AS p, f FROM f WHERE len(p) > 2 UNION ALL SELECT lang, p[2:] AS p, f FROM f WHERE len(p) > 2),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = b.lang AND h.p = b.p AND 100 * h.f >= 100 * b.a)),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

DIVERGENCE = """
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
shares AS (
  SELECT *, 1 + CAST(CAST(n + 1 AS HUGEINT) * 1000000000 // (sum(n) OVER s + count(*) OVER s) AS BIGINT) AS p
  FROM cells WINDOW s AS (PARTITION BY lang, source)),
whole AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM cells GROUP BY lang, term),
lang_shares AS (
  SELECT lang, term, 1 + CAST(CAST(n + 1 AS HUGEINT) * 1000000000 // (sum(n) OVER l + count(*) OVER l) AS BIGINT) AS q
  FROM whole WINDOW l AS (PARTITION BY lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT s.lang, s.source, 'term', s.term, (p - q) * (p - q) // q
  FROM shares s JOIN lang_shares l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
