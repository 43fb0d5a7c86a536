"""DuckDB SQL that states the registered queries' results over the same tables."""

from __future__ import annotations

from ..operators.index import QUERY_PREFIX
from ..operators.summarize import PROMPTS
from . import stand_ins as S

#: White space as Unicode has it, for a regular-expression engine whose \s is ASCII.
U = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
BREAK = r"\r\n|[\n\x0B\x0C\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
NON_WORD = r"[^\p{L}\p{M}\p{N}\p{Pc}]+"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{U}+|{U}+$', '', 'g')"


def tokens(x: str) -> str:
    return f"CAST(greatest(1, length(regexp_replace({x}, '{U}+', ' ', 'g')) // 4) AS BIGINT)"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{U}+'), lambda w: w <> '')"


def loose(x: str) -> str:
    split = f"string_split(regexp_replace({x}, '([.?!]){U}+', '\\1' || chr(1), 'g'), chr(1))"
    return f"list_filter(list_transform({split}, lambda y: {strip('y')}), lambda y: y <> '')"


def strict(x: str) -> str:
    split = f"string_split(regexp_replace({x}, '([.?!]){U}+([A-Z0-9\"''])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    return f"list_filter(list_transform({split}, lambda y: {strip('y')}), lambda y: y <> '')"


def hits(x: str) -> str:
    listed = ", ".join(f"'{k}'" for k in S.KEYWORDS)
    return f"CAST(len(list_filter(string_split_regex(lower({x}), '{NON_WORD}'), lambda w: w IN ({listed}))) AS BIGINT)"


def prefix(x: str) -> str:
    return f"list_transform(range(0, len({x}) + 1), lambda i: CAST(COALESCE(list_sum({x}[1:i]), 0) AS BIGINT))"


def numbered(expr: str, name: str, source: str = "documents", key: str = "doc_id") -> str:
    """One row per element of a list."""
    return f"SELECT {key}, CAST(i - 1 AS INT) AS i, l[i] AS {name} FROM (SELECT {key}, {expr} AS l FROM {source}), LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)"


def sentence_chunks(max_tokens: int, limit: str) -> str:
    """The greedy fold over sentences as a recursion; limit is over the projected density d."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, text, {tokens('text')} AS tok, {loose('text')} AS s FROM documents),
m AS (SELECT *, list_transform(s, lambda x: {tokens('x')}) AS tk, list_transform(s, lambda x: {hits('x')}) AS dn FROM d WHERE tok > {max_tokens}),
p AS (SELECT *, {prefix('tk')} AS pt, {prefix('dn')} AS pd FROM m),
r AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS ct, CAST(0 AS BIGINT) AS ad, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS e FROM p
  UNION ALL
  SELECT doc_id, i + 1, nlo, CASE WHEN over THEN pt[i + 2] - pt[nlo + 1] ELSE ct + tk[i + 1] END, CASE WHEN over THEN pd[i + 2] - pd[nlo + 1] ELSE ad + dn[i + 1] END,
         CASE WHEN over THEN lo END, CASE WHEN over THEN i END
  FROM (SELECT *, CASE WHEN over THEN COALESCE(list_filter(range(lo, i), lambda j: pt[i + 1] - pt[j + 1] >= least(CAST(trunc(ct * 0.1::DOUBLE) AS BIGINT), 600))[-1], lo) ELSE lo END AS nlo
        FROM (SELECT r.*, p.tk, p.dn, p.pt, p.pd, i > lo AND ct + tk[i + 1] > {limit.replace('@', '(ad + dn[i + 1])')} AS over
              FROM r JOIN p USING (doc_id) WHERE i < len(p.s)))),
c AS (
  SELECT doc_id, i, a, e FROM r WHERE a IS NOT NULL
  UNION ALL SELECT r.doc_id, r.i + 1, r.lo, r.i FROM r JOIN p USING (doc_id) WHERE r.i = len(p.s) AND len(p.s) > 0)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS i, array_to_string(s[a + 1:e], ' ') AS chunk FROM c JOIN p USING (doc_id)
UNION ALL SELECT doc_id, 0, text FROM d WHERE tok <= {max_tokens}"""


def index_chunks(size: int, overlap: int) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, list_transform({loose('text')}, lambda x: {words('x')}) AS sw FROM documents),
p AS (SELECT doc_id, flatten(sw) AS w, {prefix('list_transform(sw, lambda x: len(x))')} AS wc FROM d WHERE len(sw) > 0),
r AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS e FROM p
  UNION ALL
  SELECT doc_id, i + 1, CASE WHEN wc[i + 2] - lo > {size} THEN CASE WHEN wc[i + 1] - lo >= {overlap} THEN wc[i + 1] - {overlap} ELSE lo END ELSE lo END,
         CASE WHEN wc[i + 2] - lo > {size} AND wc[i + 1] > lo THEN lo END, CASE WHEN wc[i + 2] - lo > {size} AND wc[i + 1] > lo THEN wc[i + 1] END
  FROM r JOIN p USING (doc_id) WHERE i < len(wc) - 1),
c AS (SELECT doc_id, i, a, e FROM r WHERE a IS NOT NULL
  UNION ALL SELECT r.doc_id, r.i + 1, r.lo, len(p.w) FROM r JOIN p USING (doc_id) WHERE r.i = len(p.wc) - 1)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS i, array_to_string(w[a + 1:e], ' ') AS chunk FROM c JOIN p USING (doc_id)"""


CUES = """
l AS (SELECT conv_id, turn, k - 1 AS line, string_split(text, chr(10))[k] AS said FROM conversations, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k)),
q AS (SELECT conv_id AS doc, row_number() OVER (PARTITION BY conv_id ORDER BY turn, line) - 1 AS n,
      CASE WHEN (turn + line) % 2 = 1 THEN regexp_replace(said, '[.!?]$', '') ELSE said END AS said FROM l)"""


def consolidate(max_window: int, min_words: int) -> str:
    return f"""
WITH RECURSIVE {CUES},
t AS (SELECT doc, n, {strip('said')} AS said, n * 20.0::DOUBLE AS st, n * 20.0::DOUBLE + 20 AS en FROM q),
r AS (
  SELECT doc, CAST(-1 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS buf, CAST(NULL AS DOUBLE) AS ss, CAST(NULL AS DOUBLE) AS se, CAST(NULL AS VARCHAR) AS out, CAST(NULL AS DOUBLE) AS os, CAST(NULL AS DOUBLE) AS oe
  FROM (SELECT DISTINCT doc FROM t)
  UNION ALL
  SELECT doc, n, CASE WHEN flush THEN NULL ELSE j END, CASE WHEN flush THEN NULL ELSE s2 END, CASE WHEN flush THEN NULL ELSE en END,
         CASE WHEN flush THEN j END, CASE WHEN flush THEN s2 END, CASE WHEN flush THEN en END
  FROM (SELECT *, (regexp_matches(said, '[.!?][''"]?$') OR en - s2 >= {max_window}) AND j <> '' AND len({words('j')}) >= {min_words} AS flush
        FROM (SELECT r.doc, t.n, t.said, t.en, COALESCE(r.ss, t.st) AS s2, trim(COALESCE(r.buf, '') || ' ' || t.said) AS j FROM r JOIN t ON t.doc = r.doc AND t.n = r.n + 1))),
o AS (
  SELECT doc, n, os AS start, oe AS "end", out AS text_raw FROM r WHERE out IS NOT NULL
  UNION ALL SELECT doc, n + 1, ss, se, buf FROM r WHERE buf <> '' AND n = (SELECT max(n) FROM t WHERE t.doc = r.doc) AND len({words('buf')}) >= {min_words})
SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY n) - 1 AS INT) AS i, start, "end", text_raw FROM o"""


HALF = 350 // 2


def snippet(t: str, q: str = S.QUERY) -> str:
    at = f"strpos(lower({t}), '{q}')"
    lo, hi = f"greatest(0, {at} - 1 - {HALF})", f"least(length({t}), {at} - 1 + {len(q) + HALF})"
    piece = f"CASE WHEN {lo} > 0 THEN '...' ELSE '' END || substring({t}, CAST({lo} + 1 AS BIGINT), CAST({hi} - {lo} AS BIGINT)) || CASE WHEN {hi} < length({t}) THEN '...' ELSE '' END"
    marked = f"regexp_replace({piece}, '({q})', '**\\1**', 'gi')"
    head = strip(f"substring({t}, 1, 350)") + f" || CASE WHEN length({t}) > 350 THEN '...' ELSE '' END"
    both = f"CASE WHEN {at} > 0 THEN {marked} ELSE {head} END"
    return f"CASE WHEN length({both}) < 50 THEN substring({t}, 1, 350) || '...' ELSE {both} END"


INDEX = """
x AS (SELECT lpad(CAST(doc_id AS VARCHAR), 9, '0') AS id, text AS document, CAST(embedding AS DOUBLE[]) AS embedding, 'doc_' || doc_id AS source,
      CASE WHEN doc_id % 10 = 0 THEN 'summary' ELSE 'raw_transcript' END AS category, CAST(0 AS INT) AS chunk_index FROM documents JOIN embeddings ON vec_id = doc_id % (SELECT max(vec_id) + 1 FROM embeddings)),
v AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0),
sim AS (SELECT x.*, list_cosine_similarity(embedding, q) AS similarity FROM x, v),
top AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY similarity DESC, id) AS n FROM sim),
near AS (SELECT * FROM top WHERE n <= CASE WHEN category = 'summary' THEN 5 ELSE 250 END)"""
HIT = f"contains(lower(document), '{S.QUERY}')"
HYBRID = f"CASE WHEN category = 'summary' THEN 0.2::DOUBLE ELSE 0.7::DOUBLE END * similarity + CASE WHEN {HIT} THEN CASE WHEN category = 'summary' THEN 1.0::DOUBLE - 0.2::DOUBLE ELSE 1.0::DOUBLE - 0.7::DOUBLE END ELSE 0 END"
RANKED = f"""{INDEX},
h AS (SELECT *, {HYBRID} AS score FROM near),
g AS (SELECT *, row_number() OVER (PARTITION BY category = 'summary', source, CASE WHEN category <> 'summary' THEN chunk_index END ORDER BY score DESC, id) AS k FROM h),
ranked AS (SELECT id, source AS heading, category, chunk_index, {snippet('document')} AS snippet, round(CASE WHEN category = 'summary' THEN score + 0.025::DOUBLE ELSE score END, 9) AS score FROM g WHERE k = 1)"""

FILES = f"f AS (SELECT doc_id, {S.FILE_NAME} AS name FROM documents)"
PUNCT = "regexp_replace(regexp_replace(text, 'U+([,.;:!?])', '\\1', 'g'), '([,.;:!?])([^U])', '\\1 \\2', 'g')".replace("[^U]", "[^" + U[1:]).replace("U+", U + "+")


def values(rows: list[tuple], names: str) -> str:
    quoted = ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"(VALUES {quoted}) AS t({names})"


def replaced(x: str) -> str:
    for k in sorted(S.TERMS, key=len, reverse=True):
        x = f"regexp_replace({x}, '{k}', '{S.TERMS[k]}', 'gi')"
    return x


WORDS_OF = f"string_split_regex(lower(text), '{NON_WORD}')"
SCAN = f"""
w AS (SELECT conv_id, turn, ' ' || array_to_string(string_split_regex(lower(text), '{NON_WORD}'), ' ') || ' ' AS flat, lower(text) AS low FROM conversations),
n AS (SELECT DISTINCT w.conv_id, w.turn, t.person, t.variant FROM w, {values(S.VARIANTS, 'person, variant')} WHERE contains(flat, ' ' || variant || ' ') AND contains(low, variant))"""

ORACLES = {
    "token_estimate": f"SELECT doc_id, {tokens('text')} AS tokens FROM documents",
    "text_stats": f"SELECT doc_id, CAST(len({words('text')}) AS BIGINT) AS words, CAST(ceil(len({words('text')}) / 230.0) AS BIGINT) AS minutes, CAST(length(text) - length(replace(text, '$', '')) AS BIGINT) AS dollars FROM documents",
    "ws_normalize": f"""SELECT doc_id, {strip(f"array_to_string(list_transform(string_split_regex(text, '{BREAK}'), lambda l: {strip(f"regexp_replace(l, '{U}+', ' ', 'g')")}), chr(10))")} AS clean FROM documents""",
    "quotes_dashes": "SELECT doc_id, translate(text, '“”’‘—–', '\"\"''''--') AS clean FROM documents",
    "punct_spacing": f"SELECT doc_id, regexp_replace(regexp_replace({PUNCT}, '\\({U}+', '(', 'g'), '{U}+\\)', ')', 'g') AS clean FROM documents",
    "replacements": f"SELECT doc_id, {replaced('text')} AS clean FROM documents",
    "sentences_loose": numbered(loose("text"), "sentence"),
    "sentences_strict": numbered(strict("text"), "sentence"),
    "merge_fragments": f"""
WITH s AS ({numbered(strict('text'), 'line')}),
g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^\\p{{Ll}}') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM s)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) - 1 AS INT) AS i, string_agg(line, ' ' ORDER BY i) AS line FROM g GROUP BY doc_id, island""",
    "word_chunks": f"""
WITH w AS (SELECT doc_id, text, {words('text')} AS w FROM documents),
c AS (SELECT doc_id, CASE WHEN len(w) <= 150 THEN [text] ELSE list_transform(range(0, 1 + CAST(ceil((len(w) - 150) / 135.0) AS BIGINT)), lambda i: array_to_string(w[i * 135 + 1:i * 135 + 150], ' ')) END AS l FROM w)
SELECT doc_id, CAST(i - 1 AS INT) AS i, l[i] AS chunk FROM c, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)""",
    "sentence_chunks": sentence_chunks(200, "200"),
    "density_chunks": sentence_chunks(200, "greatest(1, CAST(trunc(200 * CASE WHEN @ = 0 THEN 1.0::DOUBLE ELSE greatest(3.0::DOUBLE / @, 0.1::DOUBLE) END) AS BIGINT))"),
    "index_chunks": index_chunks(150, 25),
    "consolidate_turns": consolidate(90, 1),
    "consolidate_long": consolidate(40, 15),
    "speaker_islands": """
WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS g FROM conversations)
SELECT conv_id, role, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS turns FROM t GROUP BY conv_id, role, g""",
    "doc_type_tag": f"WITH {FILES} SELECT doc_id, CASE WHEN contains(lower(name), 'finance') OR contains(lower(name), 'budget') THEN 'finance' WHEN contains(lower(name), 'zoning') THEN 'zoning' WHEN contains(lower(name), 'council') THEN 'council' ELSE 'general' END AS type FROM f",
    "doc_date": f"""WITH {FILES} SELECT doc_id, translate(COALESCE(nullif(regexp_extract(name, '(\\d{{4}}[-_]\\d{{1,2}}[-_]\\d{{1,2}})', 1), ''), nullif(regexp_extract(name, '(\\d{{1,2}}[-_]\\d{{1,2}}[-_]\\d{{2,4}})', 1), ''), 'unknown'), '_', '-') AS date FROM f""",
    "file_ids": f"""WITH {FILES}, m AS (SELECT DISTINCT lower(substring(name, 1, 11)) AS k, upper(substring(name, 1, 11)) AS real FROM f WHERE doc_id % 2 = 0)
SELECT doc_id, COALESCE(real, substring(name, 1, 11)) AS video_id, 'https://www.youtube.com/watch?v=' || COALESCE(real, substring(name, 1, 11)) AS video_url FROM f LEFT JOIN m ON lower(substring(name, 1, 11)) = k""",
    "file_labels": f"""WITH {FILES},
g AS (SELECT doc_id, replace(name, '.txt', '') AS base FROM f),
e AS (SELECT *, regexp_extract(base, '(\\d{{4}}[-_]\\d{{1,2}}[-_]\\d{{1,2}})', 1) AS iso, regexp_extract(base, '(\\d{{1,2}}[-_]\\d{{1,2}}[-_]\\d{{2,4}})', 1) AS us FROM g),
p AS (SELECT *, CASE WHEN iso <> '' THEN iso ELSE us END AS raw FROM e),
o AS (SELECT *, string_split_regex(raw, '[-_]') AS x FROM p),
b AS (SELECT doc_id, trim(regexp_replace(translate(regexp_replace(CASE WHEN raw = '' THEN base ELSE replace(base, raw, '') END, '^[^.]*\\.', ''), '_-', '  '), ' +', ' ', 'g')) AS low,
  CASE WHEN raw = '' THEN '0000-00-00' WHEN iso <> '' THEN x[1] || '-' || lpad(x[2], 2, '0') || '-' || lpad(x[3], 2, '0') ELSE '20' || x[3] || '-' || lpad(x[1], 2, '0') || '-' || lpad(x[2], 2, '0') END AS date FROM o)
SELECT doc_id, array_to_string(list_transform(string_split(low, ' '), lambda y: upper(y[1]) || lower(y[2:])), ' ') || ' | ' || date AS label, date FROM b""",
    "url_parts": "SELECT page_id, lower(nullif(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '^.*@', ''), ':.*$', ''), '')) AS host, substring(sha256(url), 1, 11) AS page_key FROM pages",
    "placeholder_id": "SELECT doc_id, substring(sha256(source || '_' || doc_id), 1, 11) AS video_id, source || '_' || lpad(CAST(doc_id AS VARCHAR), 5, '0') AS segment_id FROM documents",
    "clean_names": f"""WITH c AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN source || '_item.mp3' WHEN 1 THEN source || '_item_' || (doc_id % 5) || '.mp3' ELSE '“' || source || '” — Item.MP3' END AS name FROM documents),
d AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(name), '["\'\'‘’“”⧸]', '_', 'g'), '[^a-z0-9._-]', '_', 'g'), '_-_', '_', 'g'), '__+', '_', 'g') AS k FROM c),
e AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY name <> k, name) - 1 AS r FROM d),
t AS (SELECT DISTINCT k AS taken FROM e),
m AS (SELECT k, max(r) AS most FROM e GROUP BY k),
f AS (SELECT k, j, row_number() OVER (PARTITION BY k ORDER BY j) AS r FROM (SELECT k, unnest(range(1, most + 1 + (SELECT count(*) FROM t))) AS j FROM m) WHERE regexp_replace(k, '(\\.[^.]*)$', '_' || j || '\\1') NOT IN (SELECT taken FROM t)),
g AS (SELECT e.*, CASE WHEN e.r = 0 THEN e.k ELSE regexp_replace(e.k, '(\\.[^.]*)$', '_' || f.j || '\\1') END AS clean_name FROM e LEFT JOIN f ON f.k = e.k AND f.r = e.r)
SELECT k AS clean, count(*) AS n, count(DISTINCT clean_name) AS names, CAST(sum(COALESCE(TRY_CAST(regexp_extract(clean_name, '_([0-9]+)\\.mp3$', 1) AS BIGINT), 0)) AS BIGINT) AS numbers, count_if(name = clean_name) AS kept FROM g GROUP BY k""",
    "snippets": f"SELECT doc_id, {snippet('text')} AS snippet FROM documents",
    "density_count": f"SELECT doc_id, {hits('text')} AS hits FROM documents",
    "name_scan": f"WITH {SCAN} SELECT conv_id, turn, person, variant FROM n",
    "speaker_context": f"""WITH {SCAN},
g AS (SELECT conv_id, turn, person, list(variant ORDER BY length(variant) DESC, variant) AS vs FROM n GROUP BY ALL),
h AS (SELECT *, replace(person, '_', ' ') AS readable, list_filter(vs, lambda v: NOT contains(v, ' ') AND NOT contains(lower(person), lower(v))) AS short FROM g),
k AS (SELECT *, list_filter([CASE WHEN len(vs) > 1 THEN '  - ' || readable || ': ' || array_to_string(vs, ', ') END, CASE WHEN len(short) > 0 THEN '  - ' || readable || ': ' || array_to_string(short, ', ') END], lambda x: x IS NOT NULL) AS ls FROM h)
SELECT conv_id, turn, '**Speakers detected in this segment: ' || string_agg(vs[1], ', ' ORDER BY person) || '.**' || chr(10)
  || CASE WHEN len(flatten(list(ls ORDER BY person))) > 0 THEN '*Some mentions are ambiguous or used multiple name variants:*' || chr(10) || array_to_string(flatten(list(ls ORDER BY person)), chr(10)) || chr(10) ELSE '' END
  || '*Mentions may refer to multiple individuals if only first names are used.*' AS context
FROM k GROUP BY conv_id, turn""",
    "classify_rules": """WITH w AS (SELECT doc_id, ' ' || regexp_replace(lower(substring(concat_ws(' ', CASE doc_id % 5 WHEN 0 THEN 'Budget hearing.' WHEN 1 THEN 'Zoning appeal' WHEN 2 THEN 'The council met' WHEN 3 THEN 'Committee of the Whole:' END, text), 1, 2000)), '[^\\p{L}\\p{M}\\p{N}\\p{Pc}]+', ' ', 'g') || ' ' AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, ' (finance|budget|appropriation) ') THEN 'finance_committee' WHEN contains(t, ' committee of the whole ') THEN 'committee_of_the_whole' WHEN regexp_matches(t, ' (zoning|planning) ') THEN 'zoning_committee' WHEN contains(t, ' council ') THEN 'city_council' ELSE 'general' END AS label FROM w""",
    "route_prompts": "SELECT doc_id, 'overview' AS first, CASE WHEN doc_id % 3 = 0 THEN 'figures' ELSE 'condense' END AS multi, 'minutes' AS final FROM documents",
    "price_runs": f"""WITH r AS (SELECT doc_id, provider, model, {tokens('text')} AS n FROM documents, {values(S.PRICED, 'provider, model')})
SELECT doc_id, provider, model, round(CASE WHEN provider = 'openai' AND contains(lower(model), 'gpt-4.1') THEN n / 1e6 * 2.0 + (n // 10) / 1e6 * 8.0 WHEN provider = 'anthropic' THEN n / 1e6 * 1.0 + (n // 10) / 1e6 * 5.0 END, 9) AS cost FROM r""",
    "output_budget": f"SELECT doc_id, CAST(greatest(1, least(2048, 8192 - {tokens('text')} - 1)) AS BIGINT) AS budget FROM documents",
    "cosine_topk": "WITH v AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(s, 6) AS similarity FROM (SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS s FROM embeddings, v ORDER BY s DESC, vec_id LIMIT 250)",
    "cosine_topk_by_label": "WITH v AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0), s AS (SELECT label, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS similarity FROM embeddings, v) SELECT * FROM (SELECT label, vec_id, similarity, CAST(row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS INT) AS n FROM s) WHERE n <= 5",
    "align_argmax": """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
c AS (SELECT * FROM e WHERE vec_id % 4 = 0), s AS (SELECT * FROM e WHERE vec_id % 4 <> 0)
SELECT vec_id, ts FROM (SELECT c.vec_id, s.vec_id * 10.0 AS ts, row_number() OVER (PARTITION BY c.vec_id ORDER BY round(list_cosine_similarity(c.x, s.x), 9) DESC, s.vec_id) AS n FROM c JOIN s USING (label)) WHERE n = 1""",
    "literal_boost": f"WITH {INDEX} SELECT id, round(CASE WHEN {HIT} THEN similarity + 0.5 ELSE similarity * 0.5 END, 9) AS score FROM near",
    "hybrid_rerank": f"WITH {INDEX} SELECT id, round({HYBRID}, 9) AS score FROM near",
    "aggregate_dedup": f"WITH {RANKED} SELECT * FROM ranked",
    "search_pipeline": f"WITH {RANKED} SELECT * FROM ranked WHERE score >= 0.3 ORDER BY score DESC, id LIMIT 25",
    "search_with_fallback": f"""WITH {RANKED},
extra AS (SELECT 'LITERAL_doc_' || doc_id AS id, 'doc_' || doc_id AS heading, CASE WHEN doc_id % 10 = 0 THEN 'summary' ELSE 'raw_transcript' END AS category, CAST(NULL AS INT) AS chunk_index, {snippet('text')} AS snippet, 0.95::DOUBLE AS score
  FROM documents WHERE contains(lower(text), '{S.QUERY}') AND 'doc_' || doc_id NOT IN (SELECT heading FROM ranked))
SELECT * FROM (SELECT * FROM ranked UNION ALL SELECT * FROM extra) WHERE score >= 0.3 ORDER BY score DESC, id LIMIT 25""",
    "literal_fallback": f"SELECT 'LITERAL_doc_' || doc_id AS id, 'doc_' || doc_id AS heading, CASE WHEN doc_id % 10 = 0 THEN 'summary' ELSE 'raw_transcript' END AS category, {snippet('text')} AS snippet, 0.2::DOUBLE AS score FROM documents WHERE contains(lower(text), '{S.QUERY}')",
    "confidence": f"WITH {RANKED} SELECT id, n AS rank, CASE WHEN n <= 3 THEN 'High' ELSE 'Medium' END AS confidence FROM (SELECT id, CAST(row_number() OVER (ORDER BY score DESC, id) AS INT) AS n FROM ranked WHERE score >= 0.3 QUALIFY n <= 25)",
    "tracker_anti": "SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 3 = 0)",
    "dedup_sha": "SELECT sha256(text) AS content_sha, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1",
    "chunk_windows": "SELECT user_id, CAST(k AS INT) AS idx, k * 598.0::DOUBLE AS start, least(600.0::DOUBLE, total - k * 598.0::DOUBLE) AS duration FROM (SELECT user_id, count(*) * 97.0::DOUBLE AS total FROM events GROUP BY user_id), LATERAL (SELECT unnest(range(0, CAST(ceil(total / 598.0) AS BIGINT))) AS k)",
    "listing_cutoff": """WITH l AS (SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS d, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS p FROM events),
r AS (SELECT min(d) AS a, max(d) AS b FROM l), c AS (SELECT l.*, sum(CASE WHEN value < 20 THEN 1 ELSE 0 END) OVER (PARTITION BY l.user_id ORDER BY p) AS old FROM l JOIN events USING (event_id))
SELECT event_id FROM c WHERE old = 0""",
    "stage_report": "SELECT count(*) AS discovered, count_if(event_type = 'purchase') AS processed, count_if(event_type <> 'purchase') AS skipped FROM events",
    "ndjson_concat": "SELECT user_id, string_agg(json_extract_string(props, '$.k'), '' ORDER BY event_id) AS said FROM events GROUP BY user_id",
    "event_windows": "SELECT time_bucket(INTERVAL '10 minutes', ts) AS bucket, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "metadata_rollup": f"WITH {FILES}, m AS (SELECT CASE WHEN doc_id % 10 = 0 THEN 'summary' ELSE 'raw_transcript' END AS category, CASE WHEN contains(name, 'finance') THEN 'finance' WHEN contains(name, 'zoning') THEN 'zoning' WHEN contains(name, 'council') THEN 'council' ELSE 'general' END AS type FROM f) SELECT category, type, count(*) AS n FROM m GROUP BY ROLLUP (category, type)",
    "upsert": "SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'new' ELSE 'old' END AS version FROM documents",
    "stitched": """WITH s AS (SELECT conv_id AS doc, turn // 2 AS chunk, turn % 2 AS idx, (turn % 2) * 30.0::DOUBLE AS st, (turn % 2) * 30.0::DOUBLE + length(text) % 30 AS en FROM conversations),
l AS (SELECT doc, chunk, arg_max(en, idx) AS last FROM s GROUP BY ALL),
o AS (SELECT doc, chunk, COALESCE(sum(last) OVER (PARTITION BY doc ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM l)
SELECT doc, chunk, idx, st + off AS start, en + off AS "end" FROM s JOIN o USING (doc, chunk)""",
}


WORD = r"[\p{L}\p{M}\p{N}\p{Pc}]"


def collapsed(source: str) -> str:
    """(doc_id, t) with repeated words collapsed, from (doc_id, t): words and what is between them, put together again."""
    same = "lower(a[i]) = lower(a[i - 2])"
    return f"""SELECT doc_id, array_to_string(list_transform(range(1, len(a) + 1), lambda i: CASE
  WHEN i > 2 AND regexp_matches(a[i], '^{WORD}') AND regexp_full_match(a[i - 1], '{U}+') AND {same} THEN ''
  WHEN i > 1 AND regexp_full_match(a[i], '{U}+') AND lower(a[i - 1]) = lower(a[i + 1]) THEN '' ELSE a[i] END), '') AS t
  FROM (SELECT doc_id, regexp_extract_all(t, '{WORD}+|{WORD.replace('[', '[^', 1)}+') AS a FROM {source})"""


def patterns(first: str) -> str:
    """CTEs ending in n5 (doc_id, t): the cleanups of spoken text in their order, over a first SELECT (doc_id, t)."""
    punct = PUNCT.replace("(text,", "(t,")
    return f"""n1 AS ({first}),
n2 AS (SELECT doc_id, translate(t, '“”’‘—–', '""''''--') AS t FROM n1),
n3 AS (SELECT doc_id, regexp_replace(regexp_replace({punct}, '\\({U}+', '(', 'g'), '{U}+\\)', ')', 'g') AS t FROM n2),
n4 AS ({collapsed('n3')}),
n5 AS (SELECT doc_id, {strip("regexp_replace(t, '\\n{3,}', chr(10) || chr(10), 'g')")} AS t FROM n4)"""


def embedding(x: str) -> str:
    """Hashed words with signs, of length one, as floats."""
    codes = f"list_transform(list_filter(string_split_regex(lower({x}), '{NON_WORD}'), lambda w: w <> ''), lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 128)"
    sums = f"list_transform([{codes}], lambda c: list_transform(range(0, 64), lambda d: CAST(len(list_filter(c, lambda y: y = d)) - len(list_filter(c, lambda y: y = d + 64)) AS DOUBLE)))[1]"
    return f"list_transform([{sums}], lambda s: list_transform(s, lambda y: CAST(y / greatest(sqrt(list_sum(list_transform(s, lambda z: z * z))), 1e-10::DOUBLE) AS FLOAT)))[1]"


def shown(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda y: CAST(round(CAST(y AS DOUBLE) * 1e6) AS BIGINT)), ',')"


def _indexed(kind: str, category: str, prefix_: str, size: int, overlap: int) -> str:
    """Index rows over the chunks of documents under their meeting files' names."""
    body = index_chunks(size, overlap).strip()
    head, _, last = body.rpartition("\nSELECT")
    amount = r"(?i)(\$\s?\d[\d,]*(?:\.\d+)?(?:\s?(?:million|billion|thousand))?)"
    money = f"CASE WHEN len({words('chunk')}) > 10 THEN nullif(array_to_string(list_sort(list_distinct(regexp_extract_all(chunk, '{amount}', 1))), ', '), '') END"
    # A summary's prefix is part of what is embedded, a transcript's is not.
    embedded = f"'{prefix_}' || chunk" if kind == "SUMMARY" else "chunk"
    return f"""{head},
k AS (SELECT{last}), {FILES}
SELECT '{kind}_' || name || '_' || i AS id, '{prefix_}' || chunk AS document, name AS source, '{category}' AS category,
  CASE WHEN contains(name, 'finance') THEN 'finance' WHEN contains(name, 'zoning') THEN 'zoning' WHEN contains(name, 'council') THEN 'council' ELSE 'general' END AS type,
  translate(COALESCE(nullif(regexp_extract(name, '(\\d{{4}}[-_]\\d{{1,2}}[-_]\\d{{1,2}})', 1), ''), nullif(regexp_extract(name, '(\\d{{1,2}}[-_]\\d{{1,2}}[-_]\\d{{2,4}})', 1), ''), 'unknown'), '_', '-') AS date,
  'https://www.youtube.com/watch?v=' || substring(name, 1, 11) AS video_url, substring(name, 1, 11) AS video_id, i AS chunk_index, CAST(NULL AS DOUBLE) AS ts, {shown(embedding(embedded))} AS embedding,
  {money if kind == 'TRANSCRIPT' else 'CAST(NULL AS VARCHAR)'} AS money
FROM k JOIN f USING (doc_id)"""


ORACLES |= {
    "collapse_repeats": f"WITH n AS (SELECT doc_id, text AS t FROM documents) SELECT doc_id, t AS clean FROM ({collapsed('n')})",
    "normalize_patterns": f"WITH {patterns('SELECT doc_id, text AS t FROM documents')} SELECT doc_id, t AS clean FROM n5",
    "normalized_transcripts": f"""
WITH {patterns(ORACLES['ws_normalize'].replace(' AS clean', ' AS t'))},
n6 AS (SELECT doc_id, {replaced('t')} AS t FROM n5),
s AS ({numbered(strict('t'), 'line', 'n6')}),
g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^\\p{{Ll}}') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM s),
m AS (SELECT doc_id, min(i) AS i, string_agg(line, ' ' ORDER BY i) AS line FROM g GROUP BY doc_id, island)
SELECT n6.doc_id, COALESCE(l, '') AS lines FROM n6 LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) || chr(10) AS l FROM m GROUP BY doc_id) USING (doc_id)""",
    "deep_clean": f"SELECT doc_id, {strip(f'''regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\[(music|applause|laughter|noise)\\]', '', 'gi'), '\\((music|applause|laughter|noise)\\)', '', 'gi'), '\\b(um|uh|erm)\\b', '', 'gi'), '{U}{{2,}}', ' ', 'g')''')} AS clean FROM documents",
    "caption_round_trip": f"""
WITH {CUES},
c AS (SELECT doc, n, {strip(f"regexp_replace(said, '{U}+', ' ', 'g')")} AS text FROM q)
SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY n) - 1 AS INT) AS i, n * 20.0::DOUBLE AS start, n * 20.0::DOUBLE + 20 AS "end", text FROM c WHERE text <> ''""",
    "prompt_contexts": f"""WITH {FILES}, b AS (SELECT doc_id, translate(replace(regexp_replace(name, '^[\\w\\-]+?\\.', ''), '.txt', ''), '_-', '  ') AS b FROM f),
m AS (SELECT *, regexp_extract(b, '^(.*?) (\\d{{1,2}})[ -](\\d{{1,2}})[ -](\\d{{2,4}})', ['kind', 'm', 'd', 'y']) AS x FROM b),
t AS (SELECT doc_id, x, x.y <> '' AS dated, CASE WHEN x.y <> '' THEN trim(x.kind) ELSE b END AS low FROM m),
k AS (SELECT *, array_to_string(list_transform(string_split(low, ' '), lambda y: upper(y[1]) || lower(y[2:])), ' ') AS title FROM t)
SELECT doc_id, CASE WHEN dated THEN title || ' - ' || lpad(CAST(CASE WHEN TRY_CAST(x.y AS INT) < 100 THEN TRY_CAST(x.y AS INT) + 2000 ELSE TRY_CAST(x.y AS INT) END AS VARCHAR), 4, '0') || '-' || lpad(x.m, 2, '0') || '-' || lpad(x.d, 2, '0') ELSE title END AS context FROM k""",
    "index_transcripts": _indexed("TRANSCRIPT", "raw_transcript", "Transcript excerpt: ", 150, 25),
    "index_summaries": _indexed("SUMMARY", "summary", "Meeting summary: ", 300, 50),
}


def _timed() -> str:
    body = index_chunks(150, 25).strip()
    head, _, last = body.rpartition("\nSELECT")
    return f"""{head},
k AS (SELECT{last}), {FILES},
cv AS (SELECT doc_id, i, CAST({embedding('chunk')} AS DOUBLE[]) AS x FROM k),
sv AS (SELECT doc_id, i, CAST({embedding('line')} AS DOUBLE[]) AS y FROM ({numbered(strict('text'), 'line')})),
mv AS (SELECT cv.doc_id, cv.i, sv.i * 10.0::DOUBLE AS ts, row_number() OVER (PARTITION BY cv.doc_id, cv.i ORDER BY
  round(CASE WHEN list_sum(list_transform(x, lambda z: z * z)) = 0 OR list_sum(list_transform(y, lambda z: z * z)) = 0 THEN 0 ELSE list_cosine_similarity(x, y) END, 9) DESC, sv.i) AS n FROM cv JOIN sv USING (doc_id))
SELECT 'TRANSCRIPT_' || name || '_' || k.i AS id, ts FROM k JOIN f USING (doc_id) LEFT JOIN (SELECT * FROM mv WHERE n = 1) USING (doc_id, i)"""


def _persons() -> str:
    head, _, last = index_chunks(150, 25).strip().rpartition("\nSELECT")
    return f"""{head},
k AS (SELECT{last}), {FILES},
zw AS (SELECT doc_id, i, len({words('chunk')}) AS n, ' ' || array_to_string(string_split_regex(lower(chunk), '{NON_WORD}'), ' ') || ' ' AS flat, lower(chunk) AS low FROM k),
zp AS (SELECT DISTINCT zw.doc_id, zw.i, t.person FROM zw, {values(S.VARIANTS, 'person, variant')} WHERE n > 10 AND contains(flat, ' ' || variant || ' ') AND contains(low, variant))
SELECT 'TRANSCRIPT_' || name || '_' || k.i AS id, persons FROM k JOIN f USING (doc_id) LEFT JOIN (SELECT doc_id, i, string_agg(person, ', ' ORDER BY person) AS persons FROM zp GROUP BY ALL) USING (doc_id, i)"""


def _multipass(max_tokens: int = 400) -> str:
    """Two passes, a third where the text is still large, and the final prompt; the built-in generator."""
    size = int(max_tokens * 0.75)
    step = size - min(int(size * 0.1), 600)
    said = lambda x: f"array_to_string(({loose(x)})[1:2], ' ')"
    w = words("t")
    chunks = f"CASE WHEN len({w}) <= {size} THEN [t] ELSE list_transform(range(0, 1 + CAST(ceil((len({w}) - {size}) / {step}.0) AS BIGINT)), lambda i: array_to_string(({w})[i * {step} + 1:i * {step} + {size}], ' ')) END"

    def prompt(name: str, x: str) -> str:
        before, after = PROMPTS[name].replace("{context}", "No context provided.").split("{text}")
        return f"('{before}' || {x} || '{after}')"

    def step_of(name: str, source: str, out: str) -> str:
        return f"""{out}c AS (SELECT *, {chunks} AS c FROM {source}),
{out}s AS (SELECT *, list_transform(c, lambda q: {said('q')}) AS s FROM {out}c),
{out} AS (SELECT doc_id, meeting_type, array_to_string(s, chr(10) || chr(10)) AS t, len(c) AS k,
  n_in + list_sum(list_transform(c, lambda q: {tokens(prompt(name, 'q'))})) AS n_in, n_out + list_sum(list_transform(s, lambda q: {tokens('q')})) AS n_out FROM {out}s)"""

    head = f"' ' || regexp_replace(lower(substring(text, 1, 2000)), '{NON_WORD}', ' ', 'g') || ' '"
    label = f"CASE WHEN regexp_matches({head}, ' (finance|budget|appropriation) ') THEN 'finance_committee' WHEN contains({head}, ' committee of the whole ') THEN 'committee_of_the_whole' WHEN regexp_matches({head}, ' (zoning|planning) ') THEN 'zoning_committee' WHEN contains({head}, ' council ') THEN 'city_council' ELSE 'general' END"
    small = f"({tokens('t')} <= {max_tokens} OR k <= 1)"
    return f"""
WITH l AS (SELECT doc_id, text, {label} AS meeting_type FROM documents),
d AS (SELECT doc_id, meeting_type, text AS t, {tokens('substring(text, 1, 2000)')} AS n_in, {tokens('meeting_type')} AS n_out FROM l),
{step_of('overview', 'd', 'p1')},
{step_of('condense', 'p1', 'p2')},
o AS (SELECT * FROM p2 WHERE NOT {small}),
{step_of('condense', 'o', 'p3')},
e AS (SELECT *, 2 AS passes FROM p2 WHERE {small} UNION ALL SELECT *, 3 FROM p3),
g AS (SELECT *, {said('t')} AS summary FROM e),
h AS (SELECT *, CAST(n_in + {tokens(prompt('minutes', 't'))} AS BIGINT) AS input_tokens, CAST(n_out + {tokens('summary')} AS BIGINT) AS output_tokens FROM g)
SELECT doc_id, meeting_type, summary, CAST(passes AS INT) AS passes, input_tokens, output_tokens, input_tokens + output_tokens AS total_tokens FROM h"""


SEGMENTS = consolidate(90, 1)
ORACLES |= {
    "index_transcripts_timed": _timed(),
    "summary_multipass": _multipass(),
    "query_embeddings": f"SELECT doc_id, {shown(embedding(f"'{QUERY_PREFIX}' || text"))} AS embedding FROM documents",
    "summaries_present": f"WITH {FILES}, s AS (SELECT DISTINCT replace(name, '.txt', '.summary.md') AS summary FROM f WHERE doc_id % 10 = 0) SELECT doc_id, replace(name, '.txt', '.summary.md') AS summary, replace(name, '.txt', '.summary.md') IN (SELECT summary FROM s) AS has_summary FROM f",
    "classifier_labels": "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'finance' WHEN 1 THEN 'city_council' WHEN 2 THEN 'council' ELSE 'general' END AS label FROM documents",
    "pricing_summaries": f"""WITH n AS (SELECT doc_id, {tokens('text')} AS n, doc_id % 2 = 0 AS even FROM documents)
SELECT doc_id, CASE WHEN even THEN 'anthropic' ELSE 'openai' END AS reference_provider, CASE WHEN even THEN 'claude-haiku-9' ELSE 'gpt-4.1-nano' END AS reference_model,
  round(n / 1e6 * CASE WHEN even THEN 1.0 ELSE 2.0 END + (n // 10) / 1e6 * CASE WHEN even THEN 5.0 ELSE 8.0 END, 9) AS cost, n AS input_tokens, n // 10 AS output_tokens FROM n""",
    "id_maps": """WITH l AS (SELECT doc_id, substring(md5(CAST(doc_id // 2 AS VARCHAR)), 1, 11 + CAST(doc_id % 5 = 0 AS INT)) AS name FROM documents)
SELECT lower(name) AS lower_id, arg_max(CASE WHEN doc_id % 2 = 0 THEN upper(name) ELSE name END, doc_id) AS real_id FROM l WHERE length(name) = 11 GROUP BY 1""",
    "handles": """WITH g AS (SELECT doc_id, lower(source) AS a, lower(lang) || '-' || lower(source) AS b FROM documents)
SELECT doc_id, CAST(0 AS INT) AS i, a AS item, regexp_full_match(a, '[a-z0-9_]+') AS handle FROM g UNION ALL SELECT doc_id, 1, b, regexp_full_match(b, '[a-z0-9_]+') FROM g""",
    "rendered_prompts": "SELECT doc_id, '{as is} ' || CASE WHEN doc_id % 2 = 0 THEN source ELSE 'No context provided.' END || ': ' || text || ' {end}' AS prompt FROM documents",
    "missing_prompts": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'figures,minutes' ELSE 'minutes' END AS missing FROM documents",
    "segment_files": f"SELECT doc || '_' || lpad(CAST(i AS VARCHAR), 5, '0') AS id, CAST(doc AS VARCHAR) AS source, i AS segment_index, start AS start_time, \"end\" AS end_time, round(\"end\" - start, 3) AS duration, text_raw, substring(sha256(CAST(doc AS VARCHAR)), 1, 11) AS video_id FROM ({SEGMENTS})",
    "segment_texts": f"SELECT c.doc, COALESCE(text, '') AS text FROM (SELECT DISTINCT conv_id AS doc FROM conversations) c LEFT JOIN (SELECT doc, string_agg(text_raw || chr(10) || chr(10), '' ORDER BY i) AS text FROM ({SEGMENTS}) GROUP BY doc) s ON s.doc = c.doc",
    "summary_texts": "SELECT doc_id, source || '_' || doc_id || '_x' AS name, '# Summary: ' || source || chr(10) || chr(10) || trim(chr(10) || text || chr(10) || chr(10), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) || chr(10) AS markdown FROM documents",
    "fresh_listings": "SELECT CAST(user_id AS VARCHAR) AS channel, min(event_id) AS fetched_at, count(*) AS n FROM events GROUP BY user_id HAVING 200 - min(event_id) <= 150",
    "tracker_files": "SELECT CAST(doc_id AS VARCHAR) AS key FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0",
    "chunk_styles": f"""WITH w AS (SELECT doc_id, len({words('text')}) AS n FROM documents),
s AS (SELECT doc_id, count(*) AS n FROM ({ORACLES['sentence_chunks']}) GROUP BY doc_id),
d AS (SELECT doc_id, count(*) AS n FROM ({sentence_chunks(200, "greatest(1, CAST(trunc(200 * CASE WHEN @ = 0 THEN 1.0::DOUBLE ELSE greatest(500.0::DOUBLE / @, 0.1::DOUBLE) END) AS BIGINT))")}) GROUP BY doc_id)
SELECT w.doc_id, CAST(CASE WHEN w.n <= 150 THEN 1 ELSE 1 + ceil((w.n - 150) / 135.0) END AS BIGINT) AS word, COALESCE(s.n, 0) AS sentence, COALESCE(d.n, 0) AS density
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN d USING (doc_id)""",
}

PEOPLE = """
p AS (SELECT DISTINCT role, conv_id % 40 AS n FROM conversations),
q AS (SELECT role, CASE WHEN n % 4 = 0 THEN role || n ELSE role || '_of' || n END AS person, CASE WHEN n % 4 = 0 THEN role || n ELSE role END AS first, CASE WHEN n % 4 = 0 THEN '' ELSE 'of' || n END AS last, 'No. ' || n AS alias FROM p),
r AS (SELECT *, trim(first || ' ' || last) AS whole FROM q),
t AS (SELECT r.*, unnest([upper(role), 'Chief ' || role]) AS title FROM r WHERE role <> 'system')"""
TOKENS = r"[\p{L}\p{M}\p{N}\p{Pc}]+|[^\p{L}\p{M}\p{N}\p{Pc}]+"

ORACLES |= {
    "inverted_many": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(e.x, q.x), 12) AS s FROM e, e AS q WHERE q.vec_id % 50 = 0)
SELECT query_id, vec_id, round(s, 6) AS similarity FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) <= 10""",
    "inverted_topk": ORACLES["cosine_topk"],
    "literal_indexed": ORACLES["literal_fallback"],
    "literal_matches": "SELECT item_id AS query_id, 'doc_' || doc_id AS source FROM benchmark b, documents d WHERE substring(b.text, 1, 24) <> '' AND contains(lower(d.text), lower(substring(b.text, 1, 24)))",
    "versioned_upsert": f"SELECT doc_id || '_' || i AS id, CASE WHEN doc_id % 3 <> 0 THEN 'old' WHEN i = 0 THEN 'new' ELSE 'gone' END AS state FROM ({ORACLES['word_chunks']})",
    "provider_policy": """WITH u AS (SELECT page_id, page_id % 5 AS n, page_id % 2 AS odd, page_id % 7 AS w, url FROM pages)
SELECT page_id, CASE WHEN n = 3 THEN 'provider missing' WHEN n = 2 THEN CASE WHEN odd = 1 THEN 'custom executable' END WHEN n <> 1 AND w = 0 THEN 'target missing'
  WHEN starts_with(url, 'http:') THEN 'insecure http' WHEN n <> 1 THEN 'off-box' END AS fault FROM u""",
    "model_names": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'control characters' ELSE 'model missing' END AS fault FROM events",
    "names_of_documents": f"""WITH w AS (SELECT list_filter({WORDS_OF}, lambda x: x <> '') AS w FROM documents),
v AS (SELECT DISTINCT unnest(list_zip(w[:-2], w[2:])) AS p FROM w WHERE len(w) > 1),
c AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '{TOKENS}') AS t FROM conversations),
k AS (SELECT conv_id, turn, t, unnest(range(1, len(t) - 1)) AS i FROM c)
SELECT DISTINCT conv_id, turn, t[i] AS person, t[i] || ' ' || t[i + 2] AS variant FROM k JOIN v ON p[1] = t[i] AND p[2] = t[i + 2] WHERE t[i + 1] = ' '""",
    "stored_answers": "SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN trim(text, ' ') ELSE text END AS said FROM conversations",
    "hotwords": """WITH p AS (SELECT DISTINCT role, conv_id % 40 AS n FROM conversations),
w AS (SELECT 'No. ' || n AS w FROM p UNION SELECT upper(role) FROM p WHERE role <> 'system' UNION SELECT 'Chief ' || role FROM p WHERE role <> 'system')
SELECT string_agg(w, ', ' ORDER BY w) AS hotwords FROM w""",
    "name_variants": f"""WITH {PEOPLE}
SELECT DISTINCT person, variant FROM (SELECT person, unnest([alias, first, last, whole]) AS variant FROM r
  UNION SELECT person, unnest([trim(title || ' ' || last), title || ' ' || whole] || CASE WHEN contains(title, ' ') THEN [trim(title || ' Director ' || last), title || ' Director ' || whole] ELSE [] END) FROM t) WHERE variant <> ''""",
    "bundle_routes": f"""WITH l AS (SELECT doc_id, label FROM ({ORACLES['classify_rules']})), h AS (SELECT doc_id, hits FROM ({ORACLES['density_count']}))
SELECT doc_id, label, hits, CASE label WHEN 'city_council' THEN 'council_notes' WHEN 'finance_committee' THEN 'money_notes' WHEN 'zoning_committee' THEN 'zoning_notes' ELSE 'overview' END AS first,
  CASE label WHEN 'finance_committee' THEN 'figures' ELSE 'condense' END AS multi,
  CASE label WHEN 'finance_committee' THEN 'budget_minutes' WHEN 'committee_of_the_whole' THEN 'committee_minutes' WHEN 'zoning_committee' THEN 'committee_minutes' ELSE 'minutes' END AS final FROM l JOIN h USING (doc_id)""",
    "index_chunks_sql": ORACLES["index_chunks"],
    "sentence_chunks_sql": ORACLES["sentence_chunks"],
    "sentences_sql": ORACLES["sentences_strict"],
    "caption_round_trip_sql": ORACLES["caption_round_trip"],
    "caption_blocks": ORACLES["caption_round_trip"],
    "index_persons": _persons(),
}
