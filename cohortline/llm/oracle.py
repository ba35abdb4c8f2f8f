"""SQL for the corpus queries that SQL can express (DuckDB's dialect)."""

from __future__ import annotations

from .licenses import BASE, NOTICES
from .mixing import CHUNK, offset
from .queries import SEED

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_REACH = """
reach(id, low) AS (
  SELECT a, a FROM both_ways
  UNION
  SELECT e.b, r.low FROM reach r JOIN both_ways e ON e.a = r.id WHERE r.low < e.b
),
lowest AS (SELECT id, min(low) AS low FROM reach GROUP BY id)
"""

OP1 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_words('text', SPACED)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
each AS (SELECT doc_id, unnest(s) AS x FROM sets),
met AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS o FROM each p JOIN each q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY 1, 2),
both_ways AS (
  SELECT o.a, o.b FROM met o JOIN sets p ON p.doc_id = o.a JOIN sets q ON q.doc_id = o.b
  WHERE 100 * o.o >= 90 * (len(p.s) + len(q.s) - o.o)),
{_REACH}
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(l.low, s.doc_id)) AS component_id
FROM sets s LEFT JOIN lowest l ON l.id = s.doc_id
"""

OP2 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
both_ways AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= 0.9),
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a),
{_REACH}
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id)) AS component_id,
  coalesce(l.low, e.vec_id) >= e.vec_id AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN lowest l ON l.id = e.vec_id
"""

OP4 = f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SPACED}'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
ratios AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ratios),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size,
    coalesce(max(CASE WHEN level <= ratio THEN level END) OVER () * weight, 2.0::DOUBLE * source_size)) AS target FROM levels),
banded AS (SELECT *, length(bin(size)) AS band FROM sized),
salted AS (
  SELECT *, coalesce(doc_id % greatest(1, ceil(count(*) OVER (PARTITION BY source, band) / {CHUNK}.0))::BIGINT, 0) AS salt FROM banded),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY band, salt, size, doc_id NULLS FIRST) AS place FROM salted),
rated AS (
  SELECT p.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (least(floor({offset(SEED)!r}::DOUBLE + rate * place) - floor({offset(SEED)!r}::DOUBLE + rate * (place - 1)), 2) * size)::BIGINT AS taken
FROM rated
"""

OP5 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(17 + length(role) + 2 * len(regexp_extract_all(role, '[%|<]')) + length(text)
    + len(regexp_extract_all(text, '(<|\[)~*(\||/?s>|/?INST\])')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP8 = r"""
WITH sides AS (
  SELECT page_id, url, html, CASE WHEN substr(md5(page_id::VARCHAR), 1, 2) < '04'
    THEN substr(html, 1, length(html) - 1) || CASE WHEN html LIKE '%#' THEN '*' ELSE '#' END ELSE html END AS other FROM pages),
made AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
      || chr(13) || chr(10) || 'Content-Length: ' AS head, html, other, chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM sides),
both_sides AS (
  SELECT page_id, page_id // 256 AS file, head || strlen(html) || gap || html || gap AS a, head || strlen(other) || gap || other || gap AS b
  FROM made),
placed AS (
  SELECT *, row_number() OVER w - 1 AS place, sum(strlen(a)) OVER w - strlen(a) AS start_a, sum(strlen(b)) OVER w - strlen(b) AS start_b
  FROM both_sides WINDOW w AS (PARTITION BY file ORDER BY page_id))
SELECT file, place, page_id AS key_a, start_a::BIGINT AS start_a, strlen(a)::BIGINT AS length_a, sha256(a) AS hash_a,
  page_id AS key_b, start_b::BIGINT AS start_b, strlen(b)::BIGINT AS length_b, sha256(b) AS hash_b
FROM placed WHERE a <> b OR start_a <> start_b
"""

OP10 = f"""
WITH item_words AS (SELECT item_id, {_words('text', ALNUM)} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS x FROM (
    SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM (
      SELECT *, least(10, len(w)) AS size FROM item_words WHERE len(w) > 0))),
doc_words AS (SELECT doc_id, {_words('text', ALNUM)} AS w FROM documents),
runs AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS x FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
met AS (SELECT r.doc_id, r.i, r.size, m.item_id FROM runs r JOIN windows m ON m.size = r.size AND m.x = r.x),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id
"""

_TEMPLATES = ", ".join(
    f"({i}, '{t.label}', {i < len(BASE)}, {t.exact}, '{t.text.replace(chr(39), chr(39) * 2)}')" for i, t in enumerate(BASE + NOTICES))

OP11 = f"""
WITH made(template, label, base, exact, w) AS (
  SELECT template, label, base, exact, {_words('text', ALNUM)} FROM (VALUES {_TEMPLATES}) t(template, label, base, exact, text)),
sized AS (SELECT *, least(3, len(w)) AS k FROM made),
positions AS (
  SELECT template, label, base, exact, k, len(w) - k + 1 AS grams, p - 1 AS place, array_to_string(w[p:p + k - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM sized)),
texts AS (SELECT row_number() OVER () AS r, doc_id, {_words('text', ALNUM)} AS w FROM documents),
rolled AS (
  SELECT r, k, i - 1 AS i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM texts, (SELECT DISTINCT k FROM sized) WHERE len(w) >= k)),
votes AS (
  SELECT r, template, label, base, exact, p.k, grams, i - place AS diagonal, count(*) AS votes, min(i) AS start, max(i) + p.k AS stop
  FROM rolled g JOIN positions p ON p.k = g.k AND p.gram = g.gram
  GROUP BY r, template, label, base, exact, p.k, grams, i - place),
strong AS (SELECT * FROM votes WHERE votes >= CASE WHEN exact THEN grams ELSE least(2, grams) END),
parted AS (
  SELECT *, CASE WHEN exact THEN 1 WHEN diagonal - lag(diagonal) OVER w <= 3 THEN 0 ELSE 1 END AS apart
  FROM strong WINDOW w AS (PARTITION BY r, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) AS cluster FROM parted),
spans AS (
  SELECT r, template, label, base, exact, k, grams, min(start) AS start, max(stop) - min(start) AS length, sum(votes) AS votes
  FROM numbered GROUP BY r, template, label, base, exact, k, grams, cluster),
kept AS (
  SELECT *, least(votes, grams, length - k + 1)::DOUBLE / grams AS coverage FROM spans
  WHERE least(votes, grams, length - k + 1)::DOUBLE / grams >= 0.5 AND length <= 2 * (grams + k - 1)),
summed AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(coverage) AS score
  FROM kept GROUP BY r)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(s.n_base, 0)::BIGINT AS n_base, s.first_word::BIGINT AS first_word,
  s.last_word::BIGINT AS last_word, coalesce(s.base_labels, '') AS base_labels, coalesce(s.labels, '') AS labels,
  coalesce(s.score, 0.0)::DOUBLE AS score
FROM texts t LEFT JOIN summed s ON s.r = t.r
"""

OP12 = f"""
WITH doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_words('text', ALNUM)} AS w FROM documents),
lengths AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM doc_words WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS all_terms FROM lengths),
items AS (SELECT DISTINCT item_id, {_words('text', ALNUM)} AS w FROM benchmark),
asked AS (SELECT item_id, term, count(*)::BIGINT AS asked FROM (SELECT item_id, unnest(w) AS term FROM items) GROUP BY ALL),
held AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM doc_words)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term), totals),
scores AS (
  SELECT a.item_id, h.r, l.doc_id,
    sum(a.asked * x.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * l.n * t.n_docs) // t.all_terms))))::BIGINT AS score
  FROM asked a JOIN held h ON h.term = a.term JOIN weights x ON x.term = a.term JOIN lengths l ON l.r = h.r, totals t
  GROUP BY a.item_id, h.r, l.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE = {
    "op1_jaccard_join": OP1, "op2_embedding_dedup": OP2, "op4_mixing": OP4, "op5_chat_format": OP5,
    "op8_fixity_audit": OP8, "op10_decontaminate": OP10,
    "op11_license_scan": OP11, "op12_ranked_search": OP12,
}
