"""The queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

import string

from carrel.llm.rules import POLICIES, RULES, mask

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP2 = """
WITH k AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM k WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT k.page_id, payload_bytes, k.payload_digest,
       CASE WHEN first_id IS NULL OR first_id = k.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> k.page_id THEN first_id END AS refers_to
FROM k LEFT JOIN f ON k.payload_digest = f.payload_digest AND payload_bytes >= 100
"""

_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))

OP5 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, {_WORD}) AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
x AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
e AS (SELECT r, count(*) AS n_echoes FROM (SELECT r, word, lead(word) OVER (PARTITION BY r ORDER BY i) AS following FROM x) WHERE word = following GROUP BY r),
g AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS gram FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM w)),
s AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT pos) AS n_repeat FROM (SELECT r, unnest(range(i, i + 8)) AS pos FROM s) GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(n_echoes, 0) AS n_echoes, coalesce(n_repeat, 0) AS n_repeat_words
      FROM w LEFT JOIN e USING (r) LEFT JOIN c USING (r)),
b AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & {mask(POLICIES["base-1"])}) <> 0 AS base_failed, (failed & {mask(POLICIES["strict-1"])}) = 0 AS kept, failed
FROM b
"""

_NAMED = ", ".join(f"('{rule}', {1 << i})" for i, rule in enumerate(RULES))

ABLATION = f"""
WITH book AS ({OP5})
SELECT rule, count(*) FILTER ((failed & bit) <> 0) AS n_failed, count(*) FILTER ((failed & {mask(POLICIES["strict-1"])}) = bit) AS n_only
FROM book, (VALUES {_NAMED}) r(rule, bit) GROUP BY rule
"""

OP7 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS i FROM w)),
f AS (SELECT gram, min(doc_id) AS first_id FROM g GROUP BY gram),
hit AS (SELECT DISTINCT doc_id, pos AS i FROM (SELECT g.doc_id, unnest(range(i, i + 13)) AS pos FROM g JOIN f USING (gram) WHERE first_id < g.doc_id)),
x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT x.doc_id, count(hit.i) AS n_removed, string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE hit.i IS NULL) AS kept FROM x LEFT JOIN hit ON x.doc_id = hit.doc_id AND x.i = hit.i GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents),
i AS (SELECT item_id, ws, least(5, len(ws)) AS k FROM (SELECT item_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM benchmark)),
ig AS (SELECT DISTINCT item_id, k, array_to_string(ws[j:j + k - 1], ' ') AS gram FROM (SELECT item_id, k, ws, unnest(range(1, len(ws) - k + 2)) AS j FROM i WHERE k > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM ig GROUP BY item_id),
dk AS (SELECT doc_id, ws, k FROM d, (SELECT DISTINCT k FROM ig)),
dg AS (SELECT DISTINCT doc_id, k, array_to_string(ws[j:j + k - 1], ' ') AS gram FROM (SELECT doc_id, k, ws, unnest(range(1, greatest(len(ws) - k + 2, 1))) AS j FROM dk)),
h AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ig JOIN dg USING (k, gram) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / CAST(n_shingles AS DOUBLE) AS containment
FROM h JOIN n USING (item_id) WHERE n_shared >= greatest(1, ceil(0.8 * n_shingles - 1e-9))
"""

OP10 = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size,
                  md5('carrel-mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 2.0 * source_size AS cap, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM s),
o AS (SELECT CAST(cap AS DOUBLE) AS cap, CAST(weight AS DOUBLE) AS weight, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS m FROM w),
p AS (SELECT m, cap, weight, coalesce(sum(cap) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(weight) OVER (ORDER BY m ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o),
l AS (SELECT min_by((1.5 * (SELECT CAST(sum(size) AS DOUBLE) FROM d) - held) / free, m) AS level FROM p
      WHERE cap >= weight * ((1.5 * (SELECT CAST(sum(size) AS DOUBLE) FROM d) - held) / free)),
t AS (SELECT source, source_size, CAST(least(cap, coalesce(weight * level, cap)) AS DOUBLE) AS target FROM w, l),
r AS (SELECT d.doc_id, size, source_size, target, CAST(floor(target / source_size) AS BIGINT) AS whole,
             CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size > 0 THEN whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * source_size - start)) ELSE 0 END AS taken
FROM r
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
x AS (SELECT r, lang, source, translate(w, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS term FROM (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM d)),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS in_lang FROM x GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(in_lang) AS HUGEINT) AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM x JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT g.lang, g.source, coalesce(max(v), 0) AS v, coalesce(max(total), 0) AS lang_total, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total
      FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN l ON g.lang = l.lang LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 2) // (total + 2 * v) AS p, 1 + 1000000000 * (in_lang + 2) // (lang_total + 2 * v) AS q
      FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 10
"""
