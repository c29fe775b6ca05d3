"""What queries must agree with, in DuckDB's SQL, where SQL can say it."""

from seriesmill.llm import quality_rules

_WORD = r"'[^\x20\x09-\x0D]+'"
_BITS = " + ".join(f"CASE WHEN {condition} THEN {1 << k} ELSE 0 END" for k, condition in enumerate(quality_rules.RULES.values()))

RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS u
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, {_WORD}) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_lines,
             coalesce(lines.n - lines.u, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & {quality_rules.bits(quality_rules.POLICIES['base'])} <> 0 AS base_failed,
       failed_bits & {quality_rules.bits(quality_rules.POLICIES['base']) | quality_rules.bits(quality_rules.POLICIES[quality_rules.CURRENT])} = 0 AS kept,
       failed_bits, '{quality_rules.CURRENT}' AS policy FROM b"""

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             {_WORD}) AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                                 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM d),
u AS (SELECT DISTINCT doc_id, g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * both_ >= 85 * (x.n + y.n - both_)),
r AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

# SHA-1 in base 32: 40 hexadecimal digits as 160 binary ones, then five at a time.
ARCHIVED = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first,
             array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', sha1(h)[i]) - 1), 4, '0')), '') AS bits FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT)
               + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT) + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to FROM x"""

AUDIT = rf"""
WITH said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
              FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
m AS (SELECT part, doc_id, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d),
g AS (SELECT part, list_concat(CASE WHEN a THEN ['A'] ELSE [] END, CASE WHEN b THEN ['B'] ELSE [] END, CASE WHEN c THEN ['C'] ELSE [] END,
                               CASE WHEN d THEN ['D'] ELSE [] END, CASE WHEN e THEN ['E'] ELSE [] END) AS fails,
             count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN said USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT v.x || w.x || x.x || y.x || z.x AS filter_order FROM x v, x w, x, x y, x z WHERE len(list_distinct([v.x, w.x, x.x, y.x, z.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS f, string_split(left(filter_order, step - 1), '') AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f, list_contains(fails, f) AS hit, len(list_intersect(fails, before)) > 0 AS gone, len(fails) AS k, n, good, toxic
      FROM s, g),
q AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant, sum(CASE WHEN hit AND k = 1 THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END) AS toxic_lost
      FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM q"""

LINES = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id"""
