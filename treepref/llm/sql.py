"""DuckDB SQL of the operators that SQL can express, written from their rules."""

from __future__ import annotations

#: crc32 of the distinct features, byte by byte with a table made from the polynomial.
RESAMPLE = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
         lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s, 1 AS c FROM documents
  UNION ALL
  SELECT NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 0 FROM benchmark),
word AS (
  SELECT doc_id, c, unnest(regexp_extract_all(s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM low),
kind AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM word),
crc AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2),
              lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM kind, tab),
hit AS (SELECT doc_id, c, bucket FROM word JOIN crc USING (w)),
cnt AS (SELECT bucket, sum(c) AS s, sum(1 - c) AS t FROM hit GROUP BY bucket),
tot AS (SELECT sum(s) AS s, sum(t) AS t FROM cnt),
gain AS (
  SELECT bucket, floor(1000 * ln((cnt.t + 1)::DOUBLE * (tot.s + 10000)::DOUBLE
               / ((cnt.s + 1)::DOUBLE * (tot.t + 10000)::DOUBLE)))::BIGINT AS g FROM cnt, tot),
per AS (
  SELECT doc_id, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS w
  FROM hit JOIN gain USING (bucket) WHERE c = 1 GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight,
         coalesce(w, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                               / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN per USING (doc_id)),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored s LEFT JOIN placed USING (doc_id)
"""

COLLOCATIONS = r"""
WITH RECURSIVE piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
seq AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
run AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g
  FROM seq, (VALUES (1), (2), (3), (4)) AS k(m)),
f AS MATERIALIZED (SELECT lang, m, g, count(*) AS f FROM run GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, m, g, f, string_split(g, ' ') AS w FROM f WHERE m >= 2 AND f >= 30),
cut AS (
  SELECT c.lang, c.m, c.g, c.f, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.g = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.g = array_to_string(c.w[k + 1:], ' ')),
low AS MATERIALIZED (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_of AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + s - 1], ' ') AS g, c.f AS longer
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM cand, (VALUES (2), (3)) AS x(s) WHERE s < m) c),
gone AS (SELECT DISTINCT c.lang, c.g FROM cand c JOIN inner_of i USING (lang, g) WHERE 100::HUGEINT * i.longer >= 80::HUGEINT * c.f),
kept AS (SELECT * FROM low ANTI JOIN gone USING (lang, g)),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, g) AS rank FROM kept),
edge AS MATERIALIZED (
  SELECT e.lang, e.g, e.f, array_to_string(e.w[1:3], ' ') AS u, array_to_string(e.w[2:4], ' ') AS v, e.w[4] AS last,
         a.f = e.f AS first_full, b.f = e.f AS last_full
  FROM cand e JOIN f a ON a.lang = e.lang AND a.g = array_to_string(e.w[1:3], ' ')
  JOIN f b ON b.lang = e.lang AND b.g = array_to_string(e.w[2:4], ' ') WHERE e.m = 4),
link AS MATERIALIZED (
  SELECT a.lang, a.g, b.g AS next, b.last FROM edge a JOIN edge b ON a.lang = b.lang AND a.v = b.u AND a.last_full AND b.first_full),
walk AS (
  SELECT DISTINCT lang, g AS head, g, g AS passage FROM link ANTI JOIN (SELECT lang, next AS g FROM link) USING (lang, g)
  UNION ALL
  SELECT w.lang, w.head, l.next, w.passage || ' ' || l.last FROM walk w JOIN link l ON w.lang = l.lang AND w.g = l.g),
full_path AS (SELECT lang, head, max_by(passage, length(passage)) AS passage FROM walk GROUP BY lang, head),
of_edge AS (SELECT w.lang, w.g, p.passage FROM walk w JOIN full_path p USING (lang, head))
SELECT p.lang, rank, p.g AS phrase, f AS a, l, r, n, score::BIGINT AS score, passage
FROM placed p JOIN total USING (lang) LEFT JOIN of_edge o ON o.lang = p.lang AND o.g = p.g
WHERE rank <= 2000
"""

#: The notices are data of the operator, not rules, and are put in as they are.
_LICENSES = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
note AS (
  SELECT row_number() OVER () AS notice, label, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (VALUES {notices}) AS v(label, t)),
phrase AS (SELECT label, string_split(p, ' ') AS w FROM (VALUES
  ('cc-by', 'cc by'), ('gpl', 'general public license'), ('reserved', 'all rights reserved')) AS v(label, p)),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list_distinct(list(label)) AS labels
  FROM (SELECT doc_id, label, unnest(list_filter(range(1, len(low.w) + 1), lambda i: low.w[i:i + len(phrase.w) - 1] = phrase.w)) AS i
        FROM low, phrase)
  GROUP BY doc_id),
spot AS (
  SELECT notice, label, len(w) AS length, i, w[i:i + 2] AS gram FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM note)),
hit AS (
  SELECT doc_id, notice, label, length, d.i - spot.i AS diagonal, spot.i AS place
  FROM (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS gram
        FROM low) d
  JOIN spot USING (gram)),
line AS (SELECT DISTINCT doc_id, notice, diagonal FROM hit),
step AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, notice ORDER BY diagonal) <= 4 THEN 0 ELSE 1 END AS fresh
  FROM line),
grp AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, notice ORDER BY diagonal) AS grp FROM step),
found AS (
  SELECT doc_id, label, count(DISTINCT place + k)::DOUBLE / any_value(length) AS covered
  FROM hit JOIN grp USING (doc_id, notice, diagonal), (VALUES (0), (1), (2)) AS x(k)
  GROUP BY doc_id, notice, label, grp HAVING covered >= 0.8),
more AS (SELECT doc_id, list_distinct(list(label)) AS labels, max(covered) AS covered FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(covered, 0.0::DOUBLE) END AS score
FROM low LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""


def licenses(notices) -> str:
    """The scan with the given (label, notice) pairs."""
    quoted = [tuple(x.replace("'", "''") for x in pair) for pair in notices]
    return _LICENSES.replace("{notices}", ", ".join(f"('{a}', '{b}')" for a, b in quoted))
