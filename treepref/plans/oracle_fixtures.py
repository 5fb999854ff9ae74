"""DuckDB text of the fixtures (FIXTURES part B) for the oracle SQL.

Each entry is a CTE body over the driver's pre-registered views.  ``with_fx``
prefixes a query with the fixtures it names, in dependency order.
"""

from __future__ import annotations

FX: dict[str, str] = {}

FX["rlhf_qa"] = """
  WITH t AS (
    SELECT conv_id, role, text,
           row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS q
    FROM conversations WHERE role IN ('user', 'assistant')),
  qa AS (
    SELECT conv_id, q,
           max(CASE WHEN role = 'user' THEN text END) AS question,
           max(CASE WHEN role = 'assistant' THEN text END) AS answer
    FROM t WHERE q <= 4 GROUP BY conv_id, q),
  v AS (SELECT 1 AS v UNION ALL SELECT 2 UNION ALL SELECT 3)
  SELECT qa.conv_id, CAST(qa.q AS BIGINT) AS q, CAST(v.v AS BIGINT) AS v, qa.question, qa.answer,
         CASE WHEN (qa.conv_id + qa.q + v.v) % 9 = 0 THEN NULL ELSE b.text END AS var_answer
  FROM qa CROSS JOIN v
  JOIN benchmark b
    ON b.item_id = (qa.conv_id * 3 + qa.q * 5 + v.v) % (SELECT count(*) FROM benchmark)
"""

FX["rlhf_rating"] = """
  WITH k AS (
    SELECT c.conv_id, q.q, v.v, m.m, m.metric, r.r, r.rating_type,
           c.conv_id * 31 + q.q * 17 + v.v * 13 + m.m * 7 + r.r * 3 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    CROSS JOIN (SELECT 1 AS q UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) q
    CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 UNION ALL SELECT 3) v
    CROSS JOIN (SELECT 1 AS m, 'helpful' AS metric UNION ALL SELECT 2, 'honest' UNION ALL SELECT 3, 'harmless') m
    CROSS JOIN (SELECT 1 AS r, 'completion' AS rating_type UNION ALL SELECT 2, 'rm_output') r)
  SELECT conv_id, CAST(q AS BIGINT) AS q, CAST(v AS BIGINT) AS v, metric, rating_type,
         CASE WHEN h % 11 = 0 THEN NULL
              WHEN h % 13 = 0 THEN '<chosen:A>N/A</chosen:A><reject:B>x</reject:B>'
              WHEN h % 3 = 0 THEN '<chosen:A> good ' || CAST(h AS VARCHAR) || ' </chosen:A><reject:B> bad ' || CAST(q + v AS VARCHAR) || '</reject:B>'
              WHEN h % 7 = 0 THEN 'N/A'
              ELSE '0.' || CAST(h % 10 AS VARCHAR) END AS cell
  FROM k
"""

FX["trace"] = """
  WITH d AS (
    SELECT doc_id AS d, list_transform(range(0, 9), lambda k: split_part(text, ' ',
             1 + CAST(floor((length(text) - length(replace(text, ' ', ''))) * k / 8) AS INT))) AS w
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
  n AS (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3),
  l0 AS (SELECT d.d, d.w, n.j AS j0,
                'step 1, find entity ' || d.w[(d.d * 7 + n.j) % 5 + 1] || '.' AS y
         FROM d CROSS JOIN n),
  l1 AS (SELECT l0.d, l0.w, l0.j0, n.j AS j1,
                l0.y || ' step 2, use fact ' || l0.w[(l0.d + l0.j0 * 3 + n.j) % 4 + 6] || '.' AS y
         FROM l0 CROSS JOIN n WHERE n.j < 3),
  l2 AS (SELECT l1.d, l1.j0, l1.j1, n.j AS j2,
                l1.y || CASE WHEN (l1.d + l1.j0 + l1.j1 * 2 + n.j) % 7 = 3 THEN ' step 3, no answer, item '
                             ELSE ' step 3, so the final answer is: item ' END || l1.w[(l1.d + l1.j0 * 2 + l1.j1 + n.j) % 3 + 1] || '.' AS y
         FROM l1 CROSS JOIN n WHERE n.j < 2)
  SELECT d AS question_id, 0 AS step, j0 * 100 AS path_id, y AS candidate, (d * 3 + j0 * 5) % 6 AS score FROM l0
  UNION ALL
  SELECT d, 1, j0 * 100 + j1 * 10, y, (d * 5 + j0 * 7 + j1 * 3) % 6 FROM l1
  UNION ALL
  SELECT d, 2, j0 * 100 + j1 * 10 + j2, y, (d * 7 + j0 + j1 * 5 + j2 * 2) % 6 FROM l2
"""

FX["math_trace"] = """
  WITH n AS (SELECT 0 AS j UNION ALL SELECT 1),
  l0 AS (SELECT p_partkey AS d, j AS path, p_size + j + 1 AS v,
                'step 1, take ' || p_size || ' + ' || (j + 1) || ' = ' || (p_size + j + 1) || '.' AS y FROM part CROSS JOIN n),
  l1 AS (SELECT d, path * 2 + j AS path, v * (j + 1) AS v,
                y || ' step 2, take ' || v || ' * ' || (j + 1) || ' = ' || (v * (j + 1)) || '.' AS y FROM l0 CROSS JOIN n),
  l2 AS (SELECT d, path * 2 + j AS path, v - (j + 1) AS v,
                y || ' step 3, take ' || v || ' - ' || (j + 1) || ' = ' || (v - (j + 1)) || '.' AS y FROM l1 CROSS JOIN n),
  l3 AS (SELECT d, path * 2 + j AS path, v,
                y || ' step 4, the answer (arabic numerals) is ' || CASE WHEN (d + path + j) % 5 = 0 THEN 'unknown'
                     WHEN j = 1 THEN '1,' || v ELSE CAST(v AS VARCHAR) END || '.' AS y FROM l2 CROSS JOIN n)
  SELECT d AS question_id, 0 AS step, path AS path_id, y AS candidate, (d * 3 + path * 5) % 6 AS score FROM l0
  UNION ALL SELECT d, 1, path, y, (d * 3 + path * 5 + 1) % 6 FROM l1
  UNION ALL SELECT d, 2, path, y, (d * 3 + path * 5 + 2) % 6 FROM l2
  UNION ALL SELECT d, 3, path, y, (d * 3 + path * 5 + 3) % 6 FROM l3
"""

FX["verdict"] = """
  SELECT c.doc_id AS question_id, e.e AS eval_id,
         CASE WHEN (c.doc_id * 3 + e.e) % 6 = 0 THEN 'The thought helps.' || chr(10) || 'Likely'
              WHEN (c.doc_id * 3 + e.e) % 6 = 1 THEN 'Impossible'
              WHEN (c.doc_id * 3 + e.e) % 6 = 2 THEN 'So this is unlikely to help.'
              WHEN (c.doc_id * 3 + e.e) % 6 = 3 THEN 'I am sure of it'
              WHEN (c.doc_id * 3 + e.e) % 6 = 4 THEN 'no verdict at all'
              ELSE 'likely, or impossible' END AS output
  FROM documents c
  CROSS JOIN (SELECT 0 AS e UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) e
"""

FX["math_raw"] = """
  SELECT l_orderkey, l_linenumber,
         '  Order ' || CAST(l_orderkey AS VARCHAR) || ' line ' || CAST(l_linenumber AS VARCHAR) || '? ' AS question,
         'Take <<' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '*2=' || CAST(CAST(l_quantity AS INT) * 2 AS VARCHAR) || '>> it. #### ' || CAST(CAST(l_quantity AS INT) * 2 AS VARCHAR) AS answer,
         'Step 3, The answer (arabic numerals) is ' || CASE WHEN l_orderkey % 4 = 0 THEN 'unknown.' WHEN l_orderkey % 4 = 1 THEN '1,' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.' ELSE CAST(CAST(l_quantity AS INT) * 2 AS VARCHAR) || ' units.' END AS prediction
  FROM lineitem
"""

FX["qa_pred"] = """
  SELECT b.item_id, 'Q' || CAST(b.item_id AS VARCHAR) || ': ' || b.text AS question,
         split_part(b.text, ' ', 2) || ' ' || split_part(b.text, ' ', 3) AS ground_truth,
         'step 1, ' || b.text || chr(10) ||
         CASE WHEN b.item_id % 5 = 0 THEN 'step 2, no conclusion.'
              WHEN b.item_id % 5 = 1 THEN 'step 3, so the final answer is: ' || split_part(b.text, ' ', 4) || '.'
              ELSE 'Step 3, So the final answer is: "' || lower(split_part(b.text, ' ', 2)) || '-' || split_part(b.text, ' ', 3) || '".' END AS prediction
  FROM benchmark b
"""

FX["verdict_text"] = """
  SELECT d.doc_id AS question_id, v.e AS eval_id, coalesce(d.text, '') || chr(10) ||
         CASE (d.doc_id * 3 + v.e) % 6 WHEN 0 THEN 'The thought helps.' || chr(10) || 'Likely' WHEN 1 THEN 'Impossible'
              WHEN 2 THEN 'So this is unlikely to help.' WHEN 3 THEN 'I am sure of it' WHEN 4 THEN 'no verdict at all'
              ELSE 'likely, or impossible' END AS output
  FROM documents d, (SELECT unnest(range(0, 5)) AS e) v
"""

FX["pref_eval"] = """
  SELECT a.doc_id AS sample_id, a.lang AS prompt, a.text AS generated,
         b.text AS chosen, c.text AS rejected
  FROM documents a
  JOIN documents b ON b.doc_id = a.doc_id + 1
  JOIN documents c ON c.doc_id = a.doc_id + 2
"""

FX["gens"] = """
  SELECT doc_id, p AS prompt, CASE doc_id % 7
      WHEN 0 THEN t
      WHEN 1 THEN p || '<s>Step 1, ' || replace(t, '. ', '. Step 2, ') || '</s>'
      WHEN 2 THEN p || 'Step 1, ' || t || chr(10) || CASE doc_id % 3 WHEN 0 THEN 'Question: ' WHEN 1 THEN 'Claim: ' ELSE 'Task: ' END || t
      WHEN 3 THEN 'Input: ' || replace(replace(t, chr(10), chr(10) || 'Input: '), '. ', '.' || chr(10))
      WHEN 4 THEN p || 'Step 1, ' || replace(t, ', ', ', so the final answer is: ') || ' Q: ' || t
      WHEN 5 THEN 'Steps: ' || t || chr(10) || 'Answer: ' || t
      ELSE 'Step 1, ' || t || ' Step 2, so. Step 3, ' || t || ' Step 4, it.' || chr(10) || chr(10) || t END AS text
  FROM (SELECT doc_id, 'Question: document ' || CAST(doc_id AS VARCHAR) || chr(10) AS p, coalesce(text, '') AS t FROM documents)
"""

FX["pref_vectors"] = """
  SELECT a.vec_id AS sample_id, a.embedding AS generated, b.embedding AS chosen, c.embedding AS rejected
  FROM embeddings a
  JOIN embeddings b ON b.vec_id = a.vec_id + 1
  JOIN embeddings c ON c.vec_id = a.vec_id + 2
"""

FX["run_log"] = """
  SELECT event_id * 2 AS line_no,
         CASE WHEN event_type = 'error' THEN 'noise' ELSE '====GR====' || event_type || '====Pre====x' END AS line
  FROM events
  UNION ALL
  SELECT event_id * 2 + 1,
         'user ' || CAST(user_id AS VARCHAR) || ' sum(accs) ' || CAST(event_id % 2 AS VARCHAR) || ' cnt_avg 0 cnt_any 0'
  FROM events
"""

FX["fact_pred"] = """
  SELECT doc_id, 'Claim ' || CAST(doc_id AS VARCHAR) || ': ' || coalesce(text, '') AS claim,
         CASE doc_id % 3 WHEN 0 THEN 'SUPPORTS' WHEN 1 THEN 'REFUTES' ELSE 'NOT ENOUGH INFO' END AS label,
         'step 1, ' || coalesce(text, '') || chr(10) ||
         'so the final answer is: ' || CASE doc_id % 7 WHEN 0 THEN 'suports' WHEN 1 THEN 'it is rejected' WHEN 2 THEN 'refutes' WHEN 3 THEN 'not enough info' WHEN 4 THEN 'no enough info' WHEN 5 THEN 'correct' ELSE 'maybe' END || '.' AS prediction
  FROM documents
"""

# Python str.strip() whitespace class and helpers, spelled for DuckDB (RE2).
WS = r"[\s\x{0b}\p{Z}\x{1c}-\x{1f}\x{85}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def with_fx(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <fixtures...>, <extra ctes...> <body>``."""
    parts = [f"{n} AS ({FX[n]})" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    if not parts:
        return body
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return "WITH " + ",\n".join(parts) + ",\n" + b[4:]
    return "WITH " + ",\n".join(parts) + "\n" + body
