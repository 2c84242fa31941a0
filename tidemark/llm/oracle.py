"""DuckDB reference SQL of the corpus queries that SQL can express."""

from __future__ import annotations

LLM_ORACLE: dict[str, str] = {
    "op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, text, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM documents WHERE text IS NOT NULL)),
windows AS (
  SELECT doc_id, pos, line, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2, words, words + lead(words, 1) OVER w AS words2
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
firsts AS (  -- three lines, or fewer lines of over 50 words
  SELECT doc_id, pos, 3 AS many, row_number() OVER (PARTITION BY line, l1, l2 ORDER BY doc_id, pos) AS nth FROM windows WHERE l2 IS NOT NULL
  UNION ALL SELECT doc_id, pos, 2, row_number() OVER (PARTITION BY line, l1 ORDER BY doc_id, pos) FROM windows WHERE l1 IS NOT NULL AND words2 > 50
  UNION ALL SELECT doc_id, pos, 1, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) FROM windows WHERE words > 50),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM firsts, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1 AND k < many),
marked AS (
  SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS cut,
         g.pos IS NOT NULL AND lag(g.pos) OVER (PARTITION BY l.doc_id ORDER BY l.pos) IS NULL AS opens
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos)
SELECT d.doc_id, count(m.pos) AS n_lines, CAST(count(*) FILTER (WHERE m.cut) AS BIGINT) AS n_removed,
       CAST(count(*) FILTER (WHERE m.opens) AS BIGINT) AS n_runs,
       sha256(coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (WHERE NOT m.cut), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id GROUP BY d.doc_id
""",
    "op2_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
""",
    "op7_search": r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
len AS (SELECT d.doc_id, coalesce(sum(tf), 0) AS dl FROM documents d LEFT JOIN tf USING (doc_id) GROUP BY 1),
stat AS (SELECT count(*) AS n, avg(dl) AS mean FROM len),
idf AS (SELECT term, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, stat GROUP BY term),
scored AS (
  SELECT q.doc_id AS query_id, t.doc_id, round(sum(idf * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score
  FROM tf q JOIN tf t ON q.term = t.term JOIN idf ON idf.term = q.term JOIN len ON len.doc_id = t.doc_id, stat
  WHERE q.doc_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored QUALIFY rank <= 10
""",
    "op12_treap_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
scored AS (
  SELECT a.item_id, t.doc_id, CAST(sum(w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (100 - 50 + (50 * l.n * docs) // total.terms)))) AS BIGINT) AS score
  FROM asked a JOIN tf t ON a.term = t.term JOIN weight ON weight.term = a.term JOIN len l ON l.doc_id = t.doc_id, total GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
""",
    # the damage key's CRC-32 from its byte table; then the cheapest edits row by row, over the four grammar states
    "op11_conversation_repair": r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS bytes
  FROM (SELECT unnest(range(256)) AS n)),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(key[i]) AS BIGINT))),
         lambda c, b: xor(c >> 8, bytes[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS how FROM keyed, crc_table),
after AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (SELECT unnest([1, 2]) AS copy) WHERE how <> 0 AND (copy = 1 OR how = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM after),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS pos, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM numbered),
faulty AS (
  SELECT *, left(role, 1) AS ini, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) IN ('.', '!', '?') THEN 'none' ELSE 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS prior FROM placed),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pos > 1 AND prior || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faulty GROUP BY conv_id),
inserts AS (  -- up to two inserts in front of a row or at the end: state, state after, audit, cost, lines
  SELECT * FROM (VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
    (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']), (3, 2, 'I', 5, ['user:']),
    (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:']), (2, 2, 'II', 10, ['assistant:', 'user:'])) AS v(s0, s1, ins, c, ls)),
moves AS (  -- inserts, then the row's edit
  SELECT s0, ini, gone, s2, ins || e AS audit, i.c + m.c AS cost, i.ls AS ls, role FROM inserts i JOIN (
    SELECT s, s AS s2, 'D' AS e, 2 AS c, NULL AS role, ini, gone FROM (SELECT unnest([0, 1, 2, 3]) AS s), (SELECT unnest(['s', 'u', 'a', 'x']) AS ini), (SELECT unnest([TRUE, FALSE]) AS gone)
    UNION ALL SELECT s, s2, 'K', 0, '', ini, FALSE FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS k(s, ini, s2)
    UNION ALL SELECT s, s2, 'R', 1, r, ini, FALSE FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) AS k(s, s2, r), (SELECT unnest(['s', 'u', 'a', 'x']) AS ini)
  ) m ON i.s1 = m.s),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS ls FROM faults
  UNION ALL
  SELECT conv_id, pos, s, x.cost, x.audit, x.ls FROM (
    SELECT b.conv_id, f.pos, m.s2 AS s, min({'cost': b.cost + m.cost + CASE WHEN f.fault = 'truncated' AND m.role IS NOT NULL THEN 5 ELSE 0 END, 'audit': b.audit || m.audit,
           'ls': b.ls || CAST(m.ls AS VARCHAR[]) || CASE WHEN m.role IS NULL THEN CAST([] AS VARCHAR[]) WHEN m.role = '' THEN [f.role || ':' || f.text] ELSE [m.role || ':' || f.text] END}) AS x
    FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.pos = b.pos + 1
    JOIN moves m ON m.s0 = b.s AND m.ini = CASE WHEN f.ini IN ('s', 'u', 'a') THEN f.ini ELSE 'x' END AND m.gone = (f.fault IN ('blank', 'duplicate')) GROUP BY 1, 2, 3)),
done AS (
  SELECT b.conv_id, min({'cost': b.cost + i.c, 'audit': b.audit || i.ins, 'ls': b.ls || CAST(i.ls AS VARCHAR[])}) AS x
  FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.pos JOIN inserts i ON i.s0 = b.s AND i.s1 IN (0, 3) GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(x.cost, 0) AS cost, coalesce(x.audit, '') AS audit, sha256(coalesce(array_to_string(x.ls, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
""",
}
