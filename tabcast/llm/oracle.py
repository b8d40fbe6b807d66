"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17') AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight FROM s
), p AS (
  SELECT *, source_size * 3 / weight AS stop FROM w
), q AS (
  SELECT *, row_number() OVER o AS nth, coalesce(sum(source_size * 3) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
         coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped_weight,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM p WINDOW o AS (ORDER BY stop, source NULLS LAST)
), x AS (
  SELECT arg_min((total - stopped) / (weights - stopped_weight), nth) AS x FROM q
  WHERE (total - stopped) / (weights - stopped_weight) <= stop
), t AS (
  SELECT source, source_size,
         CASE WHEN x IS NULL OR stop < x THEN CAST(source_size * 3 AS DOUBLE) ELSE x * weight END AS target
  FROM q CROSS JOIN x
), r AS (
  SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_word
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST((budget // greatest(source_size, 1)) * size
            + greatest(0, least(size, budget - (budget // greatest(source_size, 1)) * source_size - first_word)) AS BIGINT) AS taken,
       source, first_word
FROM r
"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(role) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), q AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM q
"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh
  FROM w
), e AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS node, doc_id AS reached FROM s
  UNION SELECT r.node, p.b FROM r JOIN p ON r.reached = p.a
), c AS (
  SELECT node, min(reached) AS component_id FROM r GROUP BY node
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id FROM s JOIN c ON s.doc_id = c.node
"""

PREFIX_TRIE = r"""
WITH RECURSIVE steps AS (  -- CRC-32 by its table, which the rule below builds
  SELECT i, i AS v, 0 AS n FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)) b
  UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, n + 1 FROM steps WHERE n < 8
), crc AS (
  SELECT list(v ORDER BY i) AS tbl FROM steps WHERE n = 8
), r AS (
  SELECT CAST(conv_id AS BIGINT) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')), md5(coalesce(text, ''))) AS i,
         md5(coalesce(role, '')) || md5(coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT DISTINCT c FROM r
), hs AS (
  SELECT c, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                            lambda a, b: xor(a // 256, tbl[CAST(xor(a % 256, b) AS INT) + 1])), 4294967295) % 6 AS h
  FROM ids CROSS JOIN crc
), b AS (
  SELECT hs.c, r.i AS i, r.t, r.chars FROM hs JOIN r ON r.c = hs.c - hs.c % 100 AND r.i <= h
  UNION ALL SELECT hs.c, 1000000000 + r.i, r.t, r.chars FROM hs JOIN r ON r.c = hs.c AND r.i > h
), s AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, t, chars FROM b
), p AS (
  SELECT c, d, chars, string_agg(t, '' ) OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM s
  UNION ALL SELECT c, 0, 0, '' FROM ids
), q AS (
  SELECT c, d, chars, md5(k) AS k, lag(md5(k)) OVER (PARTITION BY c ORDER BY d) AS up, max(d) OVER (PARTITION BY c) = d AS ends FROM p
), n AS (
  SELECT k, d, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM q GROUP BY k, d
), kids AS (
  SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up
), below AS (
  SELECT DISTINCT a.k AS top, b.k AS k FROM q AS a JOIN q AS b ON a.c = b.c AND a.d <= b.d
), sums AS (
  SELECT top AS k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM below JOIN n ON n.k = below.k LEFT JOIN kids ON kids.k = below.k GROUP BY top
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sums ON sums.k = n.k LEFT JOIN n AS u ON u.k = n.up LEFT JOIN kids ON kids.k = n.k
"""

SQL = {"op2_mixing": MIX, "op3_ngram_join": NGRAM_JOIN, "op7_warc": WARC, "op9_chat": CHAT, "op11_prefix_trie": PREFIX_TRIE}
