"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

_RULES = """[{'host': 'org', 'path': '/', 'verdict': 'allow'},
  {'host': 'example.org', 'path': '/es/', 'verdict': 'block'},
  {'host': 'example.org', 'path': '/en/1', 'verdict': 'block'},
  {'host': 'com', 'path': '/fr/', 'verdict': 'allow'},
  {'host': 'com', 'path': '/de/', 'verdict': 'block'}]"""
ORACLE: dict[str, str] = {}

ORACLE["op4_topk"] = """
WITH e AS (
  SELECT vec_id, row_number() OVER () AS rid,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.rid, c.vec_id, CAST(list_sum(list_transform(
           list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.rid <> c.rid AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLE["op8_urlfilter"] = f"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
hosts AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
rules AS (SELECT unnest({_RULES}, recursive := true)),
fit AS (
  SELECT h.page_id, h.host, h.path, r.host || r.path AS rule, r.verdict
  FROM hosts h JOIN rules r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)),
best AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
         FROM fit GROUP BY ALL)
SELECT h.page_id, h.host, h.path, b.rule,
       coalesce(b.verdict, CASE WHEN regexp_matches(h.host || h.path,
         '(^|\\.)(spam-farm|cheap-pills|casino-[a-z]+|adult-[a-z]+|free-bets|ads-track)\\.') THEN 'block' ELSE 'allow' END) AS verdict
FROM hosts h LEFT JOIN best b ON h.page_id IS NOT DISTINCT FROM b.page_id AND h.host = b.host AND h.path = b.path
"""

ORACLE["op10_chat"] = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
esc AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\\\<#]', '', 'g'))
            + length(role) + length(regexp_replace(role, '[^\\\\<#:]', '', 'g'))
            + length('### ') + 2 + length('</turn>') + 1 AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev
  FROM c),
run AS (
  SELECT conv_id, min(pos) FILTER (WHERE NOT coalesce((prev IS NULL AND role IN ('system', 'user')) OR (prev = 'system' AND role = 'user')
                                     OR (prev = 'user' AND role = 'assistant') OR (prev = 'assistant' AND role = 'user'), FALSE)) AS bad,
         count(*) AS n, arg_max(role, pos) AS last_role
  FROM esc GROUP BY conv_id),
ends AS (SELECT conv_id, coalesce(bad, CASE WHEN last_role NOT IN ('user', 'assistant') THEN n END) AS refused_at FROM run)
SELECT conv_id, any_value(refused_at) IS NULL AS valid, any_value(refused_at) AS refused_at, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM esc JOIN ends USING (conv_id) GROUP BY conv_id
"""

ORACLE["op3_decontamination"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i
        FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)),
met AS (SELECT rid, n, i, item_id FROM dw JOIN iw USING (n, win)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit
        FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM met) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""

ORACLE["op11_prefix_trie"] = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL),
crc(c, s, k, v) AS (
  SELECT c, s, 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT c, s, crc.k + 1, xor(crc.v >> 8, bits.v)
  FROM crc JOIN bits ON bits.k = 8 AND bits.i = xor(crc.v, CAST(ascii(substr(s, crc.k + 1, 1)) AS BIGINT)) % 256
  WHERE crc.k < length(s)),
conv AS (SELECT c, c - c % 20 AS base, xor(v, 4294967295) % 4 AS h FROM crc WHERE k = length(s)),
t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT conv.c, 0 AS part, p, role, text FROM conv JOIN t ON t.c = base AND p <= h
  UNION ALL
  SELECT conv.c, 1, p, role, text FROM conv JOIN t ON t.c = conv.c AND p > h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS depth, role, text FROM rebuilt),
path AS (
  SELECT c, depth, len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words,
         sha256(string_agg(role || chr(31) || text, chr(30)) OVER (PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS k
  FROM placed
  UNION ALL
  SELECT c, 0, 0, '' FROM conv),
longest AS (SELECT c, max(depth) AS l FROM path GROUP BY c),
node AS (
  SELECT p.depth, p.k, min(p.c) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE p.depth = l), '')) AS ends_sha256
  FROM path p JOIN longest USING (c) GROUP BY p.depth, p.k),
up AS (
  SELECT n.depth, n.k, a.depth AS above, a.k AS above_k, n.n_convs, n.words
  FROM node n JOIN path a ON a.c = n.conv_id AND a.depth <= n.depth),
kids AS (SELECT above AS depth, above_k AS k, count(*) AS n_children FROM up WHERE above = depth - 1 GROUP BY above, above_k),
total AS (
  SELECT up.above AS depth, up.above_k AS k, count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM up LEFT JOIN kids ON kids.depth = up.depth AND kids.k = up.k GROUP BY up.above, up.above_k),
parent AS (SELECT u.depth, u.k, p.conv_id AS parent_conv_id FROM up u JOIN node p ON p.depth = u.above AND p.k = u.above_k WHERE u.above = u.depth - 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM node n JOIN total USING (depth, k) LEFT JOIN kids USING (depth, k) LEFT JOIN parent USING (depth, k)
"""
