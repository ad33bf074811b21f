"""Check statements (DuckDB) of the queries that SQL can express.

The others are held against plain versions in ``tests/llm``: fingerprints, hashed-text models, token
ids and keyed permutations have no SQL form.
"""

STATEMENTS: dict[str, str] = {
    "op5_embedding_dedup": """
WITH RECURSIVE v AS (
 SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
 WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT e.vec_id, COALESCE(l.n, 0) AS n_links, r.least AS component_id, e.vec_id = r.least AS kept
FROM embeddings e LEFT JOIN (SELECT x, COUNT(*) AS n FROM links GROUP BY x) l ON l.x = e.vec_id
JOIN (SELECT x, MIN(y) AS least FROM reached GROUP BY x) r ON r.x = e.vec_id""",
    "op7_chat_formatting": """
WITH asked AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'user'),
events AS (
 SELECT c.conv_id, c.turn, c.text, CASE WHEN role = 'user' THEN 'call' WHEN role = 'assistant' AND a.turn IS NOT NULL THEN 'result' ELSE 'message' END AS kind,
  CASE WHEN role = 'user' THEN 'reply' ELSE role END AS name
 FROM conversations c LEFT JOIN asked a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1),
named AS (SELECT *, CASE kind WHEN 'call' THEN CAST(turn AS VARCHAR) WHEN 'result' THEN CAST(turn - 1 AS VARCHAR) END AS event_id FROM events),
answered AS (SELECT DISTINCT conv_id, event_id FROM named WHERE kind = 'result'),
judged AS (
 SELECT n.*, CASE WHEN kind <> 'call' THEN kind WHEN a.event_id IS NULL THEN 'call without result' ELSE 'call' END AS state
 FROM named n LEFT JOIN answered a ON n.kind = 'call' AND a.conv_id = n.conv_id AND a.event_id = n.event_id)
SELECT conv_id, turn, kind, event_id, name, state, CAST(CASE kind WHEN 'result' THEN 1 ELSE 0 END AS BIGINT) AS level, CAST(0 AS BIGINT) AS n_errors,
 '{' || CASE kind WHEN 'call' THEN '"arguments":{"question":' || to_json(COALESCE(text, '')) || '}' ELSE '"content":' || COALESCE(to_json(text), 'null') END
 || CASE WHEN event_id IS NULL THEN '' ELSE ',"id":"' || event_id || '"' END
 || ',"kind":"' || kind || '"' || COALESCE(',"name":"' || name || '"', '') || ',"state":"' || state || '"' || COALESCE(',"turn":' || turn, '') || '}' AS line
FROM judged""",
    "op11_conversation_trie": r"""
WITH RECURSIVE ordered AS (
 SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
 FROM conversations WHERE conv_id IS NOT NULL),
own AS (
 SELECT conv_id, COUNT(*) AS n, conv_id - conv_id % 20 AS base,
  xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: ascii(d)::UBIGINT)),
   lambda c, d: list_reduce([xor(c, d), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))) % 4 AS h
 FROM ordered GROUP BY conv_id),
turns AS (
 SELECT c.conv_id, 0 AS part, o.place, o.role, o.text FROM own c JOIN ordered o ON o.conv_id = c.base AND o.place <= c.h
 UNION ALL SELECT c.conv_id, 1, o.place, o.role, o.text FROM own c JOIN ordered o ON o.conv_id = c.conv_id AND o.place > c.h),
placed AS (SELECT conv_id, text, sha256(to_json([role, text])) AS t, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM turns),
paths AS (
 SELECT conv_id, depth, text, string_agg(t, '') OVER w AS key FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
 UNION ALL SELECT conv_id, 0, '', '' FROM own),
lengths AS (SELECT conv_id, MAX(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (
 SELECT p.key, p.depth, MIN(p.conv_id) AS conv_id, COUNT(*) AS n_convs, ANY_VALUE(len(regexp_extract_all(p.text, '[^\x20\x09-\x0D]+'))) AS words,
  sha256(COALESCE(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE l.length = p.depth), '')) AS ends_sha256
 FROM paths p JOIN lengths l USING (conv_id) GROUP BY p.key, p.depth),
children AS (SELECT left(key, 64 * (depth - 1)) AS key, COUNT(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
sums AS (
 SELECT a.key, SUM(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, SUM((b.n_convs - 1) * CASE WHEN b.depth = 0 THEN 0 ELSE b.words END) AS saved
 FROM (SELECT n.key, n.n_convs, n.depth, n.words, unnest(range(0, n.depth + 1)) AS up FROM nodes n) b JOIN nodes a ON a.key = left(b.key, 64 * b.up) LEFT JOIN children c ON c.key = b.key
 GROUP BY a.key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, COALESCE(c.n, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
 CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, 64 * (n.depth - 1))""",
    "op12_decontamination": r"""
WITH item_words AS (
 SELECT COALESCE(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
 SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS k
 FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)),
doc_words AS (
 SELECT row_number() OVER () AS r, doc_id, COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
spots AS (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS k FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc_words, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT DISTINCT r, s, n, item FROM spots JOIN windows USING (n, k)),
covered AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM hits)) GROUP BY r),
listed AS (SELECT r, COUNT(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, COALESCE(items, sha256('')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)""",
    "op13_filter_audit": r"""
WITH RECURSIVE texts AS (SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS text, COALESCE(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
labelled AS (SELECT doc_id, BOOL_OR(quality = 1) AS good, BOOL_OR(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
 SELECT part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
   + CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
   + CASE WHEN doc_id > MIN(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask, COALESCE(good, false) AS good, COALESCE(toxic, false) AS toxic
 FROM texts LEFT JOIN labelled USING (doc_id)),
counts AS (SELECT part, mask, COUNT(*) AS n, COUNT(*) FILTER (WHERE good) AS good, COUNT(*) FILTER (WHERE toxic) AS toxic FROM masks GROUP BY part, mask),
orders AS (SELECT '' AS filter_order UNION ALL SELECT filter_order || f FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) t(f) WHERE NOT contains(filter_order, f)),
steps AS (
 SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
  list_sum([0] || list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS earlier
 FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE len(filter_order) = 5)),
told AS (
 SELECT part, filter_order, step, bit,
  COALESCE(SUM(n) FILTER (WHERE mask & (CAST(earlier AS INTEGER) + bit) = 0), 0) AS kept,
  COALESCE(SUM(n) FILTER (WHERE mask & CAST(earlier AS INTEGER) = 0 AND mask & bit > 0), 0) AS removed,
  COALESCE(SUM(n) FILTER (WHERE mask & CAST(earlier AS INTEGER) > 0 AND mask & bit > 0), 0) AS redundant,
  COALESCE(SUM(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
  COALESCE(SUM(good) FILTER (WHERE mask & CAST(earlier AS INTEGER) = 0 AND mask & bit > 0), 0) AS good_lost,
  COALESCE(SUM(toxic) FILTER (WHERE mask & CAST(earlier AS INTEGER) = 0 AND mask & bit > 0), 0) AS toxic_lost
 FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
 CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(SUM(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told""",
}
