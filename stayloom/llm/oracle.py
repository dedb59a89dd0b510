"""DuckDB twins of the corpus queries, where SQL can express them."""

OP1 = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS seq,
         len(regexp_extract_all(text, '[\p{L}\p{M}]{1,4}|\p{N}{1,3}|[^\x09-\x0D\x20\p{L}\p{M}\p{N}]')) + 4 AS tokens
  FROM raw),
p AS (SELECT *, (sum(tokens) OVER (PARTITION BY conv_id ORDER BY seq))::BIGINT AS prefix FROM t),
r AS (
  SELECT conv_id, greatest(832 - coalesce(max(CASE WHEN seq = 1 AND role = 'system' THEN tokens END), 0), 256) AS room
  FROM p GROUP BY conv_id),
walk AS (
  SELECT conv_id, seq, seq AS first, prefix - tokens AS before FROM p WHERE seq = 1
  UNION ALL
  SELECT p.conv_id, p.seq,
         CASE WHEN (p.seq - 1) % 256 = 0 OR p.prefix - w.before > r.room THEN p.seq ELSE w.first END,
         CASE WHEN (p.seq - 1) % 256 = 0 OR p.prefix - w.before > r.room THEN p.prefix - p.tokens ELSE w.before END
  FROM walk w JOIN p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.seq = w.seq + 1
  JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
spans AS (SELECT conv_id, first, max(seq) AS last, min(before) AS before FROM walk GROUP BY conv_id, first),
sized AS (
  SELECT p.conv_id, 24 + length(p.role) + length(p.text)
         + length(p.role) - length(replace(p.role, chr(10), ''))
         + length(p.role) - length(replace(p.role, '\', '')) + length(p.text) - length(replace(p.text, '\', ''))
         + len(regexp_extract_all(p.role, '<\|im_(?:start|end)\|>|<\|endoftext\|>|</?s>|<</?SYS>>|\[/?INST\]'))
         + len(regexp_extract_all(p.text, '<\|im_(?:start|end)\|>|<\|endoftext\|>|</?s>|<</?SYS>>|\[/?INST\]')) AS chars
  FROM spans s JOIN p ON p.conv_id IS NOT DISTINCT FROM s.conv_id
  WHERE p.seq BETWEEN s.first AND s.last OR p.seq < s.first AND (
    p.seq = 1 AND p.role = 'system' OR p.seq >= s.first - 2 AND s.before - p.prefix + p.tokens <= 192))
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars FROM (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = 'assistant'), '')) AS loss_sha256
  FROM p GROUP BY conv_id) a
JOIN (SELECT conv_id AS c, sum(chars)::BIGINT AS formatted_chars FROM sized GROUP BY conv_id) b
  ON a.conv_id IS NOT DISTINCT FROM b.c
"""

OP2 = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       text_sha256
FROM t WINDOW w AS (PARTITION BY body)
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, k.c AS component_id, w.doc_id = k.c AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) k ON k.a = w.doc_id
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS k FROM i
        WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, k, a.n, item_id FROM places a JOIN grams g ON a.gram = g.gram AND a.n = g.n),
covered AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS x FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP8 = r"""
WITH t AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
g AS (
  SELECT page_id, html, payload_bytes,
         CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS keeper FROM t)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM g
"""

OP12 = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda s, x: list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0],
                                   lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
             4294967295) % 6 AS h
  FROM t),
r AS (
  SELECT c.conv_id, 0 AS own, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL SELECT c.conv_id, 1, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
s AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
         list(sha256(role || chr(10) || text)) OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, k)),
m AS (SELECT conv_id, depth, chars, path FROM s UNION ALL SELECT conv_id, 0, 0, [] FROM c),
e AS (SELECT conv_id, max(depth) AS d FROM m GROUP BY conv_id),
n AS (
  SELECT m.path, m.depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
         sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (e.d = m.depth), '')) AS ends_sha256
  FROM m JOIN e USING (conv_id) GROUP BY m.path, m.depth),
k AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM n LEFT JOIN n p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]),
f AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS (
  SELECT a.path AS path, count(*) FILTER (g.path IS NULL) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
  FROM (SELECT path, depth, saved, unnest(range(0, depth + 1)) AS up FROM n) b
  JOIN n a ON a.depth = b.up AND a.path = b.path[:b.up] LEFT JOIN f g ON g.path = b.path GROUP BY a.path)
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, coalesce(f.n_children, 0) AS n_children, v.n_leaves,
       v.saved_tokens, k.ends_sha256
FROM k JOIN v ON v.path = k.path LEFT JOIN f ON f.path = k.path
"""

ORACLES = {
    "op1_chat_format": OP1,
    "op5_minhash": OP5,
    "op6_decontaminate": OP6,
    "op8_warc": OP8,
    "op12_prefix_trie": OP12,
    "op2_exact_dedup": OP2,
}
