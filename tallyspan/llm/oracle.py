"""The longer SQL texts of this subpackage, written independently of the Spark code."""

from __future__ import annotations

MIDDLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""

LINE_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
s AS (SELECT key, max(doc_id) AS stays FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (stays IS NOT NULL AND doc_id <> stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays IS NULL OR doc_id = stays), '')) AS kept_sha256
FROM k LEFT JOIN s USING (key) GROUP BY doc_id
"""

# The rebuilt turns are spelled out as lists of turns, and a subtree is summed over all ancestors of each node.
# crc32 is made from its table of 256 remainders.
TRIE_SQL = """
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
hs AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
   lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h FROM ids, tab),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
m AS (
  SELECT hs.conv_id, p AS d, role, text FROM hs JOIN t ON t.conv_id = hs.conv_id - hs.conv_id % 5 AND p <= h
  UNION ALL
  SELECT conv_id, least(h, (SELECT count(*) FROM t b WHERE b.conv_id = hs.conv_id - hs.conv_id % 5)) + p - h, role, text
  FROM hs JOIN t USING (conv_id) WHERE p > h),
pre AS (SELECT conv_id, d, strlen(text) AS bytes,
  list(length(role) || ':' || length(text) || ':' || role || text) OVER (PARTITION BY conv_id ORDER BY d) AS path FROM m
  UNION ALL SELECT conv_id, 0, 0, [] FROM ids),
w AS (SELECT conv_id, d, bytes, min(conv_id) OVER (PARTITION BY d, path) AS face, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM pre),
n AS (SELECT face, d, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM w GROUP BY face, d),
par AS (SELECT n.*, up.face AS parent FROM n LEFT JOIN w up ON up.conv_id = n.face AND up.d = n.d - 1),
kid AS (SELECT parent AS face, d - 1 AS d, count(*) AS n_children FROM par WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT par.*, coalesce(n_children, 0) AS n_children FROM par LEFT JOIN kid USING (face, d)),
sub AS (SELECT up.face, up.d, sum(CAST(v.n_children = 0 AS BIGINT)) AS n_leaves, sum(v.saved) AS saved_tokens
  FROM v JOIN w up ON up.conv_id = v.face AND up.d <= v.d GROUP BY 1, 2)
SELECT face AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM v JOIN sub USING (face, d)
"""

# Shingles are compared as text, and components found by a recursive walk over the links.
NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON x = other
)
SELECT reach.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id
"""

# Every window of every item is looked up at every place of every document.
HITS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS size, array_to_string(ws[k:k + 12], ' ') AS s
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS k FROM i WHERE len(ws) > 0)
), places AS (
  SELECT doc_id, size, k, array_to_string(ws[k:k + size - 1], ' ') AS s
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM windows))
), hits AS (SELECT doc_id, item_id, size, k FROM places JOIN windows USING (size, s)
), words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS pos FROM (SELECT DISTINCT doc_id, size, k FROM hits)) GROUP BY doc_id
), items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Base 32 by bit arithmetic on five hex digits at a time.
ARCHIVE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS x FROM pages),
d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY x) AS top,
    array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (k // 4) AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""

# Every string of 400 bytes is counted, and every byte looks back for the start of a repeated one.
REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
starts AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 800)) AS s FROM (SELECT doc_id, x, unnest(range(0, n - 399)) AS p FROM d WHERE n >= 400)),
found AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS c FROM starts) WHERE c > 1),
bytes AS (
  SELECT b.doc_id, b.p, b.h, max(found.p) OVER (PARTITION BY b.doc_id ORDER BY b.p ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM (SELECT doc_id, p, substr(x, 2 * p + 1, 2) AS h FROM (SELECT doc_id, x, unnest(range(0, n)) AS p FROM d WHERE doc_id IN (SELECT doc_id FROM found))) b
  LEFT JOIN found ON found.doc_id = b.doc_id AND found.p = b.p
),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM bytes),
cut AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
    coalesce(string_agg(h, '' ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM runs GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256, n - coalesce(n_removed, 0) AS kept_bytes
FROM d LEFT JOIN cut USING (doc_id)
"""
