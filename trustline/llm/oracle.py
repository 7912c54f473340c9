"""DuckDB SQL with the same results as the queries that SQL can express."""

from __future__ import annotations

_BENCH_WORDS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, hash(array_to_string(list_slice(w, i, i + 12), ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
),
first AS (SELECT s, min(doc_id) AS first_id FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT doc_id, list_sort(list_distinct(list(k))) AS ks
  FROM (SELECT doc_id, unnest(range(i, i + 13)) AS k FROM win JOIN first USING (s) WHERE first_id < doc_id)
  GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) JOIN gone USING (doc_id)
  WHERE NOT list_contains(ks, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN ks IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS.format(text=_LOWER)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_BENCH_WORDS.format(text=_LOWER)} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
),
hit AS (SELECT p.doc_id, p.i, p.n, x.item FROM pos p JOIN win x ON p.n = x.n AND p.s = x.s),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SAFE = "replace(coalesce({0}, ''), '<|', '<| ')"

OP5 = rf"""
WITH c AS (
  SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn, role, text) AS turns,
    string_agg('<|im_start|>' || {_SAFE.format("role")} || chr(10) || {_SAFE.format("text")} || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text
  FROM conversations GROUP BY conv_id
),
continued AS (SELECT DISTINCT p FROM (SELECT list_slice(turns, 1, unnest(range(1, len(turns)))) AS p FROM c)),
e AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS copies, any_value(text) AS text FROM c GROUP BY turns)
SELECT conv_id, CAST(0 AS INTEGER) AS part, CAST(len(turns) AS BIGINT) AS n_turns, copies, text
FROM e WHERE NOT EXISTS (SELECT 1 FROM continued WHERE p = e.turns)
"""

OP9 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(node, other) AS (SELECT a, b FROM edge UNION SELECT r.node, e.b FROM reach r JOIN edge e ON r.other = e.a),
least_of AS (SELECT node, least(node, min(other)) AS c FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON node = d.doc_id
"""

OP11 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
pos AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT pos.a AS anchor_id, pos.b AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
  s.b AS negative_id, pos.score AS positive_score, s.score AS negative_score
FROM pos JOIN s ON s.a = pos.a AND NOT s.same AND 50 * pos.score <= 100 * s.score AND 100 * s.score <= 95 * pos.score
WINDOW w AS (PARTITION BY pos.a, pos.b ORDER BY s.score DESC, s.b)
QUALIFY row_number() OVER w <= 3
"""

OP12 = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
info AS (
  SELECT n.c, n.n, c - c % 5 AS base, xor(list_reduce(
    [4294967295] || flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: [ascii(d), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, e: CASE WHEN e >= 0 THEN xor(crc, e) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295) % 9 AS h
  FROM n
),
full_info AS (SELECT info.*, least(h, coalesce(b.n, 0)) AS given FROM info LEFT JOIN n b ON b.c = info.base),
rebuilt AS (
  SELECT f.c, t.i, t.r, t.x FROM full_info f JOIN t ON t.c = f.base AND t.i <= f.h
  UNION ALL SELECT f.c, t.i - f.h + f.given, t.r, t.x FROM full_info f JOIN t ON t.c = f.c AND t.i > f.h
),
p AS (SELECT c, i AS d, octet_length(encode(x)) AS bytes, string_agg(md5(r) || md5(x), '') OVER (PARTITION BY c ORDER BY i) AS k FROM rebuilt),
longest AS (SELECT c, max(d) AS d, max_by(k, d) AS k FROM p GROUP BY c),
ends AS (
  SELECT coalesce(k, '') AS k, sha256(string_agg(CAST(n.c AS VARCHAR), ',' ORDER BY n.c)) AS ends FROM n LEFT JOIN longest ON longest.c = n.c GROUP BY 1
),
node AS (
  SELECT '' AS k, 0 AS d, min(c) AS conv_id, count(*) AS n_convs, 0 AS bytes FROM n HAVING count(*) > 0
  UNION ALL SELECT k, d, min(c), count(*), any_value(bytes) FROM p GROUP BY k, d
),
kids AS (SELECT substr(k, 1, 64 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
value AS (SELECT node.k, d, CAST(kids.n IS NULL AS INTEGER) AS leaf, (n_convs - 1) * bytes AS saved FROM node LEFT JOIN kids ON kids.k = node.k),
below AS (SELECT substr(k, 1, 64 * j) AS k, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM value) GROUP BY 1)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(node.n_convs AS BIGINT) AS n_convs,
  CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(below.n_leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
  coalesce(ends.ends, sha256('')) AS ends_sha256
FROM node JOIN below ON below.k = node.k LEFT JOIN kids ON kids.k = node.k LEFT JOIN ends ON ends.k = node.k
  LEFT JOIN node up ON node.d > 0 AND up.k = substr(node.k, 1, 64 * (node.d - 1))
"""

ORACLES = {"op2_substring_dedup": OP2, "op3_decontaminate": OP3, "op5_chat_format": OP5, "op9_minhash_dedup": OP9, "op11_hard_negatives": OP11, "op12_prefix_trie": OP12}
