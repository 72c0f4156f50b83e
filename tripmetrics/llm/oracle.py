"""DuckDB SQL of the operators that SQL can express, over the raw tables."""

_CRC_BITS = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
_CRC32 = ("xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))), "
          f"lambda c, b: {_CRC_BITS}), 4294967295)")

ORACLE_SQL: dict[str, str] = {
    "op1_warc_index": """
WITH p AS (SELECT page_id, coalesce(html, '') AS p, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
r AS (SELECT *, page_id IS NOT NULL AND strlen(p) >= 100 AND first <> page_id AS again FROM p)
SELECT page_id, CAST(strlen(p) AS BIGINT) AS payload_bytes, sha256(p) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM r""",
    "op7_itq_near_dup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
    AND list_contains(list_transform(embedding, lambda x: x <> 0), true)),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(root.component_id, e.vec_id) AS component_id,
  coalesce(root.component_id = e.vec_id, true) AS kept
FROM embeddings e LEFT JOIN root ON root.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op13_zfast_trie": f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.i <= c.h
  UNION ALL SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, sha256(len(role) || ':' || role || text) AS one FROM r),
k AS (SELECT conv_id, d, length(text) AS chars, sha256(string_agg(one, '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM o),
m AS (SELECT conv_id, d, chars, node, lag(node, 1, 'root') OVER (PARTITION BY conv_id ORDER BY d) AS up, d = max(d) OVER (PARTITION BY conv_id) AS last FROM k
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL, conv_id NOT IN (SELECT conv_id FROM r) FROM c),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, any_value(up) AS up,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM m GROUP BY node, d),
kids AS (SELECT up AS node, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT DISTINCT a.node AS node, b.node AS u FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (SELECT below.node, count(*) FILTER (WHERE kids.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM below JOIN n ON n.node = below.u LEFT JOIN kids ON kids.node = below.u GROUP BY below.node)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(coalesce(kids.n_children, 0) AS BIGINT) AS n_children, CAST(sums.n_leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sums ON sums.node = n.node LEFT JOIN kids ON kids.node = n.node LEFT JOIN n p ON p.node = n.up""",
}
