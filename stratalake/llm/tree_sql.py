"""SQL statements of the manifest and of the prefix trie."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text of ASCII letters in DuckDB, bit by bit."""
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    letters = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, b: {byte}), 4294967295::BIGINT)"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


MERKLE_SQL = f"""
WITH RECURSIVE l AS (
  SELECT row_number() OVER () AS r, doc_id, lang,
    sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} || {_field('text')}) AS leaf,
    CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} ||
      {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS other
  FROM documents),
p AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (SELECT g, 0 AS level, pos, n, leaf AS h FROM p
      UNION ALL SELECT g, any_value(level) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY g, pos // 8),
u AS (SELECT 0 AS level, g AS pos, (SELECT count(DISTINCT g) FROM p) AS n, h FROM t WHERE n = 1
      UNION ALL SELECT any_value(level) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY pos // 8),
nodes AS (SELECT g, level, pos, n, h, level AS below FROM t UNION ALL SELECT -1, level, pos, n, h, 100 + level FROM u),
w AS (SELECT r, g, g AS own, 0 AS level, pos, n, coalesce(other, leaf) AS h, '' AS proof FROM p
      UNION ALL
      SELECT w.r, CASE WHEN w.n = 1 THEN -1 ELSE w.g END, w.own, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
        CASE WHEN w.n = 1 THEN w.own ELSE w.pos // 8 END,
        CASE WHEN w.n = 1 THEN (SELECT count(DISTINCT g) FROM p) ELSE (w.n + 7) // 8 END,
        CASE WHEN w.n = 1 THEN w.h ELSE sha256(coalesce(s.before, '') || w.h || coalesce(s.behind, '')) END,
        CASE WHEN w.n = 1 THEN w.proof ELSE w.proof || coalesce(s.before, '') || coalesce(s.behind, '') END
      FROM w LEFT JOIN (SELECT a.g, a.level, a.pos, string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos) AS before, string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos) AS behind
                        FROM nodes a JOIN nodes b ON a.g = b.g AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.g, a.level, a.pos) s
        ON s.g = w.g AND s.level = w.level AND s.pos = w.pos
      WHERE NOT (w.g = -1 AND w.n = 1))
SELECT p.doc_id, p.leaf, t.h AS subroot, u.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = u.h AS verified
FROM p JOIN t ON t.g = p.g AND t.n = 1 JOIN u ON u.n = 1 JOIN w ON w.r = p.r AND w.g = -1 AND w.n = 1
"""


TRIE_SQL = f"""
WITH own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, {crc32_sql('conv_id::VARCHAR')} % 6 AS h FROM own),
r AS (SELECT a.conv_id, list_concat(list_slice(coalesce(b.t, []), 1, a.h), list_slice(a.t, a.h + 1, len(a.t))) AS t FROM h a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
p AS (SELECT conv_id, d, len(t) AS n, list_slice(t, 1, d) AS k, t[d].text AS last FROM r, unnest(range(0, len(t) + 1)) AS u(d)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(any_value(last)), 0) AS saved,
        string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d) AS ends FROM p GROUP BY k, d),
c AS (SELECT list_slice(k, 1, d - 1) AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
l AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (k, d)),
s AS (SELECT list_slice(l.k, 1, u.d) AS k, u.d, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS n_leaves FROM l, unnest(range(0, l.d + 1)) AS u(d) GROUP BY ALL)
SELECT l.conv_id, l.d AS depth, up.conv_id AS parent_conv_id, l.n_convs, l.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(l.ends, '')) AS ends_sha256
FROM l JOIN s ON s.k = l.k AND s.d = l.d LEFT JOIN n up ON l.d > 0 AND up.d = l.d - 1 AND up.k = list_slice(l.k, 1, l.d - 1)
"""
