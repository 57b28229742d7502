"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


#: Smallest node reachable over the links (a, b) of a CTE named links, for every node of a CTE named nodes (id).
_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT id, id AS other FROM nodes UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
components AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

OP3 = f"""
WITH RECURSIVE
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
good AS (SELECT vec_id, label, x FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
         AND len(list_filter(x, lambda e: e <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x)
          AND list_cosine_similarity(p.x, q.x) >= 0.93),
nodes AS (SELECT vec_id AS id FROM v),{_COMPONENTS}
SELECT c.id AS vec_id, (SELECT count(*) FROM both_ways WHERE a = c.id) AS n_links, c.component_id, c.id = c.component_id AS kept FROM components c
"""

OP7 = f"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(string_split_regex({_lower('text')}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS shingles FROM w),
sizes AS (SELECT doc_id, len(shingles) AS n FROM s),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM e p JOIN e q ON p.shingle = q.shingle AND p.doc_id < q.doc_id GROUP BY ALL),
links AS (SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
nodes AS (SELECT doc_id AS id FROM sizes),{_COMPONENTS}
SELECT s.doc_id, s.n AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM sizes s JOIN components c ON c.id = s.doc_id
"""

OP9 = f"""
WITH rules(rule, host, path, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
p AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, {_lower("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS r FROM p),
fits AS (SELECT h.r, arg_max(rules.rule, length(rules.rule)) AS rule, arg_max(rules.verdict, length(rules.rule)) AS verdict
         FROM h JOIN rules ON (h.host = rules.host OR ends_with(h.host, '.' || rules.host)) AND starts_with(h.path, rules.path) GROUP BY h.r)
SELECT h.page_id, h.host, h.path, fits.rule, coalesce(fits.verdict, 'allow') AS verdict FROM h LEFT JOIN fits ON fits.r = h.r
"""

_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_lower('text'))} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS.format(_lower('text'))} AS ws FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, unnest(list_transform(range(1, greatest(len(ws) - 12, 1) + 1),
            lambda k: array_to_string(ws[k:k + least(len(ws), 13) - 1], ' '))) AS words FROM i WHERE len(ws) > 0),
places AS (SELECT d.r, s.n, unnest(range(1, len(d.ws) - s.n + 2)) AS k, d.ws FROM d JOIN (SELECT DISTINCT n FROM windows) s ON len(d.ws) >= s.n),
hits AS (SELECT p.r, p.k, p.n, w.item_id FROM places p JOIN windows w ON w.n = p.n AND w.words = array_to_string(p.ws[p.k:p.k + p.n - 1], ' ')),
covered AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS word FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN covered c ON c.r = d.r LEFT JOIN found f ON f.r = d.r
"""

#: crc32 by its table (made from the polynomial in eight steps), prefixes as digests of lists of turns.
OP12 = """
WITH RECURSIVE
steps AS (
  SELECT i AS byte, i::BIGINT AS r, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, step + 1 FROM steps WHERE step < 8),
crc_table AS (SELECT list(r ORDER BY byte) AS entries FROM steps WHERE step = 8),
ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, c::VARCHAR AS s, 4294967295::BIGINT AS r, 0 AS i FROM ids
  UNION ALL
  SELECT c, s, xor(r >> 8, entries[(xor(r, ascii(s[i + 1])::BIGINT) & 255) + 1]), i + 1 FROM crc, crc_table WHERE i < length(s)),
heads AS (SELECT c, xor(r, 4294967295) % 9 AS h, c - c % 5 AS base FROM crc WHERE i = length(s)),
turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
joined AS (
  SELECT h.c, 0 AS part, t.pos, t.role, t.text FROM heads h JOIN turns t ON t.c = h.base AND t.pos <= h.h
  UNION ALL
  SELECT h.c, 1, t.pos, t.role, t.text FROM heads h JOIN turns t ON t.c = h.c AND t.pos > h.h),
rebuilt AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM joined),
whole AS (SELECT h.c, count(d) AS n, list({'role': role, 'text': text} ORDER BY d) FILTER (WHERE d IS NOT NULL) AS seq
          FROM heads h LEFT JOIN rebuilt r ON r.c = h.c GROUP BY h.c),
members AS (
  SELECT c, d, n, md5(CASE WHEN d = 0 THEN '' ELSE seq[1:d]::JSON::VARCHAR END) AS node,
         CASE WHEN d > 0 THEN md5(CASE WHEN d = 1 THEN '' ELSE seq[1:d - 1]::JSON::VARCHAR END) END AS parent,
         CASE WHEN d > 0 THEN strlen(seq[d].text) ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(n + 1)) AS d FROM whole)),
nodes AS (
  SELECT d, node, min(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saves,
         string_agg(CASE WHEN d = n THEN c::VARCHAR END, ',' ORDER BY c) AS ends
  FROM members GROUP BY d, node),
counted AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n
  LEFT JOIN (SELECT d - 1 AS d, parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL) k USING (d, node)),
below AS (
  SELECT m.d, m.node, sum(u.saves) AS saved, count(*) FILTER (WHERE u.n_children = 0) AS leaves
  FROM counted u JOIN members m ON m.c = u.conv_id AND m.d <= u.d GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM counted n JOIN below b USING (d, node) LEFT JOIN counted p ON p.d = n.d - 1 AND p.node = n.parent
"""
