"""Expected results of the operators that SQL can express, over the plain test tables."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

MIX = f"""
WITH items AS (
  SELECT doc_id, source, size, count(*) AS alike, size * count(*) AS words,
    md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle
  FROM (SELECT doc_id, source, {WORDS} AS size FROM documents) GROUP BY doc_id, source, size),
sums AS (
  SELECT source, CAST(sum(words) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight
  FROM items GROUP BY source),
limits AS (
  SELECT *, 1.5e0 * sum(source_size) OVER () AS budget, 2 * source_size AS cap FROM sums),
levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER fills, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER fills, 0)) AS level
  FROM limits WINDOW fills AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, budget, CAST(CASE WHEN level * weight > cap THEN cap
    ELSE max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight END AS DOUBLE) AS target
  FROM levels),
queued AS (
  SELECT *, CAST(sum(words) OVER (PARTITION BY source ORDER BY shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM items),
entries AS (
  SELECT q.*, e.epoch, t.source_size, t.target, t.budget,
    CASE WHEN t.target > 0 THEN (e.epoch * t.source_size + q.upto) / t.target ELSE 0e0 END AS finish
  FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source
  JOIN (VALUES (0), (1)) e(epoch) ON q.size > 0 OR e.epoch = 0),
placed AS (
  SELECT *, sum(words) OVER (ORDER BY finish, source NULLS FIRST, epoch, shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) AS place
  FROM entries),
fitting AS (
  SELECT *, CASE WHEN size > 0 THEN greatest(0, least(alike, floor((budget - (place - words)) / nullif(size, 0))))
    WHEN place <= budget THEN alike ELSE 0 END AS copies
  FROM placed)
SELECT doc_id, size, source_size, target,
  CAST(sum(CASE WHEN copy <= copies THEN size ELSE 0 END) AS BIGINT) AS taken, source
FROM fitting, unnest(range(1, alike + 1)) AS t(copy) GROUP BY doc_id, source, size, source_size, target, copy
"""

WARC = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

def _assigned(k: int) -> str:
    """Each part's nearest entry of codebook ``k``."""
    return f"""
near{k} AS MATERIALIZED (
  SELECT i, p, any_value(v) AS v, min({{'d': far, 'e': e}}) AS best
  FROM (SELECT r.i, r.p, r.v, b.e, list_dot_product(r.v, r.v) - 2 * list_dot_product(r.v, b.c) + list_dot_product(b.c, b.c) AS far
    FROM parts r JOIN book{k} b USING (p))
  GROUP BY i, p),"""


def _learned(k: int) -> str:
    """Codebook ``k + 1``."""
    return f"""{_assigned(k)}
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY j) AS c FROM (
      SELECT p, best.e AS e, j, floor(sum(v[j]) / count(*)) AS mean FROM near{k}, size, unnest(range(1, w + 1)) AS t(j)
      GROUP BY p, best.e, j)
    GROUP BY p, e) m USING (p, e)),"""


CODES = f"""
WITH usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT max(len(v)) // 4 AS w FROM usable),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS i FROM usable),
parts AS MATERIALIZED (
  SELECT i, p, v[p * w + 1 : (p + 1) * w] AS v FROM numbered, size, unnest(range(4)) AS t(p)),
book0 AS MATERIALIZED (SELECT p, i - 1 AS e, v AS c FROM parts WHERE i <= 256),{"".join(_learned(k) for k in range(4))}{_assigned(4)}
coded AS (
  SELECT i, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near4 GROUP BY i),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(c[j] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256
  FROM book4, size, unnest(range(1, w + 1)) AS t(j))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM numbered JOIN coded USING (i), digest
"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
digits AS (
  SELECT conv_id, [4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)) AS bytes
  FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (
  SELECT conv_id, xor(4294967295, list_reduce(bytes, lambda crc, b: list_reduce([xor(crc, b)] || range(8),
    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 4 AS h FROM digits),
rebuilt AS (
  SELECT c.conv_id, t.place, 0 AS own, t.role, t.text
  FROM heads c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, t.place, 1, t.role, t.text FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
steps AS (
  SELECT conv_id, text, row_number() OVER w AS depth,
    string_agg(sha256(len(role) || ':' || role || text), '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, place ROWS UNBOUNDED PRECEDING)),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS words FROM heads
  UNION ALL
  SELECT conv_id, depth, path, {WORDS} FROM steps),
members AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM paths),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM members GROUP BY depth, path),
below AS (
  SELECT a.depth, a.path, n.depth AS deep, n.n_convs, n.words, NOT EXISTS (
    SELECT 1 FROM nodes c WHERE c.depth = n.depth + 1 AND left(c.path, 64 * n.depth) = n.path) AS leaf
  FROM nodes n JOIN nodes a ON a.depth <= n.depth AND a.path = left(n.path, 64 * a.depth)),
sums AS (
  SELECT depth, path, count(*) FILTER (WHERE deep = depth + 1) AS n_children, count(*) FILTER (WHERE leaf) AS n_leaves,
    CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM below GROUP BY depth, path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
  s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (depth, path)
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = left(n.path, 64 * (n.depth - 1))
"""

SQL = {
    "op1_source_mix": MIX,
    "op9_warc_bundles": WARC,
    "op11_anchor_codes": CODES,
    "op13_prefix_trie": TRIE,
}
