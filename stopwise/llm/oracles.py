"""DuckDB SQL for the numbered queries that SQL can express."""

CURRICULUM = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
fill(step, words, open_weight) AS (
  SELECT 0, (SELECT sum(source_size) FROM s)::HUGEINT, (SELECT sum(weight) FROM s)::HUGEINT
  UNION ALL
  SELECT step + 1,
    (SELECT sum(source_size)::HUGEINT - coalesce(sum(CASE WHEN weight * f.words > 3 * source_size * f.open_weight THEN 3 * source_size END), 0) FROM s),
    (SELECT coalesce(sum(CASE WHEN NOT weight * f.words > 3 * source_size * f.open_weight THEN weight END), 0) FROM s)::HUGEINT
  FROM fill f WHERE step < 60),
fixed AS (SELECT words, open_weight FROM fill ORDER BY step DESC LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN weight * words > 3 * source_size * open_weight THEN (3 * source_size)::DOUBLE
    ELSE (weight * words)::DOUBLE / greatest(open_weight, 1)::DOUBLE END AS target
  FROM s, fixed),
p AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS wanted,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), size, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, wanted - start)) + greatest(0, least(size, wanted - start - source_size))
   + greatest(0, least(size, wanted - start - 2 * source_size)))::BIGINT AS taken
FROM p
"""

PHRASES = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS words
  FROM b, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS u(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT r, i, n, list_slice(w, i, i + n - 1) AS words FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hits AS (SELECT g.r, g.i, g.n, win.item_id FROM grams g JOIN win ON g.n = win.n AND g.words = win.words),
covered AS (SELECT r, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY r),
named AS (SELECT r, string_agg(x, ',' ORDER BY x) AS items, count(*) AS n_items FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

WARC = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT digest, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN top IS NOT NULL AND (page_id IS NULL OR page_id < top) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top IS NOT NULL AND (page_id IS NULL OR page_id < top) THEN top END AS refers_to
FROM p LEFT JOIN g ON p.digest = g.digest
"""


def cover_lloyd(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain Lloyd on whole numbers, one pair of CTEs per round."""
    sql = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid, vec_id, label, [CAST(floor({scale} * x) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0)""",
           f"""comps AS MATERIALIZED (
  SELECT rid, (i - 1) // (n // {parts}) AS part, (i - 1) % (n // {parts}) AS pos, x
  FROM (SELECT rid, len(v) AS n, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM kept))""",
           f"book0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, x FROM comps WHERE rid <= {entries})"]
    for k in range(rounds + 1):
        sql.append(f"""near{k} AS MATERIALIZED (
  SELECT rid, part, min((e, entry)) AS best FROM (
    SELECT c.rid, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS e FROM comps c JOIN book{k} b USING (part, pos) GROUP BY ALL) GROUP BY ALL)""")
        if k < rounds:
            sql.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT part, entry, pos, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
      SELECT n.part, n.best[2] AS entry, c.pos, sum(c.x) AS s, count(*) AS n FROM near{k} n JOIN comps c USING (rid, part) GROUP BY ALL)) m
  USING (part, entry, pos))""")
    sql.append(f"""coded AS MATERIALIZED (
  SELECT rid, string_agg(printf('%02x', CAST(best[2] AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM near{rounds} GROUP BY rid)""")
    return "WITH " + ",\n".join(sql) + f"""
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM kept k JOIN coded c USING (rid)"""
