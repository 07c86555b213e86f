"""DuckDB SQL of the corpus queries that SQL can express.

The others are tested against brute-force versions: their results rest on hashes, a fitted model, HTML trees or a
tokenizer, which DuckDB does not have.
"""

from __future__ import annotations

OP5 = r"""
WITH lists AS (
  SELECT 'doc' AS side, row_number() OVER () AS r, doc_id AS id,
         regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 'item', row_number() OVER (), item_id,
         regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
short AS (SELECT DISTINCT len(ws) AS k FROM lists WHERE side = 'item' AND len(ws) BETWEEN 1 AND 4),
shingles AS (
  SELECT DISTINCT side, r, id, unnest(
    CASE WHEN len(ws) < 5 THEN [] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s
  FROM lists
  UNION
  SELECT side, r, id, unnest(list_transform(range(1, CAST(len(ws) - k + 2 AS BIGINT)), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS s
  FROM lists JOIN short ON len(ws) = k OR (side = 'doc' AND len(ws) > k)
),
sizes AS (SELECT r, count(*) AS n FROM shingles WHERE side = 'item' GROUP BY r),
common AS (
  SELECT d.r AS dr, i.r AS ir, any_value(d.id) AS doc_id, any_value(i.id) AS item_id, count(*) AS c
  FROM shingles d JOIN shingles i ON d.s = i.s WHERE d.side = 'doc' AND i.side = 'item' GROUP BY 1, 2
)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_shingles, CAST(c AS INTEGER) AS n_common, c / n AS containment
FROM common JOIN sizes ON ir = r WHERE 100 * c >= 80 * n
"""

OP10 = r"""
WITH RECURSIVE lists AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
shingles AS (
  SELECT DISTINCT r, unnest(
    CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS s
  FROM lists
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= 85 * (p.n + q.n - c)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT r, r AS other FROM lists UNION SELECT reached.r, y FROM reached JOIN both_ways ON other = x)
SELECT l.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM lists l JOIN reached ON l.r = reached.r JOIN lists o ON o.r = other LEFT JOIN sizes ON sizes.r = l.r
GROUP BY l.r, l.doc_id
"""


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The codebooks of every round are common table expressions of their own."""
    steps = [
        f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""",
        f"""
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v FROM kept, range({parts}) t(p)
)""",
        f"""
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {entries})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""
near{i} AS MATERIALIZED (
  SELECT r, a.p AS p, any_value(a.v) AS v, min({{'d': CAST(list_sum(list_transform(
    list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'e': e}}) AS best
  FROM parts a JOIN book{i} b ON a.p = b.p GROUP BY ALL
)"""
        )
        if i < rounds:
            steps.append(
                f"""
book{i + 1} AS MATERIALIZED (
  WITH single AS (SELECT p, best.e AS e, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM near{i}),
  means AS (SELECT p, e, k, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
            FROM single GROUP BY ALL),
  moved AS (SELECT p, e, list(x ORDER BY k) AS v FROM means GROUP BY ALL)
  SELECT b.p AS p, b.e AS e, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN moved m ON m.p = b.p AND m.e = b.e
)"""
            )
    return (
        "WITH "
        + ",".join(steps)
        + f""",
codes AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d) AS error FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN codes USING (r)
"""
    )


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": OP5, "op10_ngram_join": OP10, "op13_vector_codes": _op13()}
