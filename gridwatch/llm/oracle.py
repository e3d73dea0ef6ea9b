"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: White space that is stripped and that separates words.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
j AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

#: Jump consistent hashing by 128-bit integers; the same walk gives the shard among 24 and among 25.
SHARDS = """
WITH RECURSIVE jump(doc_id, k, b, j, now, grown) AS (
  SELECT doc_id, CAST(doc_id AS HUGEINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, n, j, CAST(floor(CAST(j + 1 AS DOUBLE) * (2147483648.0 / (CAST(n // 8589934592 AS DOUBLE) + 1))) AS BIGINT),
         CASE WHEN j < 24 THEN j ELSE now END, j
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS n FROM jump WHERE j < 25)
),
s AS (SELECT doc_id, now, grown FROM jump WHERE j >= 25),
bits AS (SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: xor(a >> 1, (a & 1) * 3988292384)) AS v FROM range(256) t(i)),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits),
c AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
        xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
            lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INT) + 1]))) AS text_crc32
      FROM documents, tab)
SELECT c.doc_id, size, text_crc32, 'key' AS law, CAST(now AS INT) AS shard,
       row_number() OVER (PARTITION BY now ORDER BY (c.doc_id % 2147483647 + 2147483647) % 2147483647 * 48271 % 2147483647, c.doc_id, size, text_crc32) - 1 AS slot, CAST(grown AS INT) AS grown_shard
FROM c JOIN s USING (doc_id)
"""

NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^{SPACE}]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(m.b, n.doc_id)) AS component_id, n.doc_id = least(n.doc_id, coalesce(m.b, n.doc_id)) AS kept
FROM n LEFT JOIN m ON m.a = n.doc_id
"""

LEAKS = rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[{SPACE}]+'), lambda x: x <> '') AS ws FROM documents),
d AS (SELECT doc_id, list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) AS h FROM w WHERE len(ws) >= 5),
v AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[{SPACE}]+'), lambda x: x <> '') AS ws FROM benchmark),
b AS (SELECT item_id, list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) AS h, len(ws) - 4 AS n FROM v WHERE len(ws) >= 5),
p AS (SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, unnest(h) AS g FROM d) JOIN (SELECT item_id, unnest(h) AS g FROM b) USING (g)),
c AS (SELECT doc_id, item_id, b.h AS bh, least(n, len(d.h)) AS size, unnest(range(0, len(d.h) - least(n, len(d.h)) + 1)) AS start, d.h AS dh
      FROM p JOIN d USING (doc_id) JOIN b USING (item_id)),
x AS (SELECT doc_id, item_id, size, start, bh, dh[start + 1 : start + size] AS win FROM c),
s AS (SELECT doc_id, item_id, size, start, len(bh) + len(win) AS united,
             coalesce(list_sum(list_transform(list_distinct(win), lambda e: least(len(list_filter(win, lambda y: y = e)), len(list_filter(bh, lambda y: y = e))))), 0) AS shared FROM x),
r AS (SELECT *, CAST(shared AS DOUBLE) / (united - shared) AS similarity FROM s)
SELECT doc_id, item_id, CAST(arg_max(start, [similarity, -start]) AS INT) AS start, CAST(any_value(size) + 4 AS INT) AS n_words, max(similarity) AS similarity
FROM r WHERE similarity >= 0.75 GROUP BY doc_id, item_id
"""

NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
a AS (SELECT vec_id AS anchor_id, label, q FROM v WHERE vec_id % 100 = 0),
s AS (SELECT anchor_id, v.vec_id, v.label = a.label AS same, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score FROM a JOIN v ON v.vec_id <> anchor_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

#: What a term is made of.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS ts FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
z AS (SELECT count(*) AS nn, sum(n) AS ll FROM s),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM s) SEMI JOIN i USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, z GROUP BY term, nn),
e AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))) AS share FROM p JOIN w USING (term), z),
r AS (SELECT item_id, doc_id, CAST(sum(share) AS BIGINT) AS score FROM i JOIN e USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY rank <= 50
"""

ORACLE_SQL: dict[str, str] = {"op3_leaks": LEAKS, "op6_near_duplicates": NEAR, "op9_line_dedup": LINES, "op5_shards": SHARDS, "op11_hard_negatives": NEGATIVES, "op12_ranked_search": RANKED}
