"""DuckDB twins of those queries of this package that SQL can express."""

from __future__ import annotations

REPEATED_LINES = """
WITH docs AS (SELECT doc_id, text FROM documents),
texts AS (SELECT text, min(doc_id) AS first_id FROM docs WHERE text IS NOT NULL GROUP BY text),
raw AS (SELECT text, first_id, unnest(string_split(text, chr(10))) AS line FROM texts),
masked AS (SELECT text, first_id, line, regexp_replace(trim(regexp_replace(line, '[ \\t\\r\\f\\x0b]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS form FROM raw),
lines AS (SELECT DISTINCT text, first_id, form, string_split(form, ' ') AS tokens FROM masked WHERE len(string_split(form, ' ')) >= 3),
leaves AS (SELECT len(tokens) AS n, tokens[1:3] AS lead FROM lines GROUP BY ALL HAVING count(*) >= 5 AND min(form) <> max(form)),
forms AS (SELECT form, tokens, len(tokens) AS n, tokens[1:3] AS lead, count(*) AS w FROM lines GROUP BY ALL),
placed AS (SELECT form, f.n, f.lead, w, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM forms f JOIN leaves l ON f.n = l.n AND f.lead = l.lead),
support AS (SELECT n, lead, pos, token, sum(w) AS s FROM placed GROUP BY ALL),
marked AS (SELECT form, p.pos, p.token <> '<*>' AND (p.pos < 3 OR s >= 5) AS fixed, p.token FROM placed p JOIN support u ON p.n = u.n AND p.lead = u.lead AND p.pos = u.pos AND p.token = u.token),
wider AS (SELECT form, string_agg(CASE WHEN fixed THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS template FROM marked GROUP BY form HAVING avg(CAST(fixed AS INT)) FILTER (pos >= 3) >= 0.7),
of_text AS (SELECT text, first_id, l.form, coalesce(template, l.form) AS template FROM lines l LEFT JOIN wider w ON l.form = w.form),
recurring AS (SELECT template, min(first_id) AS keeper FROM (SELECT DISTINCT text, first_id, template FROM of_text) GROUP BY template HAVING count(*) >= 5),
drops AS (SELECT DISTINCT text, form FROM of_text o JOIN recurring r ON o.template = r.template AND o.first_id <> r.keeper),
numbered AS (SELECT text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM texts),
judged AS (SELECT b.text, line, pos, d.form IS NOT NULL AS dropped FROM
    (SELECT *, regexp_replace(trim(regexp_replace(line, '[ \\t\\r\\f\\x0b]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS form FROM numbered) b
    LEFT JOIN drops d ON b.text = d.text AND b.form = d.form),
result AS (SELECT text, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS kept FROM judged GROUP BY text)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(kept) AS kept_sha256 FROM docs LEFT JOIN result USING (text)
"""

TOP_PRODUCTS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x : CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p : p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

BALANCED_SHARDS = """
WITH RECURSIVE steps(n, k, c) AS (
    SELECT range, 0, CAST(range AS BIGINT) FROM range(256)
    UNION ALL
    SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8),
sized AS (SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS bytes FROM documents),
summed AS (SELECT doc_id, size, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, len(bytes), 2), lambda i : CAST('0x' || substr(bytes, i, 2) AS BIGINT))),
        lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32 FROM sized, tab),
run AS (SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM summed),
cut AS (SELECT *, CAST((2 * upto - size) * 8 // (2 * total) AS INT) AS shard FROM run)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM cut
"""

CHECKS: dict[str, str] = {
    "op3_lines": REPEATED_LINES,
    "op5_topk": TOP_PRODUCTS,
    "op9_shards": BALANCED_SHARDS,
}
