"""DuckDB SQL with the same rows as the queries that SQL can express."""

JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
  FROM words
), shingles AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
    FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
  ) p JOIN sets u ON u.doc_id = p.a JOIN sets v ON v.doc_id = p.b
  WHERE 100 * p.both >= 80 * (len(u.s) + len(v.s) - p.both)
), reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT s.doc_id, len(s.s) AS n_shingles,
       least(s.doc_id, coalesce((SELECT min(other) FROM reach r WHERE r.doc_id = s.doc_id), s.doc_id)) AS component_id
FROM sets s
"""

EMBEDDINGS = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), vectors AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM usable WHERE list_dot_product(e, e) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98
), reach AS (
  SELECT a AS vec_id, b AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), found AS (
  SELECT vec_id, min(other) AS least FROM reach GROUP BY vec_id
), counted AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(f.least, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(f.least, v.vec_id) AS kept
FROM embeddings v LEFT JOIN found f USING (vec_id) LEFT JOIN counted c USING (vec_id)
"""

URL_FILTER = r"""
WITH captures AS (
  SELECT page_id, 1700000000 + (page_id * 977) % (90 * 86400) AS t,
         nullif(regexp_replace(regexp_extract(lower(url), '^https?://(?:[^/?#]*@)?([^/?#:@]+)', 1), '\.+$', ''), '') AS host,
         regexp_extract(url, '^[a-zA-Z]+://[^/?#]+/([^/?#]*)', 1) AS segment,
         string_split(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+/([^?#]*)', 1), '/') AS path
  FROM pages
), hosts AS (
  SELECT DISTINCT host, segment FROM captures WHERE host IS NOT NULL
), candidates AS (
  SELECT DISTINCT 'abuse' AS list, 'block' AS kind, host AS pattern, 2 AS one_in FROM hosts
  UNION SELECT DISTINCT 'adult', 'block', host || '/' || segment, 4 FROM hosts WHERE segment <> ''
  UNION SELECT DISTINCT 'parked', 'block', regexp_extract(host, '([^.]+\.[^.]+)$', 1), 3 FROM hosts
  UNION SELECT DISTINCT 'trusted', 'allow', host, 8 FROM hosts
), chosen AS (
  SELECT list, kind, pattern,
         1700000000 + ('0x' || substr(md5(pattern || list || 'from'), 1, 7))::BIGINT % 60 * 86400 AS first_at,
         (('0x' || substr(md5(pattern || list || 'for'), 1, 7))::BIGINT % 40 + 1) * 86400 AS stay
  FROM candidates WHERE ('0x' || substr(md5(pattern || list), 1, 7))::BIGINT % one_in = 0
), domains AS (
  SELECT page_id, t, path, unnest([array_to_string(l[k:], '.') FOR k IN range(1, greatest(2, len(l)))]) AS d
  FROM (SELECT *, string_split(host, '.') AS l FROM captures WHERE host IS NOT NULL)
), asked AS (
  SELECT page_id, t, d AS pattern FROM domains
  UNION ALL SELECT page_id, t, d || '/' || array_to_string(path[1:k], '/')
  FROM (SELECT page_id, t, d, path, unnest(range(1, len(path) + 1)) AS k FROM domains) WHERE path[k] <> ''
), hits AS (
  SELECT a.page_id, c.list, c.kind, length(c.pattern) AS n
  FROM asked a JOIN chosen c USING (pattern)
  WHERE (a.t >= c.first_at AND a.t < c.first_at + c.stay) OR a.t >= c.first_at + 2 * c.stay
), found AS (
  SELECT page_id, max(n) FILTER (kind = 'block') AS b, max(n) FILTER (kind = 'allow') AS w,
         coalesce(string_agg(DISTINCT list, ',' ORDER BY list) FILTER (kind = 'block'), '') AS blocked_by,
         coalesce(string_agg(DISTINCT list, ',' ORDER BY list) FILTER (kind = 'allow'), '') AS allowed_by
  FROM hits GROUP BY page_id
)
SELECT c.page_id, c.t AS fetched, f.b IS NOT NULL AND (f.w IS NULL OR f.w < f.b) AS blocked,
       coalesce(f.blocked_by, '') AS blocked_by, coalesce(f.allowed_by, '') AS allowed_by
FROM captures c LEFT JOIN found f USING (page_id)
"""

LINE_TEMPLATES = r"""
WITH lines AS (
  SELECT doc_id, l.i AS line_no, l.x AS line
  FROM (SELECT doc_id, unnest(list_zip(range(len(string_split(text, chr(10)))), string_split(text, chr(10)))) AS z
        FROM documents WHERE doc_id IS NOT NULL AND length(text) > 0) s, LATERAL (SELECT z[1] AS i, z[2] AS x) l
), masked AS (
  SELECT doc_id, line_no, regexp_extract_all(line, '[^ \t\n\x0B\f\r]+') AS raw,
         regexp_extract_all(regexp_replace(line, '[^ \t\n\x0B\f\r]*[0-9][^ \t\n\x0B\f\r]*', '<*>', 'g'), '[^ \t\n\x0B\f\r]+') AS m
  FROM lines
), parsed AS (
  SELECT doc_id, line_no, len(m) AS n, (len(m) - 3) // 2 AS h,
         CASE WHEN 2 * len([x FOR x IN m IF x <> '<*>']) >= len(m) THEN m ELSE raw END AS t
  FROM masked WHERE len(m) >= 1
), templates AS (
  SELECT doc_id, line_no, 0 AS kind, n, t AS k FROM parsed WHERE n < 12
  UNION ALL SELECT doc_id, line_no, 1, n, t[1:3 + h] FROM parsed WHERE n >= 12
  UNION ALL SELECT doc_id, line_no, 2, n, list_concat(t[1:3], t[3 + h + 1:]) FROM parsed WHERE n >= 12
), firsts AS (
  SELECT kind, n, k, min(doc_id) AS first FROM templates GROUP BY ALL HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT t.doc_id, t.line_no FROM templates t JOIN firsts f
    ON t.kind = f.kind AND t.n = f.n AND t.k = f.k WHERE t.doc_id > f.first
), numbers AS (
  SELECT doc_id, list(line_no) AS dropped FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN length(d.text) > 0 THEN len(string_split(d.text, chr(10))) ELSE 0 END AS n_lines,
       coalesce(len(g.dropped), 0) AS n_dropped,
       CASE WHEN g.dropped IS NULL THEN d.text ELSE array_to_string(
         [z[2] FOR z IN list_zip(range(len(string_split(d.text, chr(10)))), string_split(d.text, chr(10)))
          IF NOT list_contains(g.dropped, z[1])], chr(10)) END AS text
FROM documents d LEFT JOIN numbers g USING (doc_id)
"""

FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), masks AS (
  SELECT doc_id, part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x))::INT
         + 8 * regexp_matches(x, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS mask
  FROM words
), known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM masks LEFT JOIN known USING (doc_id) GROUP BY part, mask
), filters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM filters a, filters b, filters c, filters d, filters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT o, k, 1 << (ascii(o[k]) - 65) AS bit, list_sum([1 << (ascii(o[j]) - 65) FOR j IN range(1, k)]) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS k)
), audit AS (
  SELECT part, o, k, bit, sum(CASE WHEN mask & (bit | coalesce(earlier, 0)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit > 0 AND mask & coalesce(earlier, 0) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit > 0 AND mask & coalesce(earlier, 0) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit > 0 AND mask & coalesce(earlier, 0) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit > 0 AND mask & coalesce(earlier, 0) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, o, k, bit
)
SELECT part, o AS filter_order, k::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM audit
"""
