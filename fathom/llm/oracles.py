"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP2 = """
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule, CASE
    WHEN contains(host || path, '/ads/') THEN 'ads'
    WHEN regexp_matches(host || path, '(^|\\.)adserver\\.') THEN 'adserver'
    WHEN contains(host || path, '/banners/') THEN 'banners'
    WHEN contains(host || path, '/cgi-bin/') THEN 'cgi'
    WHEN regexp_matches(host || path, '/login(/|\\z)') THEN 'login'
    WHEN regexp_matches(host || path, '/logout(/|\\z)') THEN 'logout'
    WHEN contains(host || path, '/wp-admin/') THEN 'wp-admin'
    WHEN contains(host || path, '/wp-login.php') THEN 'wp-login'
  END AS pat
  FROM u
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN pat IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN pat END AS pattern
FROM r
"""

OP10 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT h, min(page_id) AS first, count(*) AS n FROM p GROUP BY h
)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(p.h, CAST(i // 4 * 5 + 1 AS INTEGER), 5))::BIGINT
                  >> (5 * (3 - i % 4))::BIGINT) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""


OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * d.x[i])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id AND len(q.x) = len(d.x)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9
), reach AS (
  SELECT a AS origin, b AS met FROM l UNION SELECT reach.origin, l.b FROM reach JOIN l ON reach.met = l.a
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a
), c AS (
  SELECT origin AS vec_id, min(met) AS first FROM reach GROUP BY origin
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(first, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(first, vec_id)) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""


OP7 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x
  FROM w
), n AS (
  SELECT doc_id, CAST(len(x) AS BIGINT) AS n_shingles FROM s
), e AS (
  SELECT doc_id, unnest(x) AS g FROM s
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * k >= 85 * (p.n_shingles + q.n_shingles - k)
), reach AS (
  SELECT a AS origin, b AS met FROM l UNION SELECT reach.origin, l.b FROM reach JOIN l ON reach.met = l.a
), f AS (
  SELECT origin AS doc_id, min(met) AS first FROM reach GROUP BY origin
)
SELECT doc_id, n_shingles, least(doc_id, coalesce(first, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(first, doc_id)) AS kept
FROM n LEFT JOIN f USING (doc_id)
"""


OP12 = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d
), n AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, phrase, any_value(k) AS k, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY lang, phrase HAVING count(*) >= 30
), c AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS i FROM f WHERE k > 1
), s AS (
  SELECT c.lang, c.phrase, a, i, x.f AS l, y.f AS r,
         CAST((2000000::HUGEINT * a) // (x.f::HUGEINT + y.f::HUGEINT) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:i], ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[i + 1:len(w)], ' ')
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), o AS (
  SELECT b.* FROM b
  WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = b.lang AND f.k > len(string_split(b.phrase, ' '))
      AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ') AND 100::HUGEINT * f.f >= 80::HUGEINT * b.a)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM o
)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), w AS (
  SELECT id, lang, source, unnest(w) AS term FROM d
), v AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN (SELECT lang, term FROM v) USING (lang, term) GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), k AS (
  SELECT lang, count(*) AS kept, sum(n) AS total FROM v GROUP BY lang
), o AS (
  SELECT lang, source, sum(n) AS own FROM c GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(o.own, 0)::HUGEINT + 2 * k.kept) AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (v.n + 2)) // (k.total::HUGEINT + 2 * k.kept) AS BIGINT) AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN o USING (lang, source)
), a AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item,
         CAST(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS BIGINT) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  UNION ALL
  SELECT x.lang, x.source, 'pair', y.source, 0 FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  WHERE x.lang NOT IN (SELECT lang FROM k)
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM a
)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filters": OP2, "op3_topk": OP3, "op6_caps": OP6, "op7_minhash": OP7, "op10_warc": OP10, "op12_collocations": OP12, "op13_divergence": OP13}
