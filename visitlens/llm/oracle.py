"""DuckDB statements for the operators that SQL can express."""

OP1 = r"""
WITH bench AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
phrase AS (
  SELECT DISTINCT item_id, len(p) AS n, array_to_string(p, ' ') AS p FROM (
    SELECT item_id, unnest(CASE WHEN len(w) <= 10 THEN [w]
        ELSE [w[i:i + 9] FOR i IN range(1, len(w) - 8)] END) AS p
    FROM bench WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM phrase),
doc AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
place AS (
  SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, sizes WHERE len(w) >= n),
occ AS (
  SELECT place.rid, place.i, phrase.n, phrase.item_id
  FROM place JOIN phrase ON phrase.n = place.n
   AND phrase.p = array_to_string(place.w[place.i:place.i + place.n - 1], ' ')),
hits AS (
  SELECT rid, count(*) AS n_hit FROM (
    SELECT DISTINCT rid, unnest(range(i, i + n)) AS k FROM occ) GROUP BY rid),
items AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids
  FROM occ GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

OP3 = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
place AS (SELECT rid, unnest(range(1, len(w) - 33)) AS i, w FROM doc WHERE len(w) >= 35),
win AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM place),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 35)) AS k FROM win WHERE h IN (SELECT h FROM twice)),
word AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM doc),
kept AS (
  SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS kept
  FROM word ANTI JOIN gone USING (rid, k) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN kept ON kept.rid = doc.rid
"""

OP4 = """
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
best AS (
  SELECT payload_digest, max(page_id) AS stored FROM page WHERE payload_bytes >= 1000
  GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN stored IS DISTINCT FROM page_id AND stored IS NOT NULL THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN stored IS DISTINCT FROM page_id THEN stored END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM page LEFT JOIN best USING (payload_digest)
"""

OP13 = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
         CAST(list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS rn
  FROM pair WHERE same AND id <> anchor_id),
neg AS (
  SELECT pos.anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, id) AS rn
  FROM pos JOIN pair ON pair.anchor_id = pos.anchor_id AND NOT same AND rn <= 5
   AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rn AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM neg WHERE rn <= 10
"""
