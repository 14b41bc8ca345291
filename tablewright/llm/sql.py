"""Independent SQL (DuckDB) for the queries that SQL can express."""

WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"

LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(text=LOWERED)} AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 OR ws IS NULL THEN [] WHEN len(ws) = 1 THEN ws
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS r FROM documents
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id,
  d.doc_id = min(r) AS kept
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
"""

OP5 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len({WORDS.format(text="text")}), 0) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY source_size * (6 // weight), source NULLS LAST) AS place FROM w),
x AS (
  SELECT o.*, (SELECT sum(source_size) FROM o) AS total,
    coalesce((SELECT sum(2 * p.source_size) FROM o p WHERE p.place < o.place), 0) AS caps_before,
    (SELECT sum(p.weight) FROM o p WHERE p.place >= o.place) AS weight_left FROM o),
y AS (
  SELECT *, 4 * source_size * weight_left <= weight * (3 * total - 2 * caps_before) AS stops FROM x),
z AS (
  SELECT *, 3 * total - 2 * coalesce((SELECT sum(2 * source_size) FROM y WHERE stops), 0) AS rest_words,
    coalesce((SELECT sum(weight) FROM y WHERE NOT stops), 0) AS sharing FROM y),
t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
    CASE WHEN stops THEN CAST(2 * source_size AS DOUBLE)
      ELSE CAST(weight * rest_words AS DOUBLE) / CAST(sharing * 2 AS DOUBLE) END AS target FROM z),
b AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget FROM t),
r AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, budget,
    CASE WHEN b.source_size > 0 THEN budget // b.source_size ELSE 0 END AS laps,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(laps * size + greatest(0, least(size, budget - laps * source_size - ahead)) AS BIGINT) AS taken
FROM r
"""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

# Base 32 writes five bits a character: four characters for five hexadecimal digits.
OP9 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT html, max(page_id) AS keeper FROM p GROUP BY html)
SELECT page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, CAST((i // 4) * 5 + 1 AS BIGINT), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN g ON p.html = g.html
"""

OP12 = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2),
    lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 5)) AS size) WHERE len(ws) >= size),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
k AS (
  SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lw, array_to_string(ws[k + 1:], ' ') AS rw
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r,
    CAST(k.a AS HUGEINT) * 2000000 // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = lw JOIN f y ON y.lang = k.lang AND y.phrase = rw),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (
  SELECT b.lang, b.phrase FROM b JOIN c t ON t.lang = b.lang AND len(t.phrase) > len(b.phrase)
    AND contains(' ' || t.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * t.a >= 80 * b.a),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM b ANTI JOIN h USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r.r, n, CAST(score AS BIGINT) AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

# Terms are runs of digits, letters and non-ASCII characters; the second table numbers item rows.
TERMS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, {TERMS} AS ts FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, {TERMS} AS ts FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS words FROM d WHERE len(ts) > 0),
tf AS (SELECT doc, t, count(*) AS tf FROM (SELECT doc, unnest(ts) AS t FROM d) GROUP BY doc, t),
df AS (
  SELECT t, CAST(floor(1000 * ln((2 * CAST(any_value(n_docs) AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, s GROUP BY t),
q AS (SELECT item, t, count(*) AS c FROM (SELECT item, unnest(ts) AS t FROM i) GROUP BY item, t),
p AS (
  SELECT q.item, tf.doc, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf
    + 12 * (100 - 25 + (25 * len(d.ts) * n_docs) // words)))) AS BIGINT) AS score
  FROM q JOIN df ON df.t = q.t JOIN tf ON tf.t = q.t JOIN d ON d.doc = tf.doc, s
  GROUP BY q.item, tf.doc),
r AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY p.item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM p JOIN d ON d.doc = p.doc JOIN i ON i.item = p.item WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

ORACLES = {"op5_mixing": OP5, "op6_near_dup": OP6, "op8_vector_search": OP8, "op9_warc": OP9,
           "op12_phrases": OP12, "op13_lexical_search": OP13}
