"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op8_exact_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

SQL["op9_warc_zstd"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""

SQL["op10_bloom_cascade"] = """
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT u.page_id, u.host, u.path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY u.page_id, u.host, u.path ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS nth
  FROM u JOIN rules ON (u.host = rule_host OR ends_with(u.host, '.' || rule_host)) AND starts_with(u.path, rule_path)
)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.rule_verdict, 'allow') AS verdict
FROM u LEFT JOIN fits f ON f.nth = 1 AND f.page_id = u.page_id AND f.host = u.host AND f.path = u.path
"""

SQL["op2_suffix_dedup"] = """
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS body, strlen(coalesce(text, '')) AS n_bytes FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_slice(body, s + 1, s + 400)) AS content
  FROM (SELECT doc_id, body, unnest(range(n_bytes - 399)) AS s FROM d WHERE n_bytes >= 400)
), repeated AS (
  SELECT doc_id, s FROM windows QUALIFY count(*) OVER (PARTITION BY content) > 1
), marked AS (
  SELECT *, s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400, -1) AS fresh FROM repeated
), numbered AS (
  SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked
), spans AS (
  SELECT doc_id, run, min(s) AS a, max(s) + 400 AS b FROM numbered GROUP BY ALL
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id
  UNION ALL
  SELECT doc_id, 0, NULL FROM d WHERE doc_id NOT IN (SELECT doc_id FROM spans)
), kept AS (
  SELECT doc_id, string_agg(substr(hex(body), 2 * a + 1, 2 * (coalesce(b, n_bytes) - a)), '' ORDER BY a) AS body
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, n_bytes, n_bytes - length(kept.body) // 2 AS n_removed,
  (SELECT count(*) FROM spans WHERE spans.doc_id = d.doc_id) AS n_spans, sha256(unhex(kept.body)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id
"""

SQL["op3_bayes_minhash"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS shingles
  FROM words
), items AS (
  SELECT doc_id, len(shingles) AS n, hash(unnest(shingles)) AS item FROM sets
), shared AS (
  SELECT *, count(*) OVER (PARTITION BY item) AS holders FROM items
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shared a JOIN shared b ON a.item = b.item AND a.doc_id <> b.doc_id
  WHERE a.holders > 1 AND b.holders > 1
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(root, node) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT root, y FROM reach JOIN links ON node = x
)
SELECT doc_id, n_shingles, component_id, component_id = doc_id AS kept
FROM (SELECT doc_id, len(shingles) AS n_shingles FROM sets) JOIN (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""

SQL["op11_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lines AS (
  SELECT lang, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS w FROM pieces
), lengths AS (
  SELECT lang, w, unnest(range(1, 6)) AS k FROM lines
), places AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lengths WHERE len(w) >= k
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n FROM places GROUP BY ALL
), total AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND n >= 100
), inner_phrases AS (
  SELECT lang, a AS longer, unnest(flatten([[array_to_string(w[s:s + m - 1], ' ') for s in range(1, k - m + 2)] for m in range(2, k)])) AS phrase
  FROM candidates WHERE k >= 3
), absorbed AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_phrases i ON c.lang = i.lang AND c.phrase = i.phrase AND 100 * i.longer >= 100 * c.a
), cuts AS (
  SELECT c.*, unnest(range(1, k)) AS cut FROM candidates c ANTI JOIN absorbed b ON c.lang = b.lang AND c.phrase = b.phrase
), parts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.n AS l, r.n AS r, t.n AS n,
         ((1000::HUGEINT * c.a * t.n) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(w[cut + 1:c.k], ' ')
  JOIN total t ON t.lang = c.lang
), best AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, rank::INTEGER AS rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
WHERE rank <= 2000
"""

# the table of crc32 by its rule: eight steps per byte
SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
  SELECT [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) for n in range(256)] AS tab
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), counted AS (
  SELECT run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS data, count(*) AS times FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, times, xor(list_reduce([4294967295] || [('0x' || data[i:i + 1])::BIGINT for i in range(1, len(data), 2)],
                                     lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed
), v AS (
  SELECT word, sum(times)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), pairs AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT word, rest FROM cuts SEMI JOIN v ON cuts.rest = v.word
  UNION
  SELECT rest, word FROM cuts SEMI JOIN v ON cuts.rest = v.word
), best AS (
  SELECT p.word, count(*) AS n_near, min(struct_pack(a := -u.n, b := p.near)) AS top FROM pairs p JOIN v u ON u.word = p.near GROUP BY p.word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.a >= 5 * v.n THEN top.b END AS form, CASE WHEN -top.a >= 5 * v.n THEN -top.a END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.at AND e.form IS NULL
"""
