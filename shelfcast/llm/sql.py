"""DuckDB SQL of the registered queries that SQL can express."""

OP1 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
tok AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
base AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM tok GROUP BY r),
win AS (SELECT a.r, a.p, a.word AS w1, b.word AS w2, c.word AS w3
        FROM tok a JOIN tok b ON b.r = a.r AND b.p = a.p + 1 JOIN tok c ON c.r = a.r AND c.p = a.p + 2),
twice AS (SELECT r, w1, w2, w3 FROM win GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT DISTINCT win.r, unnest([p, p + 1, p + 2]) AS p FROM win JOIN twice USING (r, w1, w2, w3)),
reps AS (SELECT r, count(*) AS n FROM covered GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
feat AS (
  SELECT doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(dups.n, 0) AS n_dup_lines, coalesce(reps.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN base USING (r) LEFT JOIN dups USING (r) LEFT JOIN reps USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_words
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS any_failed
  FROM feat),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (any_failed) AS f FROM judged GROUP BY source),
moments AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM hosts),
prior AS (SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1e6 END, 1), 1e6) AS k FROM moments),
rates AS (SELECT source, (f + m * k) / (n + k) AS rate, greatest(0.5, m + 3 * sqrt(m * (1 - m) / (k + 1))) AS most FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= most AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

OP2 = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""

OP9 = r"""
WITH parts AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                   ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (SELECT u.*, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
         FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
         GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
"""

OP11 = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
         lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS c, hex(encode(concat(doc_id, ':', run))) AS x FROM runs GROUP BY doc_id, run HAVING length(run) >= 5),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
             lambda i: 16 * (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1)),
             lambda s, b: xor(s >> 8, tab[xor(s & 255, b) + 1])), 4294967295) AS h
  FROM per_doc, crc),
spelt AS (SELECT c, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT cut.word, words.word AS other FROM cut JOIN words ON words.word = rest
  UNION SELECT words.word, cut.word FROM cut JOIN words ON words.word = rest
  UNION SELECT a.word, b.word FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word),
judged AS (
  SELECT word, w.n, coalesce(x.n_near, 0) AS n_near, CASE WHEN x.top >= 2 * w.n THEN x.form END AS form,
         CASE WHEN x.top >= 2 * w.n THEN x.top END AS form_n
  FROM words w LEFT JOIN (
    SELECT near.word, count(*) AS n_near, max(o.n) AS top, min(other) FILTER (o.n = m.n) AS form
    FROM near JOIN words o ON o.word = other
    JOIN (SELECT near.word, max(n) AS n FROM near JOIN words ON words.word = other GROUP BY near.word) m ON m.word = near.word
    GROUP BY near.word) x USING (word)),
follow AS (
  SELECT word, word AS at, form AS next FROM judged
  UNION ALL SELECT follow.word, judged.word, judged.form FROM follow JOIN judged ON judged.word = follow.next)
SELECT judged.word, form, follow.at AS root, n, n_near, form_n FROM judged JOIN follow ON follow.word = judged.word AND follow.next IS NULL
"""

OP12 = """
WITH RECURSIVE r AS (SELECT row_number() OVER () AS k, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
u AS (SELECT k, vec_id, v FROM r WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.k AS a, b.k AS b, b.vec_id AS id FROM u a JOIN u b ON a.k <> b.k AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT a, b, id FROM links UNION SELECT reach.a, links.b, links.id FROM reach JOIN links ON links.a = reach.b),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
c AS (SELECT a, min(id) AS id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(vec_id, c.id), c.id) AS component_id,
       vec_id IS NOT DISTINCT FROM coalesce(least(vec_id, c.id), c.id) AS kept
FROM r LEFT JOIN n ON n.a = r.k LEFT JOIN c ON c.a = r.k
"""

ORACLES = {"op1_quality_rules": OP1, "op2_top_k": OP2, "op9_url_rules": OP9, "op11_spelling": OP11,
           "op12_neighbours": OP12}
