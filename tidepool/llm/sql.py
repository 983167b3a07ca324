"""Oracle SQL (DuckDB) of the registered queries that SQL can express."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT item, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bw),
lens AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lens WHERE len(w) >= n),
dwin AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM dw),
hit AS (SELECT doc_id, dwin.n, i, item FROM dwin JOIN win ON dwin.win = win.win AND dwin.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP2 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class FROM src),
caps AS (
  SELECT *, CASE class WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         CAST(2 * source_size AS DOUBLE) AS cap, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total
  FROM ranked),
lev AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, class, cap, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(w) OVER (ORDER BY cap / w, class, cap, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_from FROM caps),
filled AS (SELECT *, w * (total - cap_before) >= cap * w_from AS is_full FROM lev),
plan AS (
  SELECT source, source_size, class, CASE WHEN is_full THEN cap ELSE w * (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
           / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () END AS target FROM filled),
lined AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM sized),
took AS (
  SELECT doc_id, size, source_size, target, class, o, CAST(floor(target + 0.5) AS BIGINT) AS goal,
         CAST(greatest(0, least(size, goal - o)) AS BIGINT) AS one,
         CAST(greatest(0, least(size, goal - source_size - o)) AS BIGINT) AS two
  FROM lined l JOIN plan p ON l.source IS NOT DISTINCT FROM p.source),
-- The part of the source's demand met at the middle of the first and of the last copy.
part AS (
  SELECT *, CASE WHEN one > 0 THEN (CAST(o AS DOUBLE) + CAST(one AS DOUBLE) / 2) / goal END AS q1,
         CASE WHEN two > 0 THEN (CAST(source_size + o AS DOUBLE) + CAST(two AS DOUBLE) / 2) / goal ELSE q1 END AS q2 FROM took)
-- Cumulative demand 1.5t - t^2/2, t or 0.5t + t^2/2 by class; solved for t.
SELECT doc_id, size, source_size, target, one + two AS taken,
       CASE class WHEN 0 THEN 2 * q1 / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2 * q1)) WHEN 1 THEN q1
            ELSE 2 * q1 / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * q1)) END AS position,
       CASE class WHEN 0 THEN 2 * q2 / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2 * q2)) WHEN 1 THEN q2
            ELSE 2 * q2 / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * q2)) END AS last_position
FROM part
"""

OP3 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, count(DISTINCT doc_id) AS n, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key),
j AS (SELECT k.*, coalesce(g.n >= 5 AND k.doc_id <> g.keeper, false) AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS least FROM win) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM rep),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) AS kept, count(*) AS n
         FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p WHERE gone.p IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT a AS x, b AS y FROM link UNION SELECT r.x, l.b FROM reach r JOIN link l ON r.y = l.a),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN low ON d.doc_id = low.x
"""

OP10 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hexed FROM pages),
d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, hexed,
    array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((('0x' || substr(hexed, CAST(1 + 10 * (k // 8) AS INTEGER), 10))::BIGINT >> CAST(5 * (7 - k % 8) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM d WINDOW same AS (PARTITION BY payload_digest)
"""

OP12 = r"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT list_transform(range(0, 256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
rn AS (SELECT id, run, count(*) AS c, hex(encode(id || ':' || run)) AS h FROM r WHERE length(run) >= 6 GROUP BY 1, 2),
cr AS (
  SELECT run, c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, length(h) // 2),
           lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
           lambda x, y: xor(x >> 8, crc[(xor(x, y) & 255) + 1])), 4294967295) AS k FROM rn, t),
w AS (
  SELECT CASE WHEN k % 199 = 0 THEN left(run, CAST(k % length(run) AS BIGINT)) || substr(run, CAST(k % length(run) AS BIGINT) + 2) ELSE run END AS word,
         c FROM cr),
words AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5),
sk AS MATERIALIZED (
  SELECT word, n, i, left(word, i) AS pre, substr(word, i + 2) AS post FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word AS u, b.word AS v, b.n AS vn FROM sk a JOIN sk b ON a.pre = b.pre AND a.post = b.post AND a.word <> b.word
  UNION SELECT sk.word, words.word, words.n FROM sk JOIN words ON words.word = pre || post
  UNION SELECT words.word, sk.word, sk.n FROM sk JOIN words ON words.word = pre || post),
best AS (
  SELECT u, count(*) AS n_near, arg_min(v, (-vn, v)) AS v, max(vn) AS vn FROM near GROUP BY u),
f AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN vn >= 5 * n THEN v END AS form, CASE WHEN vn >= 5 * n THEN vn END AS form_n
  FROM words LEFT JOIN best ON word = u),
walk AS (
  SELECT word, form AS reached FROM f WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON walk.reached = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, reached FROM walk JOIN f ON walk.reached = f.word WHERE f.form IS NULL)
SELECT f.word, form, coalesce(ends.reached, f.word) AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM f LEFT JOIN ends ON f.word = ends.word
"""

OP13 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
g AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest(range(1, 5)) AS m) WHERE len(w) >= m)),
f AS MATERIALIZED (SELECT lang, m, phrase, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 30),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
c AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cut AS (
  SELECT c.lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c),
sc AS (
  SELECT cut.lang, cut.phrase, a, k, fl.f AS l, fr.f AS r, CAST((2000000::HUGEINT * a) // (fl.f::HUGEINT + fr.f) AS BIGINT) AS score
  FROM cut JOIN f fl ON cut.lang = fl.lang AND x = fl.phrase JOIN f fr ON cut.lang = fr.lang AND y = fr.phrase),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, a, w, s, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c WHERE m > 2))
  GROUP BY 1, 2),
stay AS (
  SELECT low.* FROM low LEFT JOIN inner_ ON low.lang = inner_.lang AND low.phrase = inner_.phrase
  WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT stay.lang, row_number() OVER (PARTITION BY stay.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM stay JOIN total ON stay.lang = total.lang QUALIFY rank <= 2000
"""
