"""SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORDS = r"""
SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
"""

OP1 = rf"""
WITH RECURSIVE words AS ({WORDS}),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
rare AS (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met
  FROM (SELECT * FROM shingles SEMI JOIN rare USING (s)) a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * met >= 75 * (x.n + y.n - met)),
reach AS (SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM documents d JOIN reach r USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
"""


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
WITH bytes AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
aims AS (SELECT regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc_words AS (SELECT doc_id, unnest(w) AS word FROM docs),
aim_words AS (SELECT unnest(w) AS word FROM aims),
known AS (SELECT word, hex(word) AS h FROM (SELECT word FROM doc_words UNION SELECT word FROM aim_words)),
hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM known, bytes),
s AS (SELECT bucket, count(*) AS n FROM doc_words JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aim_words JOIN hashed USING (word) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(g) AS weight FROM doc_words JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000.0 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE
    / 4294967296.0::DOUBLE))))::BIGINT AS score FROM docs LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20
    AND place <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20) THEN place END::BIGINT AS rank FROM placed
"""


OP13 = rf"""
WITH words AS (SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
each AS (SELECT r, lang, source, unnest(w) AS term FROM words),
kept AS (SELECT lang, term, count(*) AS total FROM each GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
sizes AS (SELECT lang, count(k.term) AS v, coalesce(sum(total), 0) AS lang_n
    FROM (SELECT DISTINCT lang FROM words) LEFT JOIN kept k USING (lang) GROUP BY lang),
times AS (SELECT lang, source, term, count(*) AS c FROM each SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM words)
    LEFT JOIN times USING (lang, source) GROUP BY lang, source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, total,
    1 + 1000000000::HUGEINT * (coalesce(c, 0) + 2) // (n + 2 * v) AS p,
    1 + 1000000000::HUGEINT * (total + 2) // (lang_n + 2 * v) AS q
    FROM groups g JOIN sizes USING (lang) JOIN kept k USING (lang) LEFT JOIN times t
    ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
prices AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN prices x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM shares WHERE c > 0 AND p > q),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM placed WHERE part = 'pair' OR rank <= 10
"""


def registered() -> dict[str, str]:
    return {"op1_minhash_near_dedup": OP1, "op12_importance_resampling": OP12, "op13_source_divergence": OP13}
