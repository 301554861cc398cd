"""The queries' results in DuckDB SQL, written independently of the Spark code."""

# Words are runs without space, tab, line feed, vertical tab, form feed or carriage return; only A-Z is lowered.
_WORDS = """
words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'
    ), lambda w: w <> '') AS w
    FROM documents
)"""

# Links from shared shingles; texts with equal sets are compared once.
MINHASH = f"""
WITH RECURSIVE {_WORDS},
sets AS MATERIALIZED (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))))
    END AS s
    FROM words
),
same AS MATERIALIZED (
    SELECT min(doc_id) AS rep, s FROM sets WHERE len(s) > 0 GROUP BY s
),
shingles AS MATERIALIZED (SELECT rep, len(s) AS n, unnest(s) AS g FROM same),
pairs AS MATERIALIZED (
    SELECT a.rep AS x, b.rep AS y
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.rep < b.rep
    GROUP BY a.rep, b.rep
    HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
),
edges AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(node, other) AS (
    SELECT rep, rep FROM same
    UNION
    SELECT r.node, e.y FROM reach r JOIN edges e ON r.other = e.x
),
lowest AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id,
    d.doc_id = coalesce(l.component_id, d.doc_id) AS kept
FROM sets d
LEFT JOIN same ON same.s = d.s
LEFT JOIN lowest l ON l.node = same.rep
"""

# The list is derived from the pages as in the query; entries are compared with whole URLs, not by keys.
URL_LISTS = """
WITH parsed AS (
    SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS fetched,
        lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host,
        regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
entries AS (
    SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\\.', '') AS entry FROM parsed
    UNION
    SELECT DISTINCT host || '/' || split_part(path, '/', 2) FROM parsed WHERE split_part(path, '/', 2) <> ''
),
marked AS (
    SELECT entry, md5(entry) AS m FROM entries
    WHERE entry <> '' AND CAST('0x' || substr(md5(entry), 1, 2) AS INTEGER) < 64
),
dated AS (
    SELECT entry, DATE '2024-01-01' + CAST('0x' || substr(m, 3, 2) AS INTEGER) AS first,
        CAST('0x' || substr(m, 6, 2) AS INTEGER) AS span, substr(m, 5, 1) < '8' AS goes, substr(m, 8, 1) < '6' AS returns
    FROM marked
),
valid AS (
    SELECT entry, first AS since, CASE WHEN goes THEN first + 1 + span END AS until FROM dated
    UNION ALL
    SELECT entry, first + 31 + span, NULL FROM dated WHERE goes AND returns
),
hits AS (
    SELECT p.page_id, p.url, p.fetched, v.entry, v.since
    FROM parsed p JOIN valid v ON p.fetched >= v.since AND (v.until IS NULL OR p.fetched < v.until)
        AND (p.host = v.entry OR ends_with(p.host, '.' || v.entry) OR starts_with(p.host || p.path || '/', v.entry || '/') AND contains(v.entry, '/'))
)
SELECT p.page_id, p.url, p.fetched, any_value(p.host) AS host, count(h.entry) AS n_entries,
    max_by(h.entry, length(h.entry)) AS entry, max_by(h.since, length(h.entry)) AS since, count(h.entry) > 0 AS blocked
FROM parsed p LEFT JOIN hits h ON h.page_id = p.page_id AND h.url = p.url
GROUP BY p.page_id, p.url, p.fetched
"""

# No mail is built here: the turn before is the quoted one, and its text belongs to the first turn that wrote it.
QUOTATIONS = """
WITH RECURSIVE turns AS MATERIALIZED (
    SELECT conv_id * 1000000 + turn AS msg_id, conv_id, text,
        trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS plain,
        lag(text) OVER w AS before, row_number() OVER w AS nth
    FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
),
written AS (
    SELECT msg_id, conv_id, plain AS part FROM turns
    UNION
    SELECT msg_id, conv_id, part FROM (
        SELECT msg_id, conv_id, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '\\s+', ' ', 'g')) AS part FROM turns
    ) WHERE length(part) >= 24
),
parents AS MATERIALIZED (
    SELECT t.msg_id, min(w.msg_id) AS parent_id
    FROM turns t JOIN written w
        ON w.conv_id = t.conv_id AND w.part = trim(regexp_replace(lower(t.before), '\\s+', ' ', 'g')) AND w.msg_id < t.msg_id
    GROUP BY t.msg_id
),
up(msg_id, thread_id, depth) AS (
    SELECT t.msg_id, t.msg_id, 0 FROM turns t WHERE NOT EXISTS (FROM parents p WHERE p.msg_id = t.msg_id)
    UNION ALL
    SELECT p.msg_id, u.thread_id, u.depth + 1 FROM up u JOIN parents p ON p.parent_id = u.msg_id
)
SELECT t.msg_id, u.thread_id, p.parent_id, u.depth, row_number() OVER (PARTITION BY u.thread_id ORDER BY t.msg_id) - 1 AS position,
    regexp_replace(regexp_replace(t.text, '^([ \\t]*\\n)+', ''), '(\\n[ \\t]*)+$', '') AS text,
    CAST(least(t.nth - 1, 2) AS BIGINT) AS n_quoted
FROM turns t JOIN up u ON u.msg_id = t.msg_id LEFT JOIN parents p ON p.msg_id = t.msg_id
"""

# Slips need CRC-32: its table by eight shifts, then one step per UTF-8 byte. Near words share what is left of them
# without one letter.
VARIANTS = """
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i) ORDER BY i) AS t
    FROM range(256) r(i)
),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[a-z\u00C0-\u00FF]+')) AS w
    FROM documents
),
per_doc AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY doc_id, w),
bytes AS (
    SELECT doc_id, w, n, flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda c: CASE
        WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
        ELSE [192 + unicode(c)::BIGINT // 64, 128 + unicode(c)::BIGINT % 64] END)) AS b
    FROM per_doc
),
marked AS (
    SELECT doc_id, w, n, xor(4294967295, list_reduce(b, lambda c, x: xor(t[xor(c, x) % 256 + 1], c // 256), 4294967295::BIGINT)) AS h
    FROM bytes, crc_table
),
slipped AS (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM marked
),
vocabulary AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary),
less AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
pairs AS MATERIALIZED (
    SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT l.word, v.word, v.n FROM less l JOIN vocabulary v ON l.rest = v.word
    UNION SELECT v.word, l.word, l.n FROM less l JOIN vocabulary v ON l.rest = v.word
),
best AS (
    SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
),
found AS MATERIALIZED (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
        CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
    FROM vocabulary v LEFT JOIN best b ON v.word = b.word
),
chain(word, tip, steps) AS (
    SELECT word, word, 0 FROM found
    UNION ALL
    SELECT c.word, f.form, steps + 1 FROM chain c JOIN found f ON c.tip = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n
FROM found f JOIN (SELECT word, arg_max(tip, steps) AS root FROM chain GROUP BY word) c ON f.word = c.word
"""
