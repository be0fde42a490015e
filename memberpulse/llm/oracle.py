"""DuckDB SQL for the operators that SQL can express over whole tables."""

# words, repeated three-word windows, lines
QUALITY = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
k AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM g),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM k),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_no_letter,
        len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09\x0B-\x0D]*[*+•‣▪-][\x20\x09]'))) AS n_bullets,
        len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09\x0B-\x0D]*$'))) AS n_ellipsis
      FROM w LEFT JOIN r ON w.doc_id = r.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 14 * n_words
       OR 10 * n_symbols > n_words OR (n_lines >= 3 AND 100 * n_dup_lines > 50 * n_lines) OR 100 * n_no_letter > 30 * n_words
       OR (n_lines >= 3 AND (100 * n_bullets > 90 * n_lines OR 100 * n_ellipsis > 30 * n_lines))) AS kept
FROM m
"""

LINES = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS n, lines FROM d),
s AS (SELECT doc_id, n, trim(lines[n], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
f AS (SELECT doc_id, n, line, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c, lead(n, 2) OVER o AS last
      FROM s WHERE line <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
p AS (SELECT doc_id, n, last, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, n) AS nth FROM f WHERE last IS NOT NULL),
x AS (SELECT DISTINCT doc_id, unnest(range(n, last + 1)) AS n FROM p WHERE nth > 1),
k AS (SELECT l.doc_id, string_agg(CASE WHEN x.n IS NULL THEN l.lines[l.n] END, chr(10) ORDER BY l.n) AS text, count(x.n) AS n_removed
      FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.n = x.n GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[p : p + size - 1], ' ') AS g FROM i),
sizes AS (SELECT DISTINCT size FROM win),
e AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size),
h AS (SELECT e.doc_id, e.p, e.size, win.item_id
      FROM (SELECT doc_id, p, size, array_to_string(w[p : p + size - 1], ' ') AS g FROM e) e JOIN win ON e.g = win.g AND e.size = win.size),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS q FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, html, octet_length(encode(html)) AS n, max(page_id) OVER (PARTITION BY html) AS kept FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM q
"""

FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1,
        CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, form, len(u) AS n, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
        array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

LEXICAL_SEARCH = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
n AS (SELECT r, count(*) AS n FROM d GROUP BY r),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
f AS (SELECT doc_id, r, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, docs),
m AS (SELECT doc_id, f.r, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))) AS x
      FROM f JOIN w USING (term) JOIN n ON f.r = n.r, s),
k AS (SELECT item_id, doc_id, r, CAST(sum(x) AS BIGINT) AS score FROM m JOIN i USING (term) GROUP BY ALL),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM k WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50
"""
