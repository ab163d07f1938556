"""SQL of what the training-data operators return by contract alone, and of whole results where SQL can express them."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Links by counting common shingles of all pairs of documents, then reachability.
NEAR_DUP = rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS a FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(a) = 0 THEN [] WHEN len(a) = 1 THEN [a[1]] ELSE list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1]) END) AS g FROM w),
n AS (SELECT r, doc_id, len(g) AS n FROM s), t AS (SELECT r, unnest(g) AS g FROM s),
often AS (SELECT g FROM t GROUP BY 1 HAVING count(*) > 1), u AS (SELECT r, g FROM t JOIN often USING (g)),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM u x JOIN u y ON x.g = y.g AND x.r < y.r GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM n UNION SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b)
SELECT x.doc_id, x.n::BIGINT AS n_shingles, min(y.doc_id) AS component_id, x.doc_id = min(y.doc_id) AS kept FROM reach JOIN n x ON x.r = reach.a JOIN n y ON y.r = reach.b GROUP BY x.r, x.doc_id, x.n
"""

_LUHN = "list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse(d), i, 1)::INTEGER ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(reverse(d), i, 1)::INTEGER + 1] END)) % 10 = 0"

IDENTIFIERS = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cards AS (SELECT r, replace(replace(unnest(regexp_extract_all(text, '[0-9](?:[\x20-]?[0-9])+')), ' ', ''), '-', '') AS d FROM t),
good AS (SELECT r, count(*) AS n FROM cards WHERE length(d) BETWEEN 13 AND 19 AND {_LUHN} GROUP BY 1)
SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'))::BIGINT AS n_email,
len(list_filter(regexp_extract_all(text, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'), lambda x: list_max(list_transform(string_split(x, '.'), lambda p: TRY_CAST(right(concat('000', ltrim(p, '0')), 9) AS INTEGER) + CASE WHEN length(ltrim(p, '0')) > 3 THEN 1000 ELSE 0 END)) <= 255))::BIGINT AS n_ip,
coalesce(good.n, 0)::BIGINT AS n_card,
len(list_filter(regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 9 AND 15))::BIGINT AS n_phone
FROM t LEFT JOIN good USING (r)
"""

EXACT_LINES = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents), l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
c AS (SELECT doc_id, text, i, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM l), r AS (SELECT doc_id, text, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AND line <> '' AS gone FROM c)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed FROM r GROUP BY doc_id, text
"""

PAYLOADS = """
SELECT doc_id, n::BIGINT AS n_bytes, p::BIGINT AS payload_bytes, sha256(concat(text, repeat(chr(0), (p - n)::BIGINT))) AS payload_sha256
FROM (SELECT doc_id, text, n, greatest(1, (n + 63) // 64) * 64 AS p FROM (SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) AS n FROM documents))
"""

#: Shares by weight under caps: sources fill up in order of cap by weight, the others share what is left.
TARGETS = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source IS NULL, source) AS r FROM d GROUP BY 1),
w AS (SELECT source, n, 2.0 * n AS cap, [3.0, 1.0, 2.0][(r - 1) % 3 + 1] AS w, sum(n) OVER () * 1.5 AS total FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER z, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER z, 0) AS free FROM w WINDOW z AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((total - capped) / free, cap / w) AS v FROM o WHERE (total - capped) / free <= cap / w)
SELECT doc_id, size::BIGINT AS size, n::BIGINT AS source_size, round(CASE WHEN v IS NULL THEN cap ELSE least(cap, v * w) END, 3)::DOUBLE AS target FROM d JOIN o ON d.source IS NOT DISTINCT FROM o.source, level
"""

PHRASES = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS a FROM documents),
p AS (SELECT r, unnest(list_filter(list_transform(range(1, len(a) + 1), lambda i: struct_pack(i := i - 1, label := CASE WHEN a[i] = 'cc' AND a[i + 1] = 'by' THEN 'cc-by' WHEN a[i] = 'general' AND a[i + 1] = 'public' AND a[i + 2] = 'license' THEN 'gpl' WHEN a[i] = 'all' AND a[i + 1] = 'rights' AND a[i + 2] = 'reserved' THEN 'reserved' END)), lambda x: x.label IS NOT NULL)) AS x FROM w),
f AS (SELECT r, count(*) AS n, min(x.i) AS lo, max(x.i) AS hi, string_agg(DISTINCT x.label, ',' ORDER BY x.label) AS labels FROM p GROUP BY 1)
SELECT doc_id, len(a)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word, coalesce(labels, '') AS base_labels FROM w LEFT JOIN f USING (r)
"""
