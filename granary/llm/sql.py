"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

P4_PLACES = r"""l AS (SELECT rec_id, url, source, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM data_pipeline WHERE text IS NOT NULL),
k AS (SELECT rec_id, line_no, regexp_replace(lower(line), '[^\p{L}\p{M}]+', '', 'g') AS key,
coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_extract(regexp_replace(regexp_replace(lower(url), '^\s+', ''), '^(?:[a-z][a-z0-9+.-]*:)?//', ''),
'^[^/?#\\\s]*'), '^.*@', ''), ':[0-9]*$', ''), '^(www|m)\.', ''), ''), source) AS site FROM l),
f AS (SELECT site, key FROM k WHERE key <> '' GROUP BY site, key HAVING count(DISTINCT rec_id) >= 10),
hit AS (SELECT rec_id, line_no FROM k JOIN f USING (site, key))"""

P4_FOUND = f"WITH {P4_PLACES} SELECT rec_id, CAST(line_no AS INTEGER) AS line_no FROM hit"

P4_CLEANED = f"""WITH {P4_PLACES}, n AS (SELECT rec_id, count(*) AS c FROM hit GROUP BY rec_id),
s AS (SELECT l.rec_id, string_agg(line, chr(10) ORDER BY line_no) FILTER (h.line_no IS NULL) AS t FROM l LEFT JOIN hit h USING (rec_id, line_no) GROUP BY l.rec_id)
SELECT d.rec_id, CASE WHEN n.c IS NULL THEN text ELSE coalesce(t, '') END AS text, CAST(coalesce(n.c, 0) AS INTEGER) AS removed_lines
FROM data_pipeline d LEFT JOIN n USING (rec_id) LEFT JOIN s USING (rec_id)"""


def p5_found(normal: str) -> str:
    """normal: table n(doc_id, n) of normalised texts."""
    return f"""WITH {normal},
w AS (SELECT doc_id, unnest(string_split(n, ' ')) AS w, unnest(range(len(string_split(n, ' ')))) AS i FROM n WHERE n <> ''),
r AS (SELECT doc_id, w || ' ' || lead(w, 1) OVER d || ' ' || lead(w, 2) OVER d || ' ' || lead(w, 3) OVER d || ' ' || lead(w, 4) OVER d AS s FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
s AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM r WHERE s IS NOT NULL UNION ALL SELECT doc_id, 'short ' || n FROM n WHERE n <> '' AND len(string_split(n, ' ')) < 5),
c AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2)
SELECT a AS rec_id_a, b AS rec_id_b FROM o JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 5 * o >= 4 * (ca.c + cb.c - o)"""


P7_PLAN = r"""sz AS (SELECT doc_id, lower(regexp_replace(coalesce(source, ''), '\s+', '', 'g')) AS src, len(string_split(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')), ' ')) AS n,
('0x' || left(md5(doc_id::VARCHAR), 15))::BIGINT AS key FROM documents WHERE text IS NOT NULL),
t AS (SELECT lower(regexp_replace(source, '\s+', '', 'g')) AS src, min(source) AS source, sum(target_share) AS target_share, max(max_repeats) AS max_repeats FROM mix_targets WHERE target_share > 0 AND max_repeats > 0 GROUP BY 1),
h AS (SELECT src, CAST(sum(n) AS BIGINT) AS available, count(*) AS documents FROM sz GROUP BY src),
p AS (SELECT src, source, target_share, max_repeats, coalesce(available, 0) AS available, coalesce(documents, 0) AS documents, CAST(sum(available) OVER () AS BIGINT) AS planned FROM t LEFT JOIN h USING (src)),
b AS (SELECT *, CAST(floor(target_share * planned) AS BIGINT) AS budget FROM p),
k AS (SELECT doc_id, src, source, n, available, budget, max_repeats, CAST(coalesce(sum(n) OVER (PARTITION BY src ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos FROM sz JOIN b USING (src)),
m AS (SELECT doc_id, source, CAST(e.e AS INTEGER) AS epoch, (e.e - 1) * available + pos AS start, n AS n_tokens, least(n, budget - ((e.e - 1) * available + pos)) AS tokens
FROM k, (SELECT unnest(range(1, (SELECT max(max_repeats) FROM b) + 1)) AS e) e WHERE e.e <= max_repeats AND (e.e - 1) * available + pos < budget)"""

P7_MIX = f"WITH {P7_PLAN} SELECT * FROM m"

P7_SHARES = f"""WITH {P7_PLAN}, g AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens FROM m GROUP BY source), x AS (SELECT b.*, coalesce(tokens, 0) AS tokens FROM b LEFT JOIN g USING (source))
SELECT source, round(target_share, 9) AS target_share, max_repeats, documents, available, budget, tokens, round(CASE WHEN available > 0 THEN tokens / available END, 9) AS repeats, round(tokens / planned, 9) AS planned_share,
round(tokens / sum(tokens) OVER (), 9) AS actual_share, tokens >= budget AS reached FROM x"""


def p5_groups(normal: str) -> str:
    """Classes of equal sets, links between their least members, and the least member of what they connect."""
    pairs = p5_found(normal)
    head, tail = pairs.rsplit("\nSELECT ", 1)
    return head.replace("WITH ", "WITH RECURSIVE ", 1) + f""", pairs AS MATERIALIZED (SELECT {tail}),
v AS (SELECT doc_id, list_sort(list(s)) AS v FROM s GROUP BY doc_id),
m AS MATERIALIZED (SELECT doc_id AS rec_id, min(doc_id) OVER (PARTITION BY v) AS class_id FROM v),
l AS MATERIALIZED (SELECT DISTINCT x.class_id AS a, y.class_id AS b FROM pairs JOIN m x ON x.rec_id = rec_id_a JOIN m y ON y.rec_id = rec_id_b WHERE x.class_id <> y.class_id),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(x, y) AS (SELECT DISTINCT class_id, class_id FROM m UNION SELECT reach.x, e.b FROM reach JOIN e ON e.a = reach.y),
g AS (SELECT x AS class_id, min(y) AS group_id FROM reach GROUP BY x), d AS (SELECT a AS class_id, count(*) AS links FROM e GROUP BY a)
SELECT rec_id, class_id, coalesce(links, 0) AS links, group_id FROM m JOIN g USING (class_id) LEFT JOIN d USING (class_id)"""


P6_WORDS = r"""WITH z AS (SELECT doc_id, len(string_split(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')), ' ')) AS n FROM documents WHERE text IS NOT NULL)
SELECT pack_name, seq_len, count(*) AS items, CAST(sum((n + seq_len - 1) // seq_len) AS BIGINT) AS pieces, CAST(sum(n) AS BIGINT) AS tokens, 0::BIGINT AS overfull, 0::BIGINT AS split, 0::BIGINT AS gaps
FROM z, (SELECT DISTINCT pack_name, seq_len FROM pack_sizes WHERE seq_len > 0) WHERE n > 0 GROUP BY ALL"""


P2_RECORDS = r"""SELECT source, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_extract(regexp_replace(regexp_replace(lower(url), '^\s+', ''), '^(?:[a-z][a-z0-9+.-]*:)?//', ''),
'^[^/?#\\\s]*'), '^.*@', ''), ':[0-9]*$', ''), '^(www|m)\.', ''), ''), '') AS domain, count(*) AS n_records FROM data_pipeline WHERE length(text) > 0 GROUP BY ALL"""


def p3_figures(ws: str) -> str:
    """ws: class of white space in the notation of the other engine."""
    marker = "^" + ws + "*(?:[*·•+»◦‣▪●○■□–—-]+|#" + ws + "?\\p{Nd}+|§" + ws + "*\\p{Nd}+|[(\\[]?\\p{Nd}{1,4}" + ws + "*[.)\\]:–-]+)" + ws + "+"
    ends = "[.!?।॥…][\"''”’»)\\]]*" + ws + "*$"
    return f"""WITH t AS (SELECT rec_id, text FROM data_pipeline WHERE regexp_replace(text, '{ws}+', '', 'g') <> ''),
l AS (SELECT rec_id, x FROM (SELECT rec_id, unnest(string_split(text, chr(10))) AS x FROM t) WHERE regexp_replace(x, '{ws}+', '', 'g') <> ''),
n AS (SELECT *, regexp_replace(x, '^{ws}+|{ws}+$', '', 'g') AS y FROM l),
c AS (SELECT rec_id, count(*) AS n_lines, CAST(sum(len(regexp_split_to_array(y, '{ws}+'))) AS BIGINT) AS n_tokens, sum(length(x) - length(replace(x, '#', ''))) AS hashes,
sum(length(x) - length(replace(x, '…', '')) + (length(x) - length(replace(x, '...', ''))) // 3) AS dots, avg((y LIKE '%…' OR y LIKE '%...')::INT) AS ellipsis_lines,
avg(regexp_matches(x, '{ends}')::INT) AS terminal_lines, avg((length(x) < 30)::INT) AS short_lines, avg(regexp_matches(x, '{marker}')::INT) AS bullet_lines FROM n GROUP BY rec_id)
SELECT rec_id, length(text) AS n_chars, n_lines, n_tokens, round(hashes / n_tokens, 9) AS hash_ratio, round(dots / n_tokens, 9) AS ellipsis_ratio, round(ellipsis_lines, 9) AS ellipsis_lines, round(terminal_lines, 9) AS terminal_lines,
round(short_lines, 9) AS short_lines, round(bullet_lines, 9) AS bullet_lines, round((length(text) - length(replace(text, chr(10), ''))) / n_tokens, 9) AS newline_ratio FROM t JOIN c USING (rec_id)"""
