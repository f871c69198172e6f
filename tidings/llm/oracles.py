"""Comparison SQL of the registered queries, where SQL can say it."""

LETTERS = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({LETTERS.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all({LETTERS.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(w[i : i + 9]) AS n, array_to_string(w[i : i + 9], ' ') AS t FROM (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT r, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'i': i, 't': array_to_string(w[i : i + n - 1], ' ')}})) AS p
  FROM doc, size),
occ AS (SELECT r, pos.p.i AS i, pos.n AS n, item_id FROM pos JOIN win ON win.n = pos.n AND win.t = pos.p.t),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM occ)) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""

OP2 = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1),
j AS (SELECT p.*, first_id, first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM p LEFT JOIN f USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to FROM j
"""

OP4 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, unnest(list_transform(range(1, len(w) - 1), lambda i: {'i': i, 't': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]})) AS p FROM doc),
tri AS (SELECT r, p.i AS i, count(*) OVER (PARTITION BY r, p.t) AS n FROM win),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM tri WHERE n > 1) GROUP BY r),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM doc),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
c AS (
  SELECT r, doc_id, lang, base_failed, rule, greatest(0, least(40, coalesce(CAST(ceil(v) AS INT) - 1, 0))) AS cell FROM (
    SELECT *, 'symbols' AS rule, n_symbols / nullif(CAST(n_words AS DOUBLE), 0) / 0.02 AS v FROM b UNION ALL
    SELECT *, 'length', word_chars / nullif(CAST(n_words AS DOUBLE), 0) / 0.5 FROM b UNION ALL
    SELECT *, 'dup_lines', n_dup_lines / nullif(CAST(n_words AS DOUBLE), 0) / 0.01 FROM b UNION ALL
    SELECT *, 'repeats', n_repeat_words / nullif(CAST(n_words AS DOUBLE), 0) / 0.0125 FROM b)),
lab AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
cal AS (SELECT lang, rule, cell, q FROM c JOIN lab USING (doc_id) WHERE NOT base_failed),
sz AS (SELECT lang, count(*) FILTER (q = 1) AS n FROM cal WHERE rule = 'symbols' GROUP BY lang),
rk AS (SELECT lang, n, row_number() OVER (ORDER BY n DESC, lang) AS m FROM sz WHERE pow(0.995, n) <= 0.05 / 4 / 2),
al AS (SELECT coalesce(max(m), 0) AS m FROM rk WHERE pow(0.995, n) <= 0.05 / 4 / (m + 1)),
gr AS (SELECT sz.lang, coalesce('alone:' || rk.lang, 'pool') AS grp FROM sz LEFT JOIN rk ON sz.lang = rk.lang AND rk.m <= (SELECT m FROM al)),
g AS (
  SELECT grp, rule, cut, count(*) FILTER (q = 1 AND cell >= cut) AS k, count(*) FILTER (q <> 1 AND cell >= cut) AS caught,
    count(*) FILTER (q = 1) AS n
  FROM cal JOIN gr USING (lang), (SELECT unnest(range(1, 41)) AS cut) GROUP BY ALL),
t AS (
  SELECT g.grp, g.rule, g.cut, any_value(g.caught) AS caught, sum(exp(lgamma(g.n + 1.0) - lgamma(i + 1.0) - lgamma(g.n - i + 1.0)
      + i * ln(0.005) + (g.n - i) * ln(0.995))) AS p, bool_or(g.k >= g.n) AS all_of
  FROM g, LATERAL (SELECT unnest(range(0, g.k + 1)) AS i) WHERE g.k <= g.n * 0.005 GROUP BY ALL),
best AS (
  SELECT grp, rule, arg_max(cut, caught * 100 + cut) AS cut FROM t
  WHERE NOT all_of AND caught > 0 AND p <= 0.05 / 4 / ((SELECT m FROM al) + 1) GROUP BY ALL),
bad AS (SELECT r, bool_or(cell >= cut) AS bad FROM c JOIN gr USING (lang) JOIN best USING (grp, rule) GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(bad, false) AS kept
FROM b LEFT JOIN bad USING (r)
"""

OP9 = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({LETTERS.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
one AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s FROM doc),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM one),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM flat x JOIN flat y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
both_ways AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (SELECT doc_id AS a, doc_id AS b FROM one UNION SELECT r.a, p.b FROM reach r JOIN both_ways p ON r.b = p.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM one JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

# crc32 of a decimal id, modulo 4, bit by bit
CRC4 = """(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: 0::BIGINT)), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) & 3)"""

OP11 = rf"""
WITH turn AS (
  SELECT conv_id, digest, n_words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS rn FROM (
    SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_words FROM conversations WHERE conv_id IS NOT NULL)),
conv AS (SELECT conv_id, conv_id - conv_id % 20 AS base, 3 - {CRC4.format("CAST(conv_id AS VARCHAR)")} AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
built AS (
  SELECT c.conv_id, digest, n_words, row_number() OVER (PARTITION BY c.conv_id ORDER BY part, rn) AS d FROM (
    SELECT c.conv_id, 0 AS part, rn, digest, n_words FROM conv c JOIN turn t ON t.conv_id = c.base AND t.rn <= c.h UNION ALL
    SELECT c.conv_id, 1, rn, digest, n_words FROM conv c JOIN turn t ON t.conv_id = c.conv_id AND t.rn > c.h) c),
occ AS (
  SELECT conv_id, d, n_words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY d) AS k FROM built UNION ALL
  SELECT conv_id, 0, 0, '' FROM conv),
node AS (SELECT k, d, any_value(n_words) AS w, min(conv_id) AS conv_id, count(*) AS n FROM occ GROUP BY k, d),
depth AS (SELECT conv_id, max(d) AS d FROM occ GROUP BY conv_id),
ends AS (
  SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS e FROM occ JOIN depth USING (conv_id, d) GROUP BY k),
kid AS (SELECT p.k, count(*) AS n FROM node c JOIN occ p ON p.conv_id = c.conv_id AND p.d = c.d - 1 GROUP BY p.k),
below AS (
  SELECT a.k, count(*) FILTER (kid.n IS NULL) AS leaves, sum((m.n - 1) * m.w) AS saved
  FROM node m JOIN occ a ON a.conv_id = m.conv_id AND a.d <= m.d LEFT JOIN kid ON kid.k = m.k GROUP BY a.k)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, pn.conv_id AS parent_conv_id, CAST(node.n AS BIGINT) AS n_convs,
  CAST(coalesce(kid.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  coalesce(e, sha256('')) AS ends_sha256
FROM node JOIN below USING (k) LEFT JOIN kid USING (k) LEFT JOIN ends USING (k)
  LEFT JOIN occ po ON po.conv_id = node.conv_id AND po.d = node.d - 1 LEFT JOIN node pn ON pn.k = po.k
"""

OP12 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
n AS (
  SELECT doc_id, t, w, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS c2,
    ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM d),
f AS (
  SELECT doc_id, t, n, array_to_string(w[1 : least(c1, c2)], '') AS p, array_to_string(w[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m,
    array_to_string(w[greatest(c1, c2) + 1 :], '') AS s,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
      WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256, sha256(t) AS restored_sha256 FROM f
"""

OP13 = """
WITH doc AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x FROM documents),
spot AS (SELECT doc_id, r, unnest(range(0, len(x) // 2 - 99)) AS i FROM doc WHERE len(x) >= 200),
win AS (SELECT spot.doc_id, spot.r, i, substr(x, 2 * i + 1, 200) AS w FROM spot JOIN doc USING (r)),
late AS (
  SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 1000) AS gap FROM (
    SELECT r, i, row_number() OVER (PARTITION BY md5(w) ORDER BY doc_id NULLS FIRST, r, i) AS n FROM win) WHERE n > 1),
run AS (SELECT r, i, sum(CASE WHEN gap > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k FROM late),
cut AS (SELECT r, k, min(i) AS a, max(i) + 100 AS b FROM run GROUP BY ALL),
tail AS (SELECT r, k, b AS a, lead(a) OVER (PARTITION BY r ORDER BY k) AS b FROM cut UNION ALL SELECT r, 0, 0, min(a) FROM cut GROUP BY r),
kept AS (
  SELECT r, string_agg(substr(x, 2 * a + 1, 2 * (coalesce(b, len(x) // 2) - a)), '' ORDER BY k) AS x FROM tail JOIN doc USING (r) GROUP BY r),
total AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed FROM cut GROUP BY r)
SELECT doc_id, CAST(len(doc.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.x, doc.x))) AS kept_sha256
FROM doc LEFT JOIN total USING (r) LEFT JOIN kept USING (r)
"""

ORACLES = {"op1_decontamination": OP1, "op2_warc": OP2, "op4_quality_rules": OP4, "op9_jaccard": OP9, "op11_prefix_trie": OP11, "op12_middle": OP12, "op13_repeats": OP13}
