"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = "coalesce(text, '')"

_OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format(_TEXT)}, {_SPACED}) AS a FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) >= 3 THEN list_transform(range(1, len(a) - 1), lambda i: array_to_string(a[i:i+2], ' '))
                                      WHEN len(a) > 0 THEN [array_to_string(a, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach r ON r.a = w.doc_id GROUP BY ALL"""

_OP3 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format(_TEXT)}, {_ALNUM}) AS a FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format(_TEXT)}, {_ALNUM}) AS a FROM benchmark),
v AS (
  SELECT DISTINCT item, least(10, len(a)) AS k, unnest(list_transform(range(1, greatest(len(a) - 9, 1) + 1), lambda p: array_to_string(a[p:p+9], ' '))) AS s
  FROM i WHERE len(a) > 0),
g AS (
  SELECT doc_id, unnest(range(1, len(a) - k + 2)) AS p, k, unnest(list_transform(range(1, len(a) - k + 2), lambda q: array_to_string(a[q:q+k-1], ' '))) AS s
  FROM d, (SELECT DISTINCT k FROM v) WHERE len(a) >= k),
h AS (SELECT doc_id, p, g.k, item FROM g JOIN v ON g.s = v.s AND g.k = v.k),
c AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS m, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(a) AS n_words, coalesce(n, 0) AS n_hit, coalesce(m, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""

_RECORD = (
    r"'WARC/1.1' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '')"
    r" || '>' || nl || 'WARC-Target-URI: ' || coalesce(url, '') || nl || 'Content-Type: text/html' || nl || 'Content-Length: '"
    r" || strlen(coalesce(html, '')) || nl || nl || coalesce(html, '') || nl || nl"
)
_OP6 = f"""
WITH p AS (SELECT *, chr(13) || chr(10) AS nl FROM pages),
r AS (SELECT page_id, {_RECORD} AS record, html FROM p),
h AS (
  SELECT page_id, coalesce(page_id // 1000, -1) AS archive, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest,
         NOT (left(md5(CAST(page_id AS VARCHAR)), 2) = '00' AND html[1] <> 'x') AS intact FROM r)
SELECT page_id, archive, row_number() OVER o - 1 AS seq,
       CAST(coalesce(sum(length) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS record_at,
       length, digest, intact
FROM h WINDOW o AS (PARTITION BY archive ORDER BY page_id, digest)"""

_OP8 = rf"""
WITH b AS (SELECT doc_id, source, {_TEXT} AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {_SPACED}) AS a, string_split(t, chr(10)) AS l FROM b),
g AS (
  SELECT doc_id, unnest(range(1, len(a) - 6)) AS p,
         unnest(list_transform(range(1, len(a) - 6), lambda i: array_to_string(a[i:i+7], ' '))) AS s FROM w WHERE len(a) >= 8),
twice AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, source, len(a) AS n_words, CAST(coalesce(list_sum(list_transform(a, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(l, lambda x: regexp_matches(x, {_SPACED}))) - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, {_SPACED})))) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(l) AS lines
  FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS failed FROM f GROUP BY source),
s AS (
  SELECT sum(failed) / sum(n) AS mean, sum(n) AS m, count(*) AS k, sum(n * (failed / n) * (failed / n)) AS sq, sum(n * n) AS nn FROM h),
e AS (
  SELECT mean, CASE WHEN m - nn / m > 0 THEN greatest((sq - m * mean * mean - (k - 1) * mean * (1 - mean)) / (m - nn / m), 0) END AS between FROM s),
q AS (
  SELECT mean, greatest(least(coalesce(CASE WHEN between > 0 THEN mean * (1 - mean) / between END, 1e6) - 1, 1e6), 1) AS strength FROM e),
r AS (SELECT source, (failed + mean * strength) / (n + strength) AS rate FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (rate > 0.5 AND (100 * n_symbols > 5 * word_chars OR 100 * n_dup_lines > 20 * lines))) AS kept
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source"""

# CRC-32 of a list of bytes.
_CRC_TABLE = """tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab)"""
_CRC = "xor(list_reduce({0}, lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295)"

_RUNS = r"'[A-Za-z\x{00C0}-\x{00FF}]+'"
_BYTES = """flatten(list_transform(string_split({0}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)]
                                 ELSE [CAST(192 | (ord(c) >> 6) AS BIGINT), CAST(128 | (ord(c) & 63) AS BIGINT)] END))"""

_OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format(_TEXT)}, {_RUNS})) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
h AS (SELECT run, n, {_CRC.format(_BYTES.format("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)"))} AS h FROM d, tab),
v AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM h GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7),
x AS (SELECT word, n, word[1:i] AS p, word[i + 2:] AS s FROM (SELECT *, unnest(range(0, length(word))) AS i FROM v)),
e AS (
  SELECT a.word, b.word AS other FROM x a JOIN x b ON a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.p || x.s
  UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.p || x.s),
f AS (
  SELECT e.word, o.word AS form, o.n AS form_n, o.n >= 10 * w.n AS large, count(*) OVER (PARTITION BY e.word) AS n_near
  FROM e JOIN v o ON o.word = e.other JOIN v w ON w.word = e.word QUALIFY row_number() OVER (PARTITION BY e.word ORDER BY o.n DESC, o.word) = 1),
c AS (SELECT word, form AS root FROM f WHERE large UNION SELECT c.word, f.form FROM c JOIN f ON f.word = c.root AND f.large),
t AS (SELECT c.word, c.root FROM c JOIN v ON v.word = c.root QUALIFY row_number() OVER (PARTITION BY c.word ORDER BY v.n DESC) = 1)
SELECT v.word, CASE WHEN large THEN form END AS form, coalesce(root, v.word) AS root, v.n, coalesce(n_near, 0) AS n_near,
       CASE WHEN large THEN form_n END AS form_n
FROM v LEFT JOIN f USING (word) LEFT JOIN t USING (word)"""


def _part(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


_LEAF = "sha256(" + " || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"
_LEVELS = """
  SELECT tree, 0 AS level, pos, n, digest FROM {0}
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM {1} WHERE n > 1 GROUP BY tree, level, n, pos // 16"""
_FLANKS = """
  SELECT tree, level, pos, run[1:64 * (pos % 16)] AS before, run[64 * (pos % 16) + 65:] AS after
  FROM {0} JOIN (SELECT tree, level, pos // 16 AS parent, string_agg(digest, '' ORDER BY pos) AS run FROM {0} WHERE n > 1 GROUP BY ALL) r
  USING (tree, level) WHERE pos // 16 = parent"""

_OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
l AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_LEAF.format(_part("text"))} AS digest,
         CASE WHEN {_CRC.format(_BYTES.format("CAST(doc_id AS VARCHAR)"))} % 5 = 0 THEN {_LEAF.format(_part(_LOWER.format("text")))} END AS found
  FROM documents, tab),
a AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
low AS ({_LEVELS.format("a", "low")}),
b AS (SELECT 'top' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, tree AS source, digest FROM low WHERE n = 1),
high AS ({_LEVELS.format("b", "high")}),
low_flanks AS ({_FLANKS.format("low")}),
high_flanks AS ({_FLANKS.format("high")}),
p AS (
  SELECT doc_id, a.digest, a.pos, a.tree, f.level AS step, before, after FROM a JOIN low_flanks f ON f.tree = a.tree AND f.pos = a.pos >> (4 * f.level)
  UNION ALL
  SELECT doc_id, a.digest, a.pos, a.tree, 100 + f.level, before, after FROM a JOIN b ON b.source = a.tree JOIN high_flanks f ON f.pos = b.pos >> (4 * f.level)),
g AS (
  SELECT tree, pos, string_agg(before || after, '' ORDER BY step) AS siblings, list({{'b': before, 'a': after}} ORDER BY step) AS path FROM p GROUP BY tree, pos),
z AS (
  SELECT doc_id, a.digest AS leaf, b.digest AS subroot, (SELECT digest FROM high WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(coalesce(path, []), lambda s, x: {{'b': sha256(x.b || s.b || x.a), 'a': ''}}, {{'b': coalesce(found, a.digest), 'a': ''}}).b AS folded_root
  FROM a JOIN b ON b.source = a.tree LEFT JOIN g ON g.tree = a.tree AND g.pos = a.pos)
SELECT *, folded_root = root AS verified FROM z"""

ORACLE_SQL = {
    "op1_jaccard_join": _OP1,
    "op3_decontamination": _OP3,
    "op6_warc_fixity": _OP6,
    "op8_quality_rules": _OP8,
    "op11_spelling_variants": _OP11,
    "op13_merkle_manifest": _OP13,
}
