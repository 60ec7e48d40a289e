"""DuckDB SQL for the queries that SQL can express over whole tables."""

from .quality import BLANK, RULES, STOP_WORDS, SYMBOLS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (UPPER, UPPER.lower())

OP1 = f"""
WITH d AS (SELECT doc_id, {FOLDED} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {FOLDED} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
),
hit AS (SELECT doc_id, i, n, item_id FROM pos JOIN win USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _ratio(over: str, under: str, low: float, high: float) -> str:
    return f"({under} = 0 OR ({over} >= {under} * {low}::DOUBLE AND {over} <= {under} * {high}::DOUBLE))"


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP3 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^{BLANK}]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{BLANK}]')) AS lines FROM t
),
win AS (SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS k FROM p, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM twice) GROUP BY doc_id),
m AS (
  SELECT p.doc_id, len(w) AS n_words, length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, len(list_filter(w, lambda x: list_contains([{_STOP}], lower(x)))) AS n_stop_words,
    len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x) AND length(x) > 1)) AS n_upper_words
  FROM p LEFT JOIN rep USING (doc_id)
),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(_ratio(r.over, r.under, r.low, r.high) for r in RULES)} AS kept
FROM f
"""

OP11 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS x FROM d),
c AS (
  SELECT doc_id, t, w, len(w) AS n, least(x[1] % (len(w) + 1), x[2] % (len(w) + 1)) AS a, greatest(x[1] % (len(w) + 1), x[2] % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR x[3] % 100 >= 90 THEN 'plain'
      WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
),
p AS (SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

_DIGIT = "translate(to_base(CAST('0x' || substr(h, %d, 10) AS BIGINT), 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"

OP12 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS first_id FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {" || ".join(_DIGIT % k for k in (1, 11, 21, 31))} AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""

_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

OP13 = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
size AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, {_CRC} % 9 AS h FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, t.k, t.role, t.text FROM size c JOIN t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL SELECT c.conv_id, 10 + t.k, t.role, t.text FROM size c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h
),
o AS (SELECT conv_id, strlen(text) AS b, row_number() OVER w AS d, list(sha256(strlen(role) || ':' || role || text)) OVER w AS path FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
p AS (SELECT conv_id, d, b, md5(array_to_string(path, '')) AS key FROM o),
m AS (
  SELECT conv_id, d, b, key, coalesce(lag(key) OVER (PARTITION BY conv_id ORDER BY d), 'root') AS up, d = max(d) OVER (PARTITION BY conv_id) AS last FROM p
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL, conv_id NOT IN (SELECT conv_id FROM p) FROM size
),
node AS (
  SELECT key, d, any_value(up) AS up, any_value(b) AS b, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM m GROUP BY key, d
),
kids AS (SELECT up AS key, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT m.key, sum((node.n - 1) * node.b) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM node LEFT JOIN kids USING (key) JOIN m ON m.conv_id = node.conv_id AND m.d <= node.d GROUP BY m.key
)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, CAST(node.n AS BIGINT) AS n_convs,
  CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (key) LEFT JOIN kids USING (key) LEFT JOIN node parent ON parent.key = node.up
"""

ORACLES = {"op1_decontamination": OP1, "op3_quality": OP3, "op11_infill": OP11, "op12_warc": OP12, "op13_prefix_trie": OP13}
