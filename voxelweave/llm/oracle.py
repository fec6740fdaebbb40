"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from .chat import CONTROL
from .url_rules import DEFAULT, LOWER, RULES, UPPER

OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.x, d.x), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_ESCAPE = "replace({}, '\\', '\\\\')"
for _mark in CONTROL:
    _ESCAPE = f"replace({_ESCAPE}, '{_mark}', '{_mark[0]}\\{_mark[1:]}')"

OP6 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
w AS (SELECT r, k, hash(substr(x, 2 * k + 1, 400)) AS h FROM (SELECT r, x, unnest(generate_series(0, length(x) // 2 - 200)) AS k FROM d)),
again AS (SELECT r, k FROM w SEMI JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
runs AS (SELECT r, min(k) AS a, max(k) + 200 AS b FROM (SELECT r, k, sum(new) OVER (PARTITION BY r ORDER BY k) AS g
    FROM (SELECT r, k, CASE WHEN k - lag(k) OVER (PARTITION BY r ORDER BY k) <= 200 THEN 0 ELSE 1 END AS new FROM again)) GROUP BY r, g),
s AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r),
ends AS (SELECT r, a AS b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a FROM (SELECT r, a, b FROM runs UNION ALL SELECT r, length(x) // 2, NULL FROM d)),
kept AS (SELECT r, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS x FROM ends JOIN d USING (r) GROUP BY r)
SELECT doc_id, length(d.x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept.x)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN s USING (r)
"""

OP7 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, row_number() OVER o AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(8 + 8 + 7 + length({_ESCAPE.format('role')}) + length({_ESCAPE.format('text')})) OVER (o ROWS UNBOUNDED PRECEDING) AS chars
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

OP8 = f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {_RULES}),
u AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT h.*, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS best
  FROM h LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict FROM r WHERE best = 1
"""

_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), '%s', '%s'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')" % (UPPER, LOWER)

OP9 = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, array_to_string(w[k:k + 9], ' ') AS words, least(len(w), 10) AS size
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
d AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT n, size, k, array_to_string(w[k:k + size - 1], ' ') AS words
  FROM (SELECT n, w, size, unnest(generate_series(1, len(w) - size + 1)) AS k FROM d, sizes)),
hits AS (SELECT n, k, places.size, item FROM places JOIN win USING (words, size)),
pos AS (SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT n, unnest(generate_series(k, k + size - 1)) AS p FROM hits) GROUP BY n),
its AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT n, item FROM hits) GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (n) LEFT JOIN its USING (n)
"""

OP3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[k:k + 4], ' ')) AS h FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
overlap AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM overlap JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id, d.doc_id <= coalesce(low.b, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id
"""

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# 160 bits of SHA-1 as 32 groups of 5; each group lies within two hexadecimal digits
_BASE32 = " || ".join(f"substr('{_DIGITS}', 1 + ((h[{5 * g // 4 + 1}] * 16 + h[{5 * g // 4 + 2}]) // {2 ** (3 - 5 * g % 4)}) % 32, 1)" for g in range(32))

OP10 = f"""
WITH p AS (SELECT row_number() OVER () AS n, page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT n, page_id, html, list_transform(string_split(sha1(html), ''), lambda c: instr('0123456789abcdef', c) - 1) AS h FROM p),
r AS (SELECT *, first_value(page_id) OVER o AS first_page, first_value(n) OVER o AS first_n FROM h WINDOW o AS (PARTITION BY html ORDER BY page_id NULLS LAST, n))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN n = first_n THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n <> first_n THEN first_page END AS refers_to
FROM r
"""

_FLOOR_MEAN = "(CAST(sum(x) AS BIGINT) - ((CAST(sum(x) AS BIGINT) % count(*)) + count(*)) % count(*)) // count(*)"


def _round(n: int) -> str:
    """Assignment to the centroids c{n}, and the centroids after it."""
    return f"""
a{n} AS (SELECT r, v, number FROM (SELECT k.r, k.v, c.number, row_number() OVER (PARTITION BY k.r ORDER BY {_DISTANCE}, c.number) AS nth FROM k, c{n} c) WHERE nth = 1),
m{n} AS (SELECT number, list(x ORDER BY d) AS v FROM (SELECT number, d, {_FLOOR_MEAN} AS x FROM (SELECT number, unnest(range(1, 65)) AS d, unnest(v) AS x FROM a{n}) GROUP BY number, d) GROUP BY number),
c{n + 1} AS MATERIALIZED (SELECT c.number, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (number))"""


_DISTANCE = "list_sum(list_transform(list_zip(k.v, c.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
OP12 = f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS number, v FROM k WHERE vec_id IS NOT NULL QUALIFY number < 16),
{", ".join(map(_round, range(3)))},
f AS (SELECT vec_id, number, distance FROM (SELECT k.vec_id, c.number, {_DISTANCE} AS distance, row_number() OVER (PARTITION BY k.r ORDER BY {_DISTANCE}, c.number) AS nth FROM k, c3 c) WHERE nth = 1)
SELECT vec_id, CAST(number AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c3.v, ',')) AS centroid_sha256 FROM f JOIN c3 USING (number)
"""

ORACLE: dict[str, str] = {"op3_near_duplicates": OP3, "op5_metric_search": OP5, "op6_suffix_dedup": OP6, "op7_chat_formatting": OP7, "op8_url_rules": OP8, "op9_decontamination": OP9, "op10_warc": OP10, "op12_centroid_clusters": OP12}
