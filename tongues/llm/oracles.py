"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tongues.llm.pii import BASE, CONTEXT, KINDS, THRESHOLD, iban_pattern
from tongues.llm.sharding import MULTIPLIER, SLOT_BUCKETS

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_LOWER = "'abcdefghijklmnopqrstuvwxyz'"
#: The plain patterns of the rule; the operator's own ones are written for another regex engine.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"\b{iban_pattern()}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_TURNED = "(substr(replace(m, ' ', ''), 5) || left(replace(m, ' ', ''), 4))"
_VALID = {
    "email": "true",
    "ip": "list_max(list_transform(string_split(m, '.'), lambda p: CASE WHEN length(ltrim(p, '0')) > 3 THEN 999"
          " ELSE coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) END)) <= 255",
    "card": f"length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda d, i:"
            " CASE WHEN i % 2 = 1 THEN d::INTEGER ELSE d::INTEGER * 2 - CASE WHEN d::INTEGER > 4 THEN 9 ELSE 0 END END)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"list_reduce(list_prepend(0, list_transform(string_split({_TURNED}, ''), lambda c: CASE WHEN c >= 'A'"
            " THEN 1000 + ascii(c) - 55 ELSE ascii(c) - 48 END)), lambda r, v: CASE WHEN v >= 1000 THEN (r * 100 + v - 1000) % 97"
            " ELSE (r * 10 + v) % 97 END) = 1",
    "ssn": "NOT regexp_matches(m, '^(?:000|666|9)|-00-|-0000$')",
}


def _pii() -> str:
    parts = []
    for i, k in enumerate(KINDS):
        score = (f"least(100, {k.base + k.checked} + CASE WHEN regexp_matches(lower(right(before, {CONTEXT}) || ' ' || left(after, {CONTEXT})),"
                 f" '{k.near}') THEN {k.bonus} ELSE 0 END)")
        more = "" if k.name in BASE else f" AND score >= {THRESHOLD}"
        parts.append(f"""
SELECT doc_id, {i} AS kind, '{k.name}' AS name, start, start + length(m) AS stop, score FROM (
  SELECT doc_id, m, {score} AS score, ({_VALID[k.name]}) AS good,
    sum(length(before) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS start FROM (
    SELECT doc_id, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS before, unnest(ps[2:len(ms) + 1]) AS after FROM (
      SELECT doc_id, regexp_extract_all(text, '{_PLAIN[k.name]}') AS ms, string_split_regex(text, '{_PLAIN[k.name]}') AS ps
      FROM texts WHERE regexp_matches(text, '{_PLAIN[k.name]}')))) WHERE good{more}""")
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{n}" for i, n in enumerate(BASE))
    span = "name || ':' || start::BIGINT || ':' || stop::BIGINT"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(parts)})
SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({span}, ',' ORDER BY start, kind) FILTER (WHERE kind < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg({span}, ',' ORDER BY start, kind), '') AS spans,
  coalesce(string_agg(score::VARCHAR, ',' ORDER BY start, kind), '') AS scores
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""


_EXACT = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), {_UPPER}, {_LOWER}) AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)"""
_LINES = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_UPPER}, {_LOWER}) AS key FROM lines),
marked AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
_SHARDS = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
sums AS MATERIALIZED (SELECT doc_id, octet_length(body) + 16 AS size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(body), '..'), lambda h: (strpos('0123456789ABCDEF', h[1]) * 16 + strpos('0123456789ABCDEF', h[2]) - 17)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32 FROM d, crc),
jumps AS (
  SELECT doc_id, doc_id::HUGEINT AS key, 0::BIGINT AS j, -1::BIGINT AS last FROM documents
  UNION ALL
  SELECT doc_id, (key * {MULTIPLIER} + 1) % 18446744073709551616,
    floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((((key * {MULTIPLIER} + 1) % 18446744073709551616) >> 33) + 1)::DOUBLE))::BIGINT, j
  FROM jumps WHERE j < 41),
placed AS (SELECT doc_id, max(j) FILTER (WHERE j < 40) AS shard, max(j) FILTER (WHERE j < 41) AS grown_shard FROM jumps GROUP BY doc_id)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY (((doc_id::HUGEINT * {MULTIPLIER} + 1) % 18446744073709551616) >> 44) & {SLOT_BUCKETS - 1}, doc_id) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM sums JOIN placed USING (doc_id)"""

_NEAREST = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""

_SPELLING = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), {_UPPER}, {_LOWER}) AS run FROM documents WHERE text IS NOT NULL),
uses AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'),
      lambda h: (strpos('0123456789ABCDEF', h[1]) * 16 + strpos('0123456789ABCDEF', h[2]) - 17)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM uses, crc),
spelt AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n, first(near ORDER BY near_n DESC, near) AS form FROM pairs GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
  CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chains AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.at AS root FROM chains c JOIN forms f ON c.at = f.word WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)"""
_REPEATS = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, unnest(range(length(h) // 2)) AS p FROM d),
g AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS byte, CASE WHEN 2 * p + 100 <= length(h) THEN substr(h, 2 * p + 1, 100) END AS gram FROM b),
low AS (SELECT gram, min(doc_id) AS low FROM g WHERE gram IS NOT NULL GROUP BY gram),
hit AS (SELECT g.doc_id, g.p, g.byte, coalesce(low.low < g.doc_id, false) AS hit FROM g LEFT JOIN low USING (gram)),
gone AS (SELECT doc_id, p, byte, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM hit),
runs AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS opens FROM gone),
found AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
  sha256(unhex(coalesce(string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone), ''))) AS kept_sha256 FROM runs GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN found USING (doc_id)"""
_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN low < doc_id THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a JOIN f b ON b.f <> a.f
  JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f) JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS before FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
r AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""

ORACLES = {
    "op1_pii": _pii(),
    "op5_exact_dedup": _EXACT,
    "op8_sharding": _SHARDS,
    "op9_nearest": _NEAREST,
    "op10_line_dedup": _LINES,
    "op11_spelling": _SPELLING,
    "op12_suffix_dedup": _REPEATS,
    "op13_filter_audit": _AUDIT,
}
