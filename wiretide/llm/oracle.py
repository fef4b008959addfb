"""SQL for DuckDB that gives the rows of the operators SQL can express."""

from __future__ import annotations

from wiretide.llm.url_filter import SOFT, SOFT_HITS, STRICT

WORD = r"[^\x20\x09-\x0D]+"


def _hits(term: str) -> str:
    return f"regexp_matches(u, '(^|[^a-z]){term}([^a-z]|$)')"


_SOFT_TERMS = " + ".join(f"CAST({_hits(t)} AS BIGINT)" for t in SOFT)
# Splitting at the neighbours lets two hits share one.
_STRICT_HITS = " + ".join(f"len([x for x in regexp_split_to_array(u, '[^a-z]+') if x = '{t}'])" for t in STRICT)

OP2_MIXING = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    coalesce('=' || source, '') AS k, 'mix|' || coalesce(CAST(doc_id AS VARCHAR), '') AS drawn FROM documents),
n AS (SELECT greatest(1, CAST(ceil(sqrt(count(*))) AS BIGINT)) AS slots FROM documents),
s AS (
  SELECT doc_id, k, size, md5(drawn) AS o, CAST(floor(CAST('0x' || md5(drawn)[1:8] AS BIGINT) / 4294967296.0::DOUBLE * slots) AS BIGINT) AS slot,
    CASE WHEN size < 64 THEN size ELSE (length(bin(size)) - 1) * 32 + CAST(floor(size / pow(2.0::DOUBLE, length(bin(size)) - 6)) AS BIGINT) END AS stratum
  FROM d, n),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY stratum, slot, o, doc_id) AS rank FROM s),
src AS (SELECT source, coalesce('=' || source, '') AS k, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM src),
f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM w WINDOW before AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (
  SELECT rest AS level_rest, open_weight AS level_weight FROM f WHERE rest * weight <= cap * open_weight
  ORDER BY cap / weight, source ASC NULLS LAST LIMIT 1),
t AS (
  SELECT k, source_size, least(CAST(cap AS DOUBLE), CAST(level_rest * weight AS DOUBLE) / CAST(level_weight AS DOUBLE)) AS target,
    CAST('0x' || md5('mix|offset|' || k)[1:8] AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM f, lv),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size) ELSE 0.0 END AS rate FROM t)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rank * rate + u) - floor((rank - 1) * rate + u)) AS BIGINT) AS taken
FROM ranked JOIN r USING (k)
"""

OP3_URL_FILTER = f"""
WITH p AS (
  SELECT page_id, lower(coalesce(url, '')) AS u,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, u, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
v AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
    CAST({_STRICT_HITS} AS BIGINT) AS strict_hits, CAST({_SOFT_TERMS} AS BIGINT) AS soft_terms FROM h)
SELECT page_id, host, path, rule, strict_hits, soft_terms,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN strict_hits > 0 OR soft_terms >= {SOFT_HITS} THEN 'block' ELSE 'allow' END AS verdict FROM v
"""

# crc32 of the id's digits: every character, then eight steps of one bit.
_CRC32 = """xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END))"""

OP12_CONVERSATION_TRIE = f"""
WITH s AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM s)),
r AS (
  SELECT c.conv_id, 0 AS part, i, role, text FROM c JOIN s ON s.conv_id = c.base AND i <= h
  UNION ALL SELECT c.conv_id, 1, i, role, text FROM c JOIN s ON s.conv_id = c.conv_id AND i > h),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth, role, text FROM r),
p AS (
  SELECT conv_id, depth, length(text) AS chars, list([role, text]) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS k FROM d
  UNION ALL SELECT conv_id, 0, 0, [] FROM c),
e AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM p),
n AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256 FROM e GROUP BY k, depth),
u AS (SELECT n.*, q.k AS parent FROM n LEFT JOIN p q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1),
kids AS (SELECT parent AS k, count(*) AS n_children FROM u WHERE depth > 0 GROUP BY parent),
below AS (
  SELECT a.k, sum(u.saved) AS saved_tokens, count(*) FILTER (kids.n_children IS NULL) AS n_leaves
  FROM u LEFT JOIN kids ON kids.k = u.k JOIN p a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.k)
SELECT u.conv_id, u.depth, o.conv_id AS parent_conv_id, u.n_convs, coalesce(kids.n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
FROM u JOIN below USING (k) LEFT JOIN kids USING (k) LEFT JOIN n o ON o.k = u.parent
"""

ORACLE_SQL: dict[str, str] = {"op2_mixing": OP2_MIXING, "op3_url_filter": OP3_URL_FILTER, "op12_conversation_trie": OP12_CONVERSATION_TRIE}
