"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from logweave.llm.quality_rules import FENCE, MAX_REPEAT_PERCENT, MIN_DOCS, MIN_WORDS, RULES

WORD = r"[^\x20\x09-\x0D]+"

_SPREADS = ", ".join(f"('{r}', {s})" for r, s in RULES.items())
_UNPIVOT = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, m_{r} AS v FROM measured WHERE NOT base_failed" for r in RULES)
_VALUES = " UNION ALL ".join(f"SELECT rid, lang, source, '{r}' AS rule, m_{r} AS v FROM measured" for r in RULES)


def _quartiles(by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""
  SELECT {keys}rule, max(docs) AS docs, min(bucket) FILTER (upto * 100 >= docs * 25) AS q25, min(bucket) FILTER (upto * 100 >= docs * 75) AS q75
  FROM (SELECT {keys}rule, bucket, sum(n) OVER (PARTITION BY {keys}rule ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}rule) AS docs
        FROM (SELECT {keys}rule, bucket, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY {keys}rule"""


QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d),
win AS (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) k(k) GROUP BY rid),
counted AS (
  SELECT w.rid, doc_id, lang, source, len(w)::BIGINT AS n_words, len(list_aggregate(w, 'string_agg', ''))::BIGINT AS wc0,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS caps,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.rid = w.rid),
measured AS (
  SELECT *, coalesce(wc0, 0) AS word_chars, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
         n_symbols * 1000 // greatest(coalesce(wc0, 0), 1) AS m_symbols, n_dup_lines * 1000 // greatest(n_lines, 1) AS m_dup_lines,
         n_repeat_words * 1000 // greatest(n_words, 1) AS m_repeats, caps * 1000 // greatest(coalesce(wc0, 0), 1) AS m_capitals,
         coalesce(wc0, 0) * 100 // greatest(n_words, 1) AS m_word_length
  FROM counted),
sketch AS (SELECT lang, source, rule, (v >> bits) << bits AS bucket, count(*) AS n
  FROM (SELECT *, greatest(CASE WHEN v > 0 THEN floor(log2(v))::BIGINT + 1 ELSE 1 END - 6, 0) AS bits FROM ({_UNPIVOT})) GROUP BY ALL),
by_source AS ({_quartiles("lang, source")}), by_lang AS ({_quartiles("lang")}), by_all AS ({_quartiles("")}),
q AS (
  SELECT s.lang, s.source, s.rule,
         CASE WHEN s.docs >= {MIN_DOCS} THEN s.q25 WHEN l.docs >= {MIN_DOCS} THEN l.q25 ELSE a.q25 END AS q25,
         CASE WHEN s.docs >= {MIN_DOCS} THEN s.q75 WHEN l.docs >= {MIN_DOCS} THEN l.q75 ELSE a.q75 END AS q75
  FROM by_source s JOIN by_lang l ON l.rule = s.rule AND l.lang IS NOT DISTINCT FROM s.lang JOIN by_all a ON a.rule = s.rule),
fence AS (SELECT q.*, {FENCE} * greatest(q75 - q25, r.spread) AS far FROM q JOIN (VALUES {_SPREADS}) r(rule, spread) ON r.rule = q.rule),
verdict AS (
  SELECT v.rid, bool_and(v.v <= f.q75 + f.far AND (v.rule <> 'word_length' OR v.v >= f.q25 - f.far)) AS fine
  FROM ({_VALUES}) v JOIN fence f ON f.rule = v.rule AND f.lang IS NOT DISTINCT FROM v.lang AND f.source IS NOT DISTINCT FROM v.source GROUP BY v.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(NOT base_failed AND fine, false) AS kept
FROM measured LEFT JOIN verdict ON verdict.rid = measured.rid
"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT *, [3, 1, 2][((rank - 1) % 3) + 1] AS w FROM (
  SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source)),
poured AS (
  SELECT *, 200 * size AS cap, row_number() OVER o AS i,
         sum(size) OVER () * 150 - coalesce(sum(200 * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_rest
  FROM s WINDOW o AS (ORDER BY (200 * size)::DOUBLE / w, rank)),
level AS (SELECT i, rest, w_rest FROM poured WHERE cap * w_rest >= w * rest ORDER BY i LIMIT 1),
target AS (
  SELECT p.source, p.size AS source_size,
         CASE WHEN p.i < l.i THEN p.cap / 100.0::DOUBLE ELSE (p.w * l.rest)::DOUBLE / (l.w_rest * 100)::DOUBLE END AS target
  FROM poured p, level l),
laid AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM d)
SELECT doc_id, size, source_size, target,
       (greatest(least(off + size, take) - off, 0) + greatest(least(off + size, take - source_size) - off, 0))::BIGINT AS taken
FROM (SELECT laid.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS take FROM laid JOIN target t ON t.source IS NOT DISTINCT FROM laid.source)
"""

KNN_JOIN = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score
FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p) WHERE rank <= 5
"""

#: crc32 of a decimal number's digits, bit by bit (the reflected polynomial 0xEDB88320).
_CRC32 = """xor(list_reduce(
  flatten(list_transform(range(1, length({0}::VARCHAR) + 1), lambda i: list_transform(range(0, 8), lambda j: ((ascii(substr({0}::VARCHAR, i, 1)) >> j) & 1)::BIGINT))),
  lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)), 4294967295::BIGINT), 4294967295::BIGINT)"""

PREFIX_TRIE = f"""
WITH own AS (SELECT conv_id, sha256(coalesce(role, '') || chr(0) || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32.format("conv_id")} % 9 AS h, count(*) AS n FROM own GROUP BY conv_id),
plan AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
turns AS (SELECT p.conv_id, o.pos AS d, k, size FROM plan p JOIN own o ON o.conv_id = p.base AND o.pos <= p.taken
  UNION ALL SELECT p.conv_id, o.pos - h + taken, k, size FROM plan p JOIN own o ON o.conv_id = p.conv_id AND o.pos > h),
points AS (SELECT conv_id, d, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, size FROM turns
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
ends AS (SELECT conv_id, max(d) AS d FROM points GROUP BY conv_id),
nodes AS (SELECT d, path, min(p.conv_id) AS conv_id, count(*) AS n, max(size) AS size, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE e.d IS NOT NULL) AS ended
  FROM points p LEFT JOIN ends e USING (conv_id, d) GROUP BY d, path),
children AS (SELECT substr(path, 1, 64 * (d - 1)::INTEGER) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
below AS (SELECT substr(path, 1, 64 * k::INTEGER) AS path, count(*) FILTER (WHERE leaf) AS n_leaves, sum((n - 1) * size) AS saved
  FROM (SELECT n.*, n_children IS NULL AS leaf, unnest(range(0, d + 1)) AS k FROM nodes n LEFT JOIN children USING (path)) GROUP BY 1)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(n.ended, '')) AS ends_sha256
FROM nodes n JOIN below USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.path = substr(n.path, 1, 64 * (n.d - 1)::INTEGER)
"""

LLM_ORACLE: dict[str, str] = {"op12_prefix_trie": PREFIX_TRIE, "op2_quality_rules": QUALITY_RULES, "op8_knn_join": KNN_JOIN, "op10_mixing": MIXING}
