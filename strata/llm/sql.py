"""Oracle SQL (DuckDB) of the registered queries that SQL can express."""

from __future__ import annotations

from strata.llm.ownership import BARE_RE2, ENDS, KINDS, MAX_OWNERS, MAX_REPOS, MIN_DISTINCT

# Distinct texts stand for their copies; links by shared shingles, components by a recursive walk.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) END AS s
  FROM words),
keyed AS (SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS k, s FROM sets),
reps AS (SELECT k, min(doc_id) AS r, any_value(n) AS n, any_value(s) AS s FROM keyed WHERE n > 0 GROUP BY k),
flat AS (SELECT r, n, unnest(s) AS g FROM reps),
links AS (
  SELECT a.r AS x, b.r AS y FROM flat a JOIN flat b ON a.g = b.g AND a.r <> b.r
         AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.r, b.r HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
walk AS (SELECT DISTINCT x, x AS y FROM links UNION SELECT w.x, l.y FROM walk w JOIN links l ON l.x = w.y),
comp AS (SELECT x AS r, min(y) AS c FROM walk GROUP BY x)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles,
       CASE WHEN d.n = 0 THEN d.doc_id ELSE coalesce(comp.c, reps.r) END AS component_id
FROM keyed d LEFT JOIN reps ON reps.k = d.k AND d.n > 0 LEFT JOIN comp ON comp.r = reps.r
"""


def _matches_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    flags, body = ("(?i)", pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
    lazy = f"{flags}([\\s\\S]*?)({body})".replace("'", "''")
    part = lambda g: f"unnest(regexp_extract_all(coalesce(text, ''), '{lazy}', {g}))"
    return f"""
  SELECT doc_id, source, lang, '{kind}' AS kind, {rank} AS rank, stop - length(w) + length(g) AS start, stop, v
  FROM (SELECT *, CAST(sum(length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS stop
        FROM (SELECT doc_id, source, lang, {part(1)} AS g, {part(0)} AS w, {part(group + 2)} AS v,
                     generate_subscripts(regexp_extract_all(coalesce(text, ''), '{lazy}', 0), 1) AS i
              FROM documents)) WHERE length(v) >= {least}"""


SECRETS_SQL = ("WITH base AS (" + " UNION ALL ".join(
    _matches_sql(k, r, p, g, n) for r, (k, p, g, n) in enumerate(KINDS)) + f"""),
val AS (SELECT trim(v, '{ENDS}') AS c, count(DISTINCT coalesce(source, '')) <= {MAX_OWNERS}
               AND count(DISTINCT coalesce(source, '') || chr(10) || concat_ws('/', source, lang)) <= {MAX_REPOS}
               AND len(list_distinct(string_split(trim(v, '{ENDS}'), ''))) >= {MIN_DISTINCT}
               AND regexp_matches(trim(v, '{ENDS}'), '[0-9]') AND regexp_matches(trim(v, '{ENDS}'), '[A-Za-z]') AS live
        FROM base GROUP BY trim(v, '{ENDS}')),
bare AS (SELECT * FROM (
           SELECT * REPLACE (start + length(v) - length(ltrim(v, '{ENDS}')) AS start,
                             start + length(v) - length(ltrim(v, '{ENDS}')) + length(trim(v, '{ENDS}')) AS stop)
           FROM ({_matches_sql('live', len(KINDS), BARE_RE2, 0, MIN_DISTINCT)}) y) x
         WHERE trim(v, '{ENDS}') IN (SELECT c FROM val WHERE live)
           AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.start < x.stop AND b.stop > x.start)),
every AS (SELECT doc_id, kind, rank, start, stop, v, live FROM base JOIN val ON val.c = trim(v, '{ENDS}')
          UNION ALL SELECT doc_id, kind, rank, start, stop, v, NULL FROM bare),
per AS (
  SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
         count(*) FILTER (WHERE rank = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base_spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         count(*) FILTER (WHERE live) AS live, count(*) FILTER (WHERE NOT live) AS copied
  FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(live, 0) AS live, coalesce(copied, 0) AS copied
FROM documents d LEFT JOIN per USING (doc_id)
""")

# Base 32 of a hex digest: eight times five hex digits are four letters each.
WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, upper(sha1(coalesce(html, ''))) AS x FROM pages),
d AS (
  SELECT page_id, strlen(h) AS payload_bytes, x,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((('0x' || substr(x, CAST(i // 4 * 5 + 1 AS BIGINT), 5))::BIGINT >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS BIGINT) + 1, 1)), '')
           AS payload_digest
  FROM p),
f AS (SELECT x, min(page_id) AS first FROM d GROUP BY x)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN d.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id = f.first THEN NULL ELSE f.first END AS refers_to
FROM d JOIN f USING (x)
"""

# crc32 of the distinct words by its table of 256; sums and noise in doubles, means by whole-number division.
RESAMPLE_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
cut AS (
  SELECT 's' AS side, doc_id AS id, row_number() OVER () AS r, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 't', item_id, row_number() OVER (), regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
flat AS (SELECT side, r, w, count(*) AS n FROM (SELECT side, r, unnest(w) AS w FROM cut) GROUP BY ALL),
word AS (
  SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(CAST(length(h) / 2 AS BIGINT)),
              lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS b
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM flat), tab),
counts AS (SELECT b, sum(n) FILTER (WHERE side = 's') AS s, sum(n) FILTER (WHERE side = 't') AS t
           FROM flat JOIN word USING (w) GROUP BY b),
total AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counts),
gain AS (SELECT b, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all::DOUBLE + 10000)
                                        / ((coalesce(s, 0)::DOUBLE + 1) * (t_all::DOUBLE + 10000)))) AS BIGINT) AS g
         FROM counts, total),
per AS (SELECT r, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * g) AS BIGINT) AS g
        FROM flat JOIN word USING (w) JOIN gain USING (b) WHERE side = 's' GROUP BY r),
scored AS (
  SELECT id AS doc_id, coalesce(n, 0) AS n_features,
         CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                   / 4294967296::DOUBLE))) AS BIGINT) AS noise
  FROM cut LEFT JOIN per USING (r) WHERE side = 's'),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS k,
                  10 * count(*) OVER () // 100 AS places
           FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, CAST(s.weight AS BIGINT) AS weight, CAST(s.weight + s.noise AS BIGINT) AS score,
       CASE WHEN k <= places THEN k END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
"""
