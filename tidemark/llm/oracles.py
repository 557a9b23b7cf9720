"""DuckDB SQL of the queries that SQL can express, by the plainest method."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_SPACED = r"'[^ \t\n\x0B\f\r]+'"
_LETTERS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLE = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_SPACED}) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT x.a, x.b
  FROM (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS i
        FROM s JOIN s AS t ON s.g = t.g AND s.doc_id <> t.doc_id GROUP BY 1, 2) AS x
  JOIN n AS na ON na.doc_id = x.a JOIN n AS nb ON nb.doc_id = x.b
  WHERE 100 * x.i >= 85 * (na.n + nb.n - x.i)),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT links.a, reach.r FROM reach JOIN links ON links.b = reach.doc_id)
SELECT reach.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id
""",
    "op2_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_ALNUM}) AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all({_FOLDED}, {_ALNUM}) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 13) AS m, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p
        FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM win))),
hit AS (SELECT place.doc_id, place.p, win.m, win.item_id FROM place JOIN win ON win.m = place.m AND win.g = place.g),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit
          FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM (SELECT DISTINCT doc_id, p, m FROM hit)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op6_warc_archives": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM q GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM q JOIN f USING (payload_digest)
""",
    "op7_source_mix": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_SPACED}))::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY source),
-- shared out again and again: capped sources keep their cap, the rest goes by weight
round(k, source, source_size, weight, target) AS (
  SELECT 0, source, source_size, weight,
         1.5 * sum(source_size::DOUBLE) OVER () * weight / sum(weight) OVER () FROM s
  UNION ALL
  SELECT k + 1, source, source_size, weight,
         CASE WHEN target >= 2 * source_size THEN 2.0 * source_size
              ELSE (1.5 * sum(source_size::DOUBLE) OVER ()
                    - sum(CASE WHEN target >= 2 * source_size THEN 2.0 * source_size ELSE 0 END) OVER ())
                   / sum(CASE WHEN target >= 2 * source_size THEN 0 ELSE weight END) OVER () * weight END
  FROM round WHERE k < 64),
t AS (SELECT source, source_size, target, floor(target / greatest(source_size, 1))::BIGINT AS copies
      FROM round WHERE k = 64),
c AS (
  SELECT d.*, t.source_size, t.target, t.copies, t.target - t.copies * t.source_size AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS cum,
         sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN cum <= budget OR cum - own <= budget AND cum - budget < budget - (cum - own)
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
""",
    "op11_source_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_FOLDED}, {_LETTERS}) AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS w FROM d),
k AS (SELECT lang, w, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
l AS (SELECT lang, count(w)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total
      FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY lang),
c AS (SELECT lang, source, w, count(*) AS n FROM t SEMI JOIN k USING (lang, w) GROUP BY ALL),
g AS (SELECT lang, source, v, coalesce(sum(n), 0)::HUGEINT AS total
      FROM (SELECT DISTINCT lang, source FROM d) JOIN l USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
e AS (SELECT lang, source, w, coalesce(c.n, 0) AS n, k.n AS lang_n,
             1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (total + v) AS p
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, w)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
         FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                    FROM e AS x JOIN e AS y ON x.lang = y.lang AND x.w = y.w AND x.source <> y.source GROUP BY ALL) AS s
           ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
term AS (SELECT lang, source, w AS item, (p - q) * (p - q) // q AS value
         FROM (SELECT *, 1 + 1000000000::HUGEINT * (lang_n + 1) // (total + v) AS q FROM e JOIN l USING (lang))
         WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
      FROM (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' FROM term))
WHERE part = 'pair' OR rank <= 200
""",
    "op13_merkle_manifest": """
WITH RECURSIVE
-- CRC-32 of a decimal text: the usual table of 256 entries, then one step per character
crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, lang, sha256(p || n || x) AS leaf,
         sha256(p || CASE WHEN c AND n <> '-' THEN strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) ELSE n END || x) AS claim
  FROM (SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source::VARCHAR) || ':' || source, '-') || coalesce(strlen(lang::VARCHAR) || ':' || lang, '-') AS p, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n, coalesce(strlen(text::VARCHAR) || ':' || text, '-') AS x,
               coalesce(xor(4294967295, list_reduce(
                 list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda k: ascii(k)::BIGINT)),
                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0, false) AS c
        FROM documents, crc)),
leaf AS (SELECT row_number() OVER () AS id, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                count(*) OVER (PARTITION BY lang) AS n FROM d),
node AS (
  SELECT 0 AS level, lang, pos, n, leaf AS h FROM leaf
  UNION ALL
  SELECT level + 1, lang, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM node WHERE n > 1 GROUP BY level, lang, pos // 2),
sub AS (SELECT lang, h, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM node WHERE n = 1),
forest AS (
  SELECT 0 AS level, pos, n, h FROM sub
  UNION ALL
  SELECT level + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM forest WHERE n > 1 GROUP BY level, pos // 2),
-- per leaf and level its sibling (R: right of it, L: left of it, N: none)
step AS (
  SELECT leaf.id, a.level, CASE WHEN s.h IS NULL THEN 'N' WHEN s.pos % 2 = 1 THEN 'R' || s.h ELSE 'L' || s.h END AS s
  FROM leaf JOIN node AS a ON a.lang IS NOT DISTINCT FROM leaf.lang AND a.pos = leaf.pos >> a.level AND a.n > 1
  LEFT JOIN node AS s ON s.lang IS NOT DISTINCT FROM a.lang AND s.level = a.level AND s.pos = xor(a.pos, 1)
  UNION ALL
  SELECT leaf.id, sub.height + a.level, CASE WHEN s.h IS NULL THEN 'N' WHEN s.pos % 2 = 1 THEN 'R' || s.h ELSE 'L' || s.h END
  FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang JOIN forest AS a ON a.pos = sub.pos >> a.level AND a.n > 1
  LEFT JOIN forest AS s ON s.level = a.level AND s.pos = xor(a.pos, 1)),
path AS (SELECT id, list(s ORDER BY level) AS steps FROM step GROUP BY id),
proof AS (
  SELECT leaf.*, sub.h AS subroot, root.h AS root, coalesce(steps, []) AS steps
  FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang JOIN forest AS root ON root.n = 1 LEFT JOIN path USING (id)),
out AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: substr(s, 2)), '')) AS proof_sha256,
         list_reduce(list_concat([claim], steps), lambda a, s: CASE WHEN s[1] = 'R' THEN sha256(a || substr(s, 2))
           WHEN s[1] = 'L' THEN sha256(substr(s, 2) || a) ELSE sha256(a) END) AS folded_root
  FROM proof)
SELECT *, folded_root = root AS verified FROM out
""",
}
