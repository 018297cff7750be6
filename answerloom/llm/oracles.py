"""DuckDB SQL of the queries that SQL can express; written apart from the operators' own code."""

ORACLES: dict[str, str] = {}

ORACLES["op2_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
grams AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + s) AS n_repeat_words FROM twice, range(5) AS r(s) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
spread AS (  -- what parts words stands twice, so that neighbouring phrases do not share it
  SELECT *, regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '([^0-9_a-z\x{80}-\x{10FFFF}])', '\1\1', 'g') AS wide FROM lines WHERE len(w) > 0),
counted AS (
  SELECT *, list_sum(list_transform(['all rights reserved', 'privacy policy', 'terms of use', 'terms of service', 'cookie policy',
      'uses cookies', 'enable javascript', 'lorem ipsum', 'click here', 'skip to content', 'read more', 'share this', 'sign up',
      'log in', 'back to top'], lambda p: len(p) * len(regexp_extract_all(wide,
      '(?:^|[^0-9_a-z\x{80}-\x{10FFFF}])' || replace(p, ' ', '  ') || '(?:[^0-9_a-z\x{80}-\x{10FFFF}]|$)')))) AS phrase_chars
  FROM spread),
judged AS (
  SELECT doc_id, line, len(array_to_string(w, '')) AS chars,
    100 * len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > 10 * len(line)
    OR 100 * len(list_filter(w, lambda x: regexp_full_match(x, '[|>*#/-]+'))) >= 20 * len(w)
    OR (len(w) < 4 AND NOT regexp_full_match(w[-1][-1], '[.!?:;"'')}\]]'))
    OR (phrase_chars > 0 AND 100 * phrase_chars >= 25 * len(line)) AS failed
  FROM counted),
by_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (failed) AS n_failed_lines, coalesce(sum(chars) FILTER (failed), 0)::BIGINT AS lost_chars
  FROM judged GROUP BY doc_id),
figures AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines,
    coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM words LEFT JOIN repeats USING (doc_id) LEFT JOIN by_line USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 40 * word_chars AS kept
FROM figures
"""

ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM h WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM h LEFT JOIN f USING (payload_digest)
"""

ORACLES["op4_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE s >= 0.8 * (x.n + y.n - s)),
reach(a, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.a)
SELECT d.doc_id, min(c) AS class_id, coalesce(any_value(k.n), 0)::BIGINT AS n_links
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) k ON k.a = d.doc_id
GROUP BY d.doc_id
"""

ORACLES["op11_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS copy FROM d),
m AS (SELECT doc_id, part,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN copy THEN 'E' ELSE '' END AS fails
      FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
          FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, filter_order[1:step - 1] AS before
          FROM orders, range(1, 6) AS r(step)),
figures AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(bad) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM (SELECT *, contains(fails, own) AS hit, before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone
        FROM cells, steps)
  GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM figures
"""

ORACLES["op12_merkle_manifest"] = r"""
WITH RECURSIVE crc AS (  -- the reflected polynomial, eight shifts a byte
  SELECT list(list_reduce([b] || list_value(0, 0, 0, 0, 0, 0, 0, 0),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS b)),
d AS (
  SELECT doc_id, source, lang, n_chars, text,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
      lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1]))) AS crc32 FROM documents, crc),
parts AS (
  SELECT doc_id, source, crc32 % 5 = 0 AS tampered, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    list_reduce(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
      lambda v: CASE WHEN v IS NULL THEN '-' ELSE strlen(v)::VARCHAR || ':' || v END), lambda a, b: a || b) AS head
  FROM d),
leaves AS (
  SELECT doc_id, source, tampered, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text)::VARCHAR || ':' || text END) AS leaf,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(low)::VARCHAR || ':' || low END) AS low_leaf,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS n
  FROM parts),
tree AS (
  SELECT 0 AS level, source, place, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, source, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place))
  FROM tree WHERE n > 1 GROUP BY level, source, place // 16, n),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM tree WHERE n = 1),
forest AS (
  SELECT 0 AS level, place, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place))
  FROM forest WHERE n > 1 GROUP BY level, place // 16, n),
heights AS (SELECT source, max(level) AS height FROM tree GROUP BY source),
nodes AS (  -- the levels of the forest continue those of each source
  SELECT source, level, place, n, h FROM tree WHERE n > 1
  UNION ALL
  SELECT s.source, height + f.level, f.place, f.n, f.h
  FROM subroots s JOIN heights k ON s.source IS NOT DISTINCT FROM k.source, forest f WHERE f.n > 1),
steps AS (
  SELECT l.doc_id, l.source, height, l.place, s.place AS source_place, subroot
  FROM leaves l JOIN heights k ON l.source IS NOT DISTINCT FROM k.source JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
own AS (
  SELECT s.doc_id, s.source, r.level, CASE WHEN r.level < height THEN s.place ELSE source_place END
    // (16 ** CASE WHEN r.level < height THEN r.level ELSE r.level - height END)::BIGINT AS own
  FROM steps s JOIN (SELECT DISTINCT source, level FROM nodes) r ON s.source IS NOT DISTINCT FROM r.source),
runs AS (
  SELECT o.doc_id, o.level, coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place < own), '') AS left_side,
    coalesce(string_agg(n.h, '' ORDER BY n.place) FILTER (n.place > own), '') AS right_side
  FROM own o JOIN nodes n ON o.source IS NOT DISTINCT FROM n.source AND o.level = n.level AND o.own // 16 = n.place // 16
  GROUP BY o.doc_id, o.level),
fold AS (
  SELECT doc_id, 0 AS level, CASE WHEN tampered THEN low_leaf ELSE leaf END AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(left_side || h || right_side) FROM fold f JOIN runs r ON f.doc_id = r.doc_id AND f.level = r.level),
ends AS (SELECT doc_id, arg_max(h, level) AS folded_root FROM fold GROUP BY doc_id),
proof AS (SELECT doc_id, string_agg(left_side || right_side, '' ORDER BY level) AS siblings FROM runs GROUP BY doc_id)
SELECT l.doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN steps USING (doc_id) JOIN ends USING (doc_id) LEFT JOIN proof USING (doc_id),
  (SELECT h AS root FROM forest WHERE n = 1)
"""
ORACLES["op13_circulant_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * s >= 80 * (x.n + y.n - s)),
reach(a, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.a)
SELECT d.doc_id, coalesce(any_value(k.n), 0)::BIGINT AS n_shingles, min(c) AS component_id, d.doc_id = min(c) AS kept
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN sizes k ON k.doc_id = d.doc_id GROUP BY d.doc_id
"""
