"""SQL for the operators that it can express, over the same whole tables.

Not expressed: packing (2), the neural model (4), jump hashing of Spark's hash (5),
keyed surrogates (6), byte-pair merges (7), quantile sketches (9) and compression
(10); tests compare those with plain versions, the tokenizer library, or held-out
documents.
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = f"list_filter(string_split_regex({_LOWER}, '[ \\t\\n\\v\\f\\r]+'), lambda w: w <> '')"
_LETTERED = f"list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


def _window(size):
    return f"array_to_string(list_slice(words, i, i + {size} - 1), ' ')"


NEAR_DUPLICATES = f"""
WITH RECURSIVE split AS (SELECT doc_id, {_SPACED} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, {_window(5)} AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
          FROM split WHERE len(words) > 0))),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * pairs.n >= 75 * (sa.n + sb.n - pairs.n)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

CAPTURES = """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
judged AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS newest FROM payloads)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < newest THEN newest END AS refers_to,
  url, TRUE AS has_request, TRUE AS has_metadata
FROM judged"""

CONTAMINATION = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_LETTERED} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, {_window("size")} AS win
  FROM (SELECT item_id, words, least(10, len(words)) AS size,
          unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i
        FROM item_words WHERE len(words) > 0)),
doc_words AS (SELECT doc_id, {_LETTERED} AS words FROM documents),
places AS (
  SELECT doc_id, i, size, {_window("size")} AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM doc_words JOIN (SELECT DISTINCT size FROM windows) ON len(words) >= size)),
found AS (SELECT p.doc_id, p.i, p.size, w.item_id FROM places p JOIN windows w ON w.win = p.win AND w.size = p.size),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

NEGATIVES = """
WITH valid AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
    CAST(list_dot_product(a.vector, c.vector) AS BIGINT) AS score
  FROM valid a JOIN valid c ON a.r <> c.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS place
  FROM scores WHERE same AND other_id <> anchor_id QUALIFY place <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
  AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
QUALIFY rank <= 10"""

# CRC-32 of the decimal digits of an id, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

RUNS = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, {_CRC32} AS h,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'), lambda w: w <> '') AS words
  FROM documents),
measured AS (SELECT *, len(words) AS n, h // 10 AS g FROM split),
placed AS (SELECT *, g % greatest(n, 1) AS a FROM measured),
tiled AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
      list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE words END AS words
  FROM placed),
grams AS (
  SELECT r, n, i, array_to_string(list_slice(words, i + 1, i + 3), ' ') AS gram
  FROM (SELECT r, n, words, unnest(range(n - 2)) AS i FROM tiled WHERE n >= 6)),
apart AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i
  WHERE 4 * (y.i - x.i) <= x.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM apart),
stretches AS (SELECT r, q, min(i) AS start, count(*) + 2 + q AS length FROM islands GROUP BY r, q, island),
runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches
  WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM runs GROUP BY r),
best AS (
  SELECT * FROM runs
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) = 1),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT r, unnest(words) AS word, unnest(range(n)) AS i FROM tiled),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM tiled t LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""

ORACLE = {
    "op1_near_duplicates": NEAR_DUPLICATES,
    "op3_warc_captures": CAPTURES,
    "op8_decontamination": CONTAMINATION,
    "op11_hard_negatives": NEGATIVES,
    "op12_periodic_runs": RUNS,
}
