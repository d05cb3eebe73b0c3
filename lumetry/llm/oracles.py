"""The registered queries of this package in plain SQL, where SQL can express them."""

from __future__ import annotations

from .licenses import TEMPLATES

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

ORACLES: dict[str, str] = {}

ORACLES["op10_fm_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, n, list_slice(words, k, k + n - 1) AS phrase
  FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS k
        FROM (SELECT item_id, words, least(10, len(words)) AS n FROM items) WHERE n > 0)),
windows AS (
  SELECT doc_id, n, k, list_slice(words, k, k + n - 1) AS phrase
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS k
        FROM docs CROSS JOIN (SELECT DISTINCT n FROM phrases) WHERE len(words) >= n)),
found AS (SELECT doc_id, k, n, item_id FROM windows JOIN phrases USING (n, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS word FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""



def _crc(table: str, key: str) -> str:
    """CRC-32 of the text of a key. DuckDB has none: its table of 256 remainders is made here, and each byte folded in."""
    return f"""
crc_table AS (
  SELECT list(value ORDER BY byte) AS crcs
  FROM (SELECT byte, list_reduce(list_prepend(CAST(byte AS BIGINT), range(0, 8)),
          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
        FROM (SELECT unnest(range(0, 256)) AS byte))),
crc AS (
  SELECT {key}, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(id, ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, crcs[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT {key}, CAST({key} AS VARCHAR) AS id FROM {table}) CROSS JOIN crc_table)"""


ORACLES["op2_merkle_fixity"] = f"""
WITH {_crc('pages', 'page_id')},
archive AS (
  SELECT page_id, html, CAST(floor(page_id / 4096.0) AS BIGINT) AS file,
    strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
      || CAST(page_id AS VARCHAR) || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS length
  FROM pages),
placed AS (
  SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_
  FROM archive)
SELECT file, page_id AS record_id, offset_ AS "offset", CAST(length AS BIGINT) AS length, 'corrupt' AS status
FROM placed JOIN crc USING (page_id)
WHERE (crc % 97 = 0 AND length(html) > 0) OR (crc % 97 = 1 AND html <> repeat(' ', CAST(strlen(html) AS BIGINT)))
"""

ORACLES["op8_extendible_hashing"] = """
WITH hashed AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash,
    CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes
  FROM documents),
levels AS (
  SELECT doc_id, n_bytes, hash, depth, hash >> (60 - depth) AS prefix,
    sum(n_bytes) OVER (PARTITION BY depth, hash >> (60 - depth)) AS bucket
  FROM hashed CROSS JOIN (SELECT unnest(range(0, 61)) AS depth)),
chosen AS (SELECT doc_id, n_bytes, hash, min(depth) AS depth FROM levels WHERE bucket <= 1048576 OR depth = 60 GROUP BY ALL)
SELECT doc_id, right(lpad(bin(hash), 60, '0')[1:depth], depth) AS shard, CAST(depth AS INTEGER) AS depth,
  CAST(0 AS BIGINT) AS page, n_bytes
FROM chosen
"""

_TEMPLATES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)

ORACLES["op6_license_scan"] = f"""
WITH templates(license, text) AS (VALUES {_TEMPLATES}),
texts AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 't', license, text FROM templates),
words AS (SELECT kind, id, regexp_extract_all(lower(text), '[a-z0-9]+') AS words FROM texts),
shingles AS (
  SELECT DISTINCT kind, id, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2] AS shingle
  FROM (SELECT kind, id, words, unnest(range(1, len(words) - 1)) AS k FROM words)),
sizes AS (SELECT id AS license, count(*) AS n FROM shingles WHERE kind = 't' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, t.id AS license, count(*) AS n_shared
  FROM shingles d JOIN shingles t USING (shingle) WHERE d.kind = 'd' AND t.kind = 't' GROUP BY ALL)
SELECT CAST(doc_id AS BIGINT) AS doc_id, license, CAST(n_shared AS BIGINT) AS n_shared,
  CAST(n_shared AS DOUBLE) / n AS containment
FROM shared JOIN sizes USING (license) WHERE CAST(n_shared AS DOUBLE) / n >= 0.8
"""

ORACLES["op12_prefix_trie"] = f"""
WITH {_crc("conversations", "conv_id")},
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
    concat(length(coalesce(role, '')), ' ', coalesce(role, ''), coalesce(text, '')) AS turn,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations),
own AS (SELECT conv_id, list(turn ORDER BY place) AS turns, list(words ORDER BY place) AS words FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:c.crc % 4], []), o.turns[c.crc % 4 + 1:]) AS turns,
    list_concat(coalesce(b.words[1:c.crc % 4], []), o.words[c.crc % 4 + 1:]) AS words
  FROM own o JOIN crc c USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
members AS (
  SELECT conv_id, depth, turns[1:depth] AS path, len(turns) AS size, CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words, max(size) AS longest,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = size), '') AS ends
  FROM members GROUP BY path, depth),
below AS (
  SELECT path[1:top] AS path, top AS depth, count(*) FILTER (WHERE longest = depth) AS n_leaves, sum((n_convs - 1) * words) AS saved,
    count(*) FILTER (WHERE depth = top + 1) AS n_children
  FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM nodes) GROUP BY ALL)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below USING (path, depth) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""

# Words six of which are the same some words on are in a run, if it goes on for a period more and for twelve words at least.
ORACLES["op11_periodic_runs"] = f"""
WITH {_crc("documents", "doc_id")},
given AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS given, crc // 10 AS g, crc % 10 = 0 AS chosen
  FROM documents JOIN crc USING (doc_id)),
placed AS (
  SELECT *, len(given) AS n, CASE WHEN len(given) > 0 THEN g % len(given) END AS a FROM given),
texts AS (
  SELECT doc_id, n, CASE WHEN chosen AND n > 0
    THEN list_transform(range(0, n), lambda i: given[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1])
    ELSE given END AS words
  FROM placed),
grams AS (
  SELECT doc_id, i, hash(words[i + 1], words[i + 2], words[i + 3], words[i + 4], words[i + 5], words[i + 6]) AS gram
  FROM (SELECT doc_id, words, unnest(range(0, n - 5)) AS i FROM texts)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS period FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
stretches AS (
  SELECT doc_id, period, min(i) AS start, max(i) + 6 + period - min(i) AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, period, island HAVING max(i) + 6 + period - min(i) >= greatest(12, 2 * period)),
runs AS (SELECT doc_id, start, length, min(period) AS period FROM stretches GROUP BY ALL),
listed AS (
  SELECT doc_id, count(*) AS n_runs, first(start ORDER BY length DESC, start, period) AS start, max(length) AS length,
    first(period ORDER BY length DESC, start, period) AS period,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
dropped AS (
  SELECT doc_id, list(DISTINCT word) AS gone
  FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS word FROM runs) GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS collapsed
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(0, n)) AS i FROM texts) t
  LEFT JOIN (SELECT doc_id, unnest(gone) AS i, true AS is_gone FROM dropped) d ON d.doc_id = t.doc_id AND d.i = t.i
  WHERE is_gone IS NULL GROUP BY t.doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
