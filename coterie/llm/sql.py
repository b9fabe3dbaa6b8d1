"""The queries' results as DuckDB SQL."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS key
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST([3, 1, 2][(place - 1) % 3 + 1] AS DOUBLE) AS weight,
    CAST(source_size AS DOUBLE) * 2 AS most,
    CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS budget
  FROM totals),
levels AS (
  SELECT *, most / weight AS ratio, (budget - coalesce(sum(most) OVER (
      ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (
      ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size, least(most, weight * coalesce((
      SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio), ratio)) AS target
  FROM levels),
summed AS (
  SELECT s.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS words,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
    words // source_size * size + greatest(0, least(words % source_size - before, size)) END
  AS BIGINT) AS taken
FROM summed"""

LINE_DEDUP_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{UPPER}', '{LOWER}') AS key
  FROM lines),
firsts AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id > first_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
    FILTER (WHERE first_id IS NULL OR doc_id <= first_id), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (key) GROUP BY doc_id"""

_SCORES = "list_transform(range({n}), lambda j: -ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) "
_SCORES += "|| '#' || j), 1, 15) AS BIGINT) + 0.5) / 1152921504606846976.0))"


def _shard(n: int) -> str:
    scores = _SCORES.format(n=n)
    return f"CAST(list_position({scores}, list_min({scores})) - 1 AS INTEGER)"


# CRC-32 by bytes; the table of 256 remainders comes from its rule, eight halvings of each byte.
_REMAINDERS = """remainders AS (
  SELECT list(r ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(range(8), lambda r, i:
        CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, b) AS r
    FROM range(256) t(b)))"""


def _crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode({text})), '..'),
        lambda x: CAST('0x' || x AS BIGINT)),
      lambda r, x: xor(r >> 8, crc[(xor(r, x) & 255) + 1]), 4294967295))"""


SHARDING_SQL = f"""
WITH {_REMAINDERS},
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    {_crc32("coalesce(text, '')")} AS text_crc32,
    {_shard(16)} AS shard, {_shard(17)} AS grown_shard
  FROM documents, remainders)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32,
  'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot
FROM sized"""

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION_SQL = f"""
WITH doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(len(w), 13) AS m
  FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, m, array_to_string(w[p:p + m - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM item_words)),
doc_windows AS (
  SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS words
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p
    FROM doc_words, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)),
found AS (SELECT doc_id, p, m, item FROM doc_windows JOIN windows USING (m, words)),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + m)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

JACCARD_JOIN_SQL = f"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p
    FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM both_ways
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.component, d.doc_id) AS component_id
FROM doc_words d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id) r USING (doc_id)"""


SPELLING_SQL = f"""
WITH RECURSIVE {_REMAINDERS},
runs AS (
  SELECT id, run, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
      unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
numbered AS (SELECT run, n, {_crc32("id || ':' || run")} AS h FROM runs, remainders),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM numbered)
  GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM cuts SEMI JOIN words w ON rest = w.word
  UNION SELECT rest, word FROM cuts SEMI JOIN words w ON rest = w.word),
best AS (
  SELECT near.word, count(*) AS n_near,
    first(struct_pack(form := other, form_n := w.n) ORDER BY w.n DESC, other) AS top
  FROM near JOIN words w ON other = w.word GROUP BY near.word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top.form_n >= 5 * n THEN top.form END AS form,
    CASE WHEN top.form_n >= 5 * n THEN top.form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
followed AS (
  SELECT word, word AS root, form AS further FROM forms
  UNION ALL
  SELECT f.word, g.word, g.form FROM followed f JOIN forms g ON f.further = g.word)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, root FROM followed WHERE further IS NULL) USING (word)"""
