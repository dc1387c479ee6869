"""The registered queries in SQL, for those that SQL can express."""

from tidewatch.llm import secrets

OP6 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[i:i + least(len(words), 13) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS i
        FROM items WHERE len(words) > 0)),
doc_windows AS (
  SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)),
hits AS (SELECT r, i, n, item_id FROM doc_windows JOIN item_windows USING (n, w)),
counted AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
found AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN counted USING (r) LEFT JOIN found USING (r)"""

OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
repeated AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(range(i, i + 8)) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS k FROM grams) WHERE k > 1) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_distinct(words)) AS n_distinct,
         length(text) - length(replace(text, '!', '')) AS n_exclamations,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN repeated USING (r)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 2 * n_symbols > n_words OR 2 * n_exclamations > n_words OR 2 * n_capitals > word_chars
            OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_distinct < n_words) AS kept
FROM v"""


OP5 = r"""
WITH RECURSIVE p AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS html,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT r, page_id, html, rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM u),
judged AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 2 WHEN rule IS NOT NULL THEN 1 END AS own FROM ruled),
tags AS (
  SELECT r, host AS base, unnest(list_filter(regexp_extract_all(html, '<(?i:link|meta)\b[^>]*>'), lambda t:
    regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b|\bhttp-equiv\s*=\s*["'']?refresh\b'))) AS tag FROM u),
targets AS (
  SELECT r, base, coalesce(nullif(regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1), ''),
           nullif(regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1), '')) AS t FROM tags),
named AS (
  SELECT r, 'page' AS what, rest FROM u
  UNION ALL
  SELECT r, 'link', CASE WHEN strpos(a, '://') > 0 THEN substr(a, strpos(a, '://') + 3) ELSE '' END
  FROM (SELECT r, CASE WHEN t LIKE '//%' THEN 'http:' || t WHEN t LIKE '/%' THEN 'http://' || base || t ELSE t END AS a
        FROM targets)),
addresses AS (
  SELECT r, what, nullif(regexp_replace(regexp_replace(translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', ''), '\.$', ''), '') AS name,
         regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda q:
           q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|ref|fbclid|gclid|msclkid|mc_cid|mc_eid)(=|$)'))), '&') AS q
  FROM named),
nodes AS (
  SELECT r, what, name || path || CASE WHEN q = '' THEN '' ELSE '?' || q END AS node FROM addresses WHERE name IS NOT NULL),
edges AS (
  SELECT a.node AS x, b.node AS y FROM nodes a JOIN nodes b USING (r) WHERE a.what = 'page' AND b.what = 'link'),
both_ways AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
reach AS (
  SELECT node AS x, node AS y FROM nodes
  UNION
  SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x),
inherited AS (
  SELECT reach.x AS node, max(own) AS own
  FROM reach JOIN nodes ON nodes.node = reach.y AND nodes.what = 'page' JOIN judged USING (r) GROUP BY 1)
SELECT page_id, host, path, rule,
       CASE coalesce(judged.own, inherited.own, 2) WHEN 1 THEN 'block' ELSE 'allow' END AS verdict
FROM judged LEFT JOIN nodes ON nodes.r = judged.r AND nodes.what = 'page' LEFT JOIN inherited USING (node)"""

OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
raw AS (SELECT r, doc_id, coalesce(text, '') AS text, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
tokens AS (
  SELECT r, doc_id, text, pos, line, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda t: t <> '') AS plain
  FROM raw),
lines AS (
  SELECT r, doc_id, text, pos, plain, len(plain) AS n,
         list_transform(plain, lambda t: regexp_replace(t, '[^ 0-9]*[0-9][^ ]*', '<*>', 'g')) AS t FROM tokens),
cut AS (
  SELECT *, CASE WHEN n >= 12 THEN [t[1:2 * n // 3] + ['<*>'], t[1:n // 3] + ['<*>'] + t[2 * n // 3 + 1:]]
    ELSE [t[1:n - n // 4] + ['<*>'], t[1:(n - n // 4) // 2] + ['<*>'] + t[(n - n // 4) // 2 + n // 4 + 1:]] END AS fields
  FROM lines WHERE n >= 4),
enough AS (
  SELECT *, list_filter(fields, lambda f: 2 * len(list_filter(f, lambda x: x <> '<*>')) > n) AS held FROM cut),
keyed AS (
  SELECT r, doc_id, text, pos, n, unnest(CASE WHEN len(held) > 0 THEN list_transform(held, lambda f: array_to_string(f, ' '))
    WHEN 2 * len(list_filter(t, lambda x: x <> '<*>')) > n THEN [array_to_string(t, ' ')]
    ELSE [array_to_string(plain, ' ')] END) AS template FROM enough),
recurring AS (
  SELECT n, template, min({'doc_id': doc_id, 'pos': pos}) AS first FROM keyed GROUP BY n, template
  HAVING count(DISTINCT {'doc_id': doc_id, 'text': text}) >= CASE WHEN n >= 12 THEN 3 ELSE 10 END),
dropped AS (
  SELECT r, pos FROM keyed JOIN recurring USING (n, template) GROUP BY r, pos
  HAVING NOT bool_or(doc_id = first.doc_id AND pos = first.pos))
SELECT any_value(doc_id) AS doc_id, greatest(count(*) - count(dropped.pos), 1) AS n_lines,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (dropped.pos IS NULL), '')) AS text_sha256
FROM tokens LEFT JOIN dropped USING (r, pos) GROUP BY r"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * k >= 75 * (a.n + b.n - k)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d
  UNION
  SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x),
components AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


def op8() -> str:
    """Each rule's matches with their places: lengths of what lies between matches and of the matches before."""
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT r, {rank} AS rank, '{rule.kind}' AS kind, s AS start, s + length(m) AS stop FROM (
    SELECT r, m, v, coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0)
             + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0) AS s FROM (
      SELECT r, gaps, found, unnest(found) AS m, unnest(vals) AS v, generate_subscripts(found, 1) AS i FROM (
        SELECT r, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found,
               regexp_extract_all(text, '{pattern}', {rule.group}) AS vals FROM d)))
  WHERE length(v) >= {rule.least}""")
    said = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(parts)}),
said AS (
  SELECT r, {said} AS spans, {said} FILTER (rank < 3) AS base, count_if(rank = 0) AS n_assign,
         count_if(rank = 1) AS n_access, count_if(rank = 2) AS n_hex
  FROM (SELECT r, rank, kind, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM found) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN said USING (r)"""


OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
           lambda w: w <> '') AS words FROM documents),
q AS (
  SELECT DISTINCT i, item_id, unnest(words) AS term FROM (
    SELECT row_number() OVER () AS i, item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
             lambda w: w <> '') AS words FROM benchmark)),
corpus AS (SELECT count(*) AS docs, CAST(sum(len(words)) AS BIGINT) AS length FROM d WHERE len(words) > 0),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term),
shares AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))) AS share
  FROM tf JOIN w USING (term), corpus),
scores AS (
  SELECT i, item_id, r, doc_id, CAST(sum(share) AS BIGINT) AS score FROM shares JOIN q USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""

SQL = {
    "op5_urls": OP5,
    "op6_decontaminate": OP6,
    "op7_lines": OP7,
    "op8_secrets": op8(),
    "op9_quality": OP9,
    "op10_near_duplicates": OP10,
    "op13_search": OP13,
}
