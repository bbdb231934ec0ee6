"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host,
         coalesce(text, '') AS t FROM documents),
l AS (
  SELECT r, host, line,
         list_filter(string_split(translate(line, chr(9) || chr(11) || chr(12) || chr(13),
                     '    '), ' '), lambda w: w <> '') AS ws
  FROM (SELECT r, host, unnest(string_split(t, chr(10))) AS line FROM d)),
lw AS (
  SELECT r, host, line, len(ws) AS words,
         translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789',
                   'abcdefghijklmnopqrstuvwxyz0000000000') AS key
  FROM l WHERE len(ws) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY r),
same AS (SELECT r, dense_rank() OVER (ORDER BY ks) AS doc
         FROM (SELECT r, list_sort(list(DISTINCT key)) AS ks FROM lw GROUP BY r)),
often AS (
  SELECT host, key FROM (
    SELECT host, key, count(DISTINCT doc) AS docs FROM lw JOIN same USING (r) GROUP BY host, key)
  JOIN (SELECT host, count(*) AS n FROM d GROUP BY host) USING (host)
  WHERE docs > 20 AND docs > n * 0.001::DOUBLE),
gone AS (SELECT r, sum(words) AS words FROM lw JOIN often USING (host, key) GROUP BY r),
w AS (
  SELECT r, doc_id, t,
         list_filter(string_split(translate(t, chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
                     '     '), ' '), lambda w: w <> '') AS ws
  FROM d),
tri AS (
  SELECT r, i, w || ' ' || lead(w, 1) OVER s || ' ' || lead(w, 2) OVER s AS win
  FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w)
  WINDOW s AS (PARTITION BY r ORDER BY i)),
rep AS (
  SELECT r, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (
    SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM (
      SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM tri WHERE win IS NOT NULL)
    WHERE c > 1)
  GROUP BY r),
base AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_words,
         length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT
           AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.words, 0)::BIGINT AS removed_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_words - removed_words >= 0.5::DOUBLE * n_words AS kept
FROM base
"""

WARC = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest,
         row_number() OVER () AS r FROM pages),
f AS (
  SELECT *, first_value(page_id) OVER w AS first_page, row_number() OVER w AS k
  FROM p WINDOW w AS (PARTITION BY payload_digest, payload_bytes ORDER BY page_id NULLS LAST, r))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND k > 1 THEN first_page END AS refers_to
FROM f
"""

URLS = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    count(*) OVER (PARTITION BY host, path) AS n,
    min(page_id) OVER (PARTITION BY host, path) AS first_page
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host <> '' AND n > 1 AND page_id IS DISTINCT FROM first_page THEN 'block'
            ELSE 'allow' END AS verdict
FROM r
"""
