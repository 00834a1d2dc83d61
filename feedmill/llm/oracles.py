"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from feedmill.llm.url_filter import default_list

_SPACE = r"[\x20\x09-\x0D]"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM p LEFT JOIN f USING (payload_digest)"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
t AS (SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT r, i, a || chr(1) || lead(a) OVER s || chr(1) || lead(a, 2) OVER s AS tri FROM t WINDOW s AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM g WHERE tri IS NOT NULL),
n AS (SELECT r, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM c, range(3) o(k) WHERE n > 1 GROUP BY 1),
b AS (SELECT doc_id, text, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{_SPACE}+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  len(lines) AS n_lines, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS upper, length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters,
  length(regexp_replace(text, '[^!]+', '', 'g')) AS bangs, len(regexp_extract_all(text, '(\.\.\.|…)[ \t]*(\n|$)')) AS open_ends, 1 + length(text) - length(replace(text, chr(10), '')) AS rows_
  FROM w LEFT JOIN n USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.1 * n_words + 2 OR word_chars < 2 * n_words OR word_chars > 16 * n_words OR 2 * n_dup_lines > n_lines OR 10 * n_repeat_words > 3 * n_words
       OR upper > 0.5 * letters OR bangs > 0.2 * n_words OR letters < 0.6 * word_chars OR open_ends > 0.3 * rows_) AS kept FROM f"""

_ENTRIES = ", ".join(f"('{u.partition('/')[0]}', '/{u.partition('/')[2]}')" for u in default_list())

URLS = rf"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*$', ''), '\.{{2,}}', '.', 'g'), '^\.|\.$', '', 'g') AS ch,
  CASE WHEN host = '' THEN '' WHEN path = '' THEN '/' ELSE path END AS cp FROM u),
l(h, p) AS (VALUES {_ENTRIES}),
f AS (SELECT r, arg_max(h || p, (length(h || p), h || p)) AS entry FROM c JOIN l ON (ch = h OR ends_with(ch, '.' || h)) AND starts_with(cp, p) GROUP BY r),
r AS (SELECT *, CASE WHEN regexp_matches(host, '(^|\.)example\.net$') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN regexp_matches(host, '(^|\.)example\.com$') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN regexp_matches(host, '(^|\.)org$') AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN regexp_matches(host, '(^|\.)net$') AND starts_with(path, '/') THEN 'net/' END AS rule FROM c LEFT JOIN f USING (r))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL OR entry IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN entry END AS listed FROM r"""
