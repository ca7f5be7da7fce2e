"""SQL statements (DuckDB) of the queries that SQL can express. The others need XXH64, CRC-32, a
tokenizer or a model, which SQL lacks; tests hold them against brute force instead."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = r"\x20\x09-\x0D"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lowered(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_UPPER.lower()}')"


CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
  FROM range(2) AS r(i)
), sized AS (
  SELECT *,
    4 + length(regexp_replace(role, '[\\:]', 'xx', 'g')) + 2
      + length(regexp_replace(text, '\\|###|</turn>|<\|', '\0x', 'g')) + 8 AS formatted
  FROM turns
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments
FROM sized GROUP BY conv_id
"""

URL_FILTER = f"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, {_lowered("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

HOST_QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^{_BLANK}]+') AS words
  FROM documents
), placed AS (
  SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM texts
), threes AS (
  SELECT r, i, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c
  FROM placed WINDOW w AS (PARTITION BY r ORDER BY i)
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times FROM threes WHERE c IS NOT NULL
), repeated AS (
  SELECT r, count(DISTINCT i + shift) AS n FROM windows, range(3) AS s(shift) WHERE times > 1 GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts
), dup_lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^{_BLANK}]') GROUP BY r
), counted AS (
  SELECT r, doc_id, source,
    CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(length(array_to_string(words, '')), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN dup_lines d USING (r) LEFT JOIN repeated p USING (r)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
), hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n,
    CAST(count(*) FILTER (base_failed) AS DOUBLE) AS failed
  FROM based GROUP BY source
), sums AS (
  SELECT count(*) AS hosts, sum(n) AS n, sum(failed) / sum(n) AS mean,
    sum(failed * failed / n) / sum(n) AS squares
  FROM hosts
), between_hosts AS (
  SELECT mean, mean * (1 - mean) AS spread,
    squares - mean * mean - mean * (1 - mean) * hosts / n AS v FROM sums
), prior AS (
  SELECT mean, least(greatest(CASE WHEN v > 0 THEN spread / v - 1 ELSE 1e6 END, 1.0), 1e6) AS k
  FROM between_hosts
), verdicts AS (
  SELECT source, (failed + mean * k) / (n + k) > 0.5 AS host_rejected FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR host_rejected) AS kept, host_rejected
FROM based b JOIN verdicts v ON b.source IS NOT DISTINCT FROM v.source
"""

DECONTAMINATE = rf"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all({_lowered("coalesce(text, '')")}, '{_WORD}') AS words FROM benchmark
), item_starts AS (
  SELECT item, words, least(len(words), 10) AS n,
    unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
  FROM items WHERE len(words) > 0
), grams AS (
  SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS gram FROM item_starts
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({_lowered("coalesce(text, '')")}, '{_WORD}') AS words FROM documents
), doc_starts AS (
  SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
  FROM docs, (SELECT DISTINCT n FROM grams) WHERE len(words) >= n
), hits AS (
  SELECT r, i, d.n, item
  FROM (SELECT r, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram FROM doc_starts) d
  JOIN grams USING (gram)
), hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


#: For pages that mark their article and hold nothing else in it, as those of the tables do.
HTML_EXTRACT = r"""
WITH articles AS (
  SELECT page_id, url,
    regexp_split_to_array(
      regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g'),
      '</?(?:p|h1)>') AS blocks
  FROM pages
), texts AS (
  SELECT page_id, url, array_to_string(
    list_filter(
      list_transform(blocks, lambda b: trim(regexp_replace(
        regexp_replace(replace(regexp_replace(b, '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'),
        '\s+', ' ', 'g'))),
      lambda b: b <> ''),
    chr(10)) AS text
  FROM articles
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
"""

HARD_NEGATIVES = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS score
  FROM usable a, usable b WHERE a.vec_id % 50 = 0 AND a.r <> b.r
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same
), negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
    p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor
  WHERE p.place <= 5 AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_chat_format": CHAT_FORMAT,
        "op3_url_filter": URL_FILTER,
        "op4_host_quality": HOST_QUALITY,
        "op5_decontaminate": DECONTAMINATE,
        "op11_html_extract": HTML_EXTRACT,
        "op12_hard_negatives": HARD_NEGATIVES,
    }
