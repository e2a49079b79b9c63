"""SQL for the queries that SQL can express, to be run by DuckDB on the same tables."""

# words as bytes.split() cuts them, after lower-casing A-Z only
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')")

NGRAM_JOIN = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_distinct(
  [w[i:i + 4] FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
class AS (SELECT s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM class),
meet AS (SELECT a.rep AS u, b.rep AS v, a.n AS na, b.n AS nb, count(*) AS c
  FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep
   AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n GROUP BY ALL),
links AS (SELECT u, v FROM meet WHERE 100 * c >= 75 * (na + nb - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT u, u AS v FROM both_ways UNION SELECT r.u, e.v FROM reach r JOIN both_ways e
  ON r.v = e.u),
label AS (SELECT u, min(v) AS label FROM reach GROUP BY u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
  CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE coalesce(l.label, c.rep) END AS component_id
FROM sets s LEFT JOIN class c ON s.s = c.s LEFT JOIN label l ON l.u = c.rep
"""

_ESCAPED = (r"regexp_replace(text, '(\\|\[/ROLE\]|\[/INST\]|<</SYS>>|<<SYS>>|\[ROLE=|\[INST\]|</s>"
            r"|<s>|\])', '\\\1', 'g')")

CHAT_FORMATTING = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
  (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) x),
placed AS (SELECT *, lag(role) OVER o AS prior, row_number() OVER o AS pos,
  count(*) OVER (PARTITION BY conv_id) AS n, length({_ESCAPED}) + CASE role WHEN 'user' THEN 15
  WHEN 'system' THEN 15 ELSE 7 END AS chars FROM turns
  WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN prior IS NULL THEN role IN ('system', 'user')
    WHEN prior IN ('system', 'assistant') THEN role = 'user' ELSE role = 'assistant' END
    AND (pos < n OR role = 'assistant')) AS in_order
FROM placed GROUP BY conv_id
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, CAST(from_hex(sha1(html)) AS BIT)::VARCHAR AS bits,
  max(page_id) OVER (PARTITION BY html) AS kept FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum([
    (substr(bits, 5 * i + k + 1, 1) = '1')::INT * (16 >> k::INT) FOR k IN range(5)]) AS BIGINT), 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM d
"""

MIXING = """
WITH docs AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
  ('0x' || substr(md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM documents),
sources AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY k),
weighed AS (SELECT *, [3e0, 1e0, 2e0][1 + (row_number() OVER (ORDER BY k) - 1) % 3] AS weight,
  source_size * 2e0 AS cap FROM sources),
levels AS (SELECT *, (sum(source_size) OVER () * 1.5e0 - coalesce(sum(cap) OVER before, 0e0))
  / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0e0)) AS level FROM weighed
  WINDOW before AS (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (SELECT k, source_size, least(cap, weight * max(level) OVER ()) AS target FROM levels),
steps AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(least(8589934592e0,
  floor(target / source_size * 4294967296e0 + 0.5e0)) AS HUGEINT) ELSE 0 END AS step,
  ('0x' || substr(md5('42|offset|' || k), 1, 8))::HUGEINT AS start FROM aims),
placed AS (SELECT *, start + sum(step) OVER (PARTITION BY k ORDER BY CASE WHEN size < 32 THEN size
  ELSE length(bin(size)) * 32 + (size >> greatest(length(bin(size)) - 5, 0)) END, h, size, doc_id NULLS FIRST
  ROWS UNBOUNDED PRECEDING) AS reach FROM docs JOIN steps USING (k))
SELECT doc_id, size, source_size, target,
  CAST(size * (reach // 4294967296 - (reach - step) // 4294967296) AS BIGINT) AS taken FROM placed
"""

LLM_CHECKS = {"op1_ngram_join": NGRAM_JOIN, "op4_chat_formatting": CHAT_FORMATTING,
              "op10_warc": WARC, "op12_mixing": MIXING}
