"""DuckDB SQL that gives the same rows as the queries."""

from __future__ import annotations

CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *,
    length(text) + length(text) - length(replace(text, chr(92), ''))
      + length(regexp_replace(text,
          '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>', '\0~', 'g'))
      - length(text)
      + length(role) + length(role) - length(regexp_replace(role, '[\\<\[\n]', '', 'g'))
      + length('<|im_start|>') + 1 + length('<|im_end|>') + 1 AS chars
  FROM turns
), ordered AS (
  SELECT *,
    sum(chars) OVER w AS so_far,
    row_number() OVER w AS place,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(so_far) FILTER (role = 'assistant' OR place = n), 0)::BIGINT AS formatted_chars
FROM ordered GROUP BY conv_id
"""

_STOP = (
    "the of and to in a is that for it as was with be by on not he his at are this "
    "der die das und zu den von mit sich des auf für ist im dem nicht ein eine "
    "le la les de et un une des du en que qui dans pour par sur au est "
    "el los las y del se por con para una es lo como"
)

#: Base measures and the verdict of the default rules.
QUALITY_CTES = rf"""
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM docs)
), windows AS (
  SELECT *, lead(word, 1) OVER o AS second, lead(word, 2) OVER o AS third
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), again AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, second, third) AS times
  FROM windows WHERE third IS NOT NULL
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (VALUES (0), (1), (2)) AS offsets(k) WHERE times > 1 GROUP BY doc_id
), by_word AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
    count(*) FILTER (list_contains(string_split('{_STOP}', ' '), lower(word))) AS n_stop_words
  FROM words GROUP BY doc_id
), lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), by_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (regexp_matches(line, '^[\x20\x09]*[-*•‣]')) AS n_bullet_lines,
    count(*) FILTER (regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*$')) AS n_ellipsis_lines
  FROM lines GROUP BY doc_id
), measured AS (
  SELECT d.doc_id,
    coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_stop_words, 0) AS n_stop_words, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_bullet_lines, 0) AS n_bullet_lines, coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines
  FROM docs d LEFT JOIN by_word USING (doc_id) LEFT JOIN by_line USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    word_chars >= 2 * n_words AND word_chars <= 16 * n_words AND n_symbols <= 0.5 * n_words
      AND n_stop_words >= 2 AND n_dup_lines <= 0.5 * n_lines
      AND n_bullet_lines <= 0.9 * n_lines AND n_ellipsis_lines <= 0.5 * n_lines AS shaped
  FROM measured
)
"""

QUALITY_SQL = rf"""
WITH docs AS (SELECT doc_id, text FROM documents), {QUALITY_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND shaped AS kept
FROM judged
"""

FILTERS_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1
), toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1
), marked AS (
  SELECT part,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END AS bits,
    doc_id IN (SELECT doc_id FROM good WHERE doc_id IS NOT NULL) AS good,
    doc_id IN (SELECT doc_id FROM toxic WHERE doc_id IS NOT NULL) AS toxic
  FROM docs
), counted AS (
  SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marked GROUP BY part, bits
), letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)
), orders AS (
  SELECT [a.letter, b.letter, c.letter, d.letter, e.letter] AS names, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
  JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), steps AS (
  SELECT array_to_string(names, '') AS filter_order, step::INTEGER AS step, names[step] AS filter, bits[step] AS own,
    coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM orders, range(1, 6) AS r(step)
), shares AS (
  SELECT part, bit AS own, sum(n * 120 // bit_count(bits))::BIGINT AS shapley
  FROM counted, letters WHERE bits & bit <> 0 GROUP BY part, bit
), audited AS (
  SELECT part, filter_order, step, filter, own,
    sum(CASE WHEN bits & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN bits & own <> 0 AND bits & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN bits & own <> 0 AND bits & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, filter, own
)
SELECT part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  coalesce(shapley, 0) AS shapley
FROM audited LEFT JOIN shares USING (part, own)
"""
