from __future__ import annotations

from lanewise.catalog import query
from lanewise.operators import corpus as X
from lanewise.operators.governance import html_text as html_to_text
from lanewise.sources.tables import load

WORDS_SQL = r"SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM documents"


@query(
    "scrub_characters",
    """
    SELECT doc_id, translate(text, '.,;:', '') AS text,
           length(text) - length(translate(text, '.,;:', '')) AS n_removed
    FROM documents
    """,
)
def scrub_characters(spark, sf_dir):
    rows = X.scrub(load(spark, sf_dir, "documents"), "text", ".,;:")
    return rows.selectExpr("doc_id", "text", "cast(n_removed as bigint) as n_removed")


@query(
    "char_histogram",
    """
    SELECT lang, ch, count(*) AS n FROM (
      SELECT lang, unnest(string_split(text, '')) AS ch FROM documents)
    WHERE ch <> '' GROUP BY lang, ch
    """,
)
def char_histogram(spark, sf_dir):
    return X.char_histogram(load(spark, sf_dir, "documents"), "text", ["lang"])


@query(
    "reversed_host",
    r"""
    SELECT array_to_string(list_reverse(string_split(
             lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '.')), '.') AS host_key,
           count(*) AS pages
    FROM pages GROUP BY 1
    """,
)
def reversed_host(spark, sf_dir):
    return X.reversed_host(load(spark, sf_dir, "pages"), "url")


@query(
    "bracket_quality",
    r"""
    WITH RECURSIVE b AS (
      SELECT doc_id, lang, regexp_replace(text, '[^()\[\]{}]', '', 'g') AS s FROM documents),
    r AS (
      SELECT doc_id, lang, s AS start, s, 0 AS step FROM b
      UNION ALL
      SELECT doc_id, lang, start, regexp_replace(s, '\(\)|\[\]|\{\}', '', 'g'), step + 1 FROM r
      WHERE regexp_matches(s, '\(\)|\[\]|\{\}')),
    last AS (SELECT doc_id, lang, arg_max(s, step) AS s, any_value(start) AS start
             FROM r GROUP BY doc_id, lang)
    SELECT lang, count(*) AS n_rows, count(*) FILTER (start <> '') AS with_brackets,
           count(*) FILTER (s <> '') AS unbalanced
    FROM last GROUP BY lang
    """,
)
def bracket_quality(spark, sf_dir):
    return X.unbalanced(load(spark, sf_dir, "documents"), "text", ["lang"])


def _words(spark, sf_dir):
    return X.tokens(load(spark, sf_dir, "documents"), "text")


def _classes_sql(key: str) -> str:
    return f"""
    WITH d AS (SELECT DISTINCT token FROM ({WORDS_SQL})),
         k AS (SELECT token, {key} AS class_key FROM d),
         c AS (SELECT class_key, count(*) AS class_size, min(token) AS first_word
               FROM k GROUP BY class_key HAVING count(*) >= 2)
    """


_LETTERS = "array_to_string(list_sort(string_split(token, '')), '')"
_TURN = (
    "list_min(list_transform(range(1, length(token) + 1),"
    " lambda i: substr(token, i) || substr(token, 1, i - 1)))"
)


@query(
    "anagram_pairs",
    _classes_sql(_LETTERS)
    + "SELECT first_word AS a, token AS b FROM k JOIN c USING (class_key) WHERE token > first_word",
)
def anagram_pairs(spark, sf_dir):
    return X.anagram_pairs(_words(spark, sf_dir), "token")


@query(
    "anagram_groups",
    _classes_sql(_LETTERS)
    + "SELECT class_key, class_size, token FROM k JOIN c USING (class_key)",
)
def anagram_groups(spark, sf_dir):
    return X.anagram_groups(_words(spark, sf_dir), "token", min_size=2)


@query(
    "rotation_pairs",
    _classes_sql(_TURN)
    + "SELECT first_word AS a, token AS b FROM k JOIN c USING (class_key) WHERE token > first_word",
)
def rotation_pairs(spark, sf_dir):
    return X.rotation_pairs(_words(spark, sf_dir), "token")


@query(
    "palindrome_tokens",
    f"""
    SELECT token, count(*) AS n FROM ({WORDS_SQL})
    WHERE length(token) >= 3 AND token = reverse(token) GROUP BY token
    """,
)
def palindrome_tokens(spark, sf_dir):
    return X.palindromes(_words(spark, sf_dir), "token", min_len=3)


HTML_SQL = r"""
WITH bare AS (
  SELECT page_id,
    regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
    regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'),
      '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title[^>]*>.*?</title>', ' ', 'g') AS body
  FROM pages
), said AS (
  SELECT page_id, 'title' AS part, title AS t FROM bare
  UNION ALL SELECT page_id, 'text', regexp_replace(body, '<([^<>"'']|"[^"]*"|''[^'']*'')*>', ' ', 'g') FROM bare
), plain AS (
  SELECT page_id, part, trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(t,
      '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'),
    '[ \t\r\n]+', ' ', 'g')) AS t
  FROM said
)
SELECT page_id, max(t) FILTER (part = 'title') AS title, max(t) FILTER (part = 'text') AS text
FROM plain GROUP BY page_id
"""


@query("html_text", HTML_SQL)
def html_text(spark, sf_dir):
    return html_to_text(load(spark, sf_dir, "pages")).select("page_id", "title", "text")
