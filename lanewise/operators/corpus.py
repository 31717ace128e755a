"""Text columns as table jobs: whole texts, one row per character or token only
where an aggregate needs it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.functions import strings as S
from lanewise.sources.tables import require


def tokens(df: DataFrame, text: str, alias: str = "token") -> DataFrame:
    """Lower-case runs of letters, one row each."""
    require(df, text)
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    return df.select(F.explode(words).alias(alias))


def scrub(df: DataFrame, text: str, chars: str) -> DataFrame:
    """Remove every given character; ``n_removed`` tells how many went."""
    require(df, text)
    cleaned = S.without(F.col(text), chars)
    return df.withColumns({text: cleaned, "n_removed": F.length(text) - F.length(cleaned)})


def char_histogram(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """How often each character occurs per group; case is kept."""
    require(df, text, *by)
    chars = df.select(*by, F.explode(S.characters(F.col(text))).alias("ch"))
    return chars.groupBy(*by, "ch").agg(F.count(F.lit(1)).alias("n"))


def reversed_host(df: DataFrame, url: str) -> DataFrame:
    """Pages per host, its labels reversed so that a domain's hosts sort together."""
    require(df, url)
    hosts = df.select(S.reversed_labels(S.host(F.col(url))).alias("host_key"))
    return hosts.groupBy("host_key").agg(F.count(F.lit(1)).alias("pages"))


def unbalanced(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Rows with brackets, and those whose brackets do not match and nest."""
    require(df, text, *by)
    has = F.length(S.brackets_only(F.col(text))) > 0
    checked = df.select(*by, has.alias("_has"), S.brackets_balanced(F.col(text)).alias("_ok"))
    return checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("_has").alias("with_brackets"),
        F.count_if(~F.col("_ok")).alias("unbalanced"),
    )


def _classes(words: DataFrame, w: str, key: Column, min_size: int) -> DataFrame:
    """Distinct words, each with the key, size and first word of its class.

    Sizes come from a combining aggregate and are joined back by key, unique on
    that side, so adaptive execution can split a crowded class; no class is ever
    gathered into one row or sorted in one task.
    """
    distinct = words.select(w).where(F.col(w).isNotNull()).distinct()
    # never null, so that no null test repeats the computation of the key
    distinct = distinct.withColumn("class_key", F.coalesce(key, F.lit("")))
    sizes = distinct.groupBy("class_key").agg(
        F.count(F.lit(1)).alias("class_size"), F.min(w).alias("first_word")
    )
    return distinct.join(sizes.where(F.col("class_size") >= min_size), "class_key")


def anagram_groups(words: DataFrame, w: str, min_size: int = 1) -> DataFrame:
    """Anagram clusters in long form: one row per distinct word and its cluster."""
    found = _classes(words, w, S.anagram_key(F.col(w)), min_size)
    return found.select("class_key", "class_size", w)


def anagram_pairs(words: DataFrame, w: str) -> DataFrame:
    """Each word paired with the first word it is an anagram of.

    Anagrams form classes, so these pairs carry the whole relation: two words
    are anagrams when they share ``a``. Their number grows with the words, not
    with the square of a class. For given pairs use ``strings.is_anagram``.
    """
    found = _classes(words, w, S.anagram_key(F.col(w)), 2)
    return found.where(F.col(w) > F.col("first_word")).select(
        F.col("first_word").alias("a"), F.col(w).alias("b")
    )


def rotation_pairs(words: DataFrame, w: str) -> DataFrame:
    """Each word paired with the first word it is a rotation of, as above.

    A class shares its smallest rotation. For given pairs use ``strings.is_rotation``.
    """
    found = _classes(words, w, S.rotation_key(F.col(w)), 2)
    return found.where(F.col(w) > F.col("first_word")).select(
        F.col("first_word").alias("a"), F.col(w).alias("b")
    )


def palindromes(words: DataFrame, w: str, min_len: int = 1) -> DataFrame:
    """Words that equal their reverse, with frequency."""
    require(words, w)
    same = (F.length(w) >= min_len) & S.is_palindrome(F.col(w))
    return words.where(same).groupBy(w).agg(F.count(F.lit(1)).alias("n"))
