"""Column functions over strings. All run inside the JVM."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three bracket kinds.
BRACKETS = {"(": ")", "[": "]", "{": "}"}

# The named HTML entities of the standard library, with spaces as spaces.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}

# The inside of a tag: a value in quotes, which may hold ">", begins after "=" only.
_INSIDE = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""

# What of a page is no text, as one alternation that is read once, from the left: comments,
# elements whose content is not shown, tags. Comments and such elements may lack their end.
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<(script|style|title)\b{_INSIDE}>.*?(?:</\1\b[^>]*+>|\z)"
    rf"|</?[a-z!?]{_INSIDE}>"
)


def characters(c: Column) -> Column:
    """The code points of a string; combining marks count on their own."""
    return F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))


def without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def anagram_key(c: Column) -> Column:
    return F.concat_ws("", F.sort_array(characters(c)))


def is_anagram(a: Column, b: Column) -> Column:
    return (F.length(a) == F.length(b)) & (anagram_key(a) == anagram_key(b))


def is_rotation(a: Column, b: Column) -> Column:
    return (F.length(a) == F.length(b)) & F.contains(F.concat(a, a), b)


def rotation_key(c: Column) -> Column:
    """The smallest rotation: equal exactly for strings that rotate into each other."""
    turns = F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1)))
    return F.aggregate(
        turns, c, lambda best, i: F.least(best, F.substring(F.concat(c, c), i, F.length(c)))
    )


def is_palindrome(c: Column) -> Column:
    return c == F.reverse(c)


def brackets_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^()\[\]{}]+", "")


def brackets_balanced(c: Column) -> Column:
    """Every bracket closes the latest open one of its kind.

    The text is first reduced to its brackets. Folding over them, the state is
    the closers still awaited, nearest first; it turns null at the first
    bracket that does not fit.
    """
    only = brackets_only(c)

    def step(awaited: Column, ch: Column) -> Column:
        opened = [(ch == F.lit(o), F.concat(F.lit(e), awaited)) for o, e in BRACKETS.items()]
        fits = F.substring(awaited, 1, 1) == ch
        out = reduce(lambda w, p: w.when(*p), opened[1:], F.when(*opened[0]))
        return out.when(fits, F.substring(awaited, F.lit(2), F.length(awaited)))

    left = F.aggregate(characters(only), F.lit(""), step)
    return F.coalesce(left == "", F.lit(False))


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def reversed_labels(name: Column) -> Column:
    """``www.shop.example.com`` as ``com.example.shop.www``."""
    return F.array_join(F.reverse(F.split(name, r"\.")), ".")


def code_point(hexadecimal: Column) -> Column:
    """The character of a hexadecimal code point; null for none, surrogates and the like."""
    code = F.conv(F.when(F.length(hexadecimal) <= 8, hexadecimal), 16, 10).cast("bigint")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(hexadecimal, 8, "0")), "UTF-32"))


def unescaped(c: Column) -> Column:
    """Named and numeric entities as characters, each once; unknown ones stay as they are."""
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, r"^(#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]*);", 1)
        char = (
            F.when(name == "", F.lit(None).cast("string"))
            .when(name.rlike("^#[xX]"), code_point(F.substring(name, F.lit(3), F.length(name))))
            .when(name.startswith("#"), code_point(F.conv(F.substring(name, F.lit(2), F.length(name)), 10, 16)))
            .otherwise(F.try_element_at(names, name))
        )
        char = F.when(char == "\u00a0", F.lit(" ")).otherwise(char)
        rest = F.substring(p, F.length(name) + 2, F.length(p))
        return F.when(char.isNull(), F.concat(F.lit("&"), p)).otherwise(F.concat(char, rest))

    def joined(pieces: Column) -> Column:
        behind = F.slice(pieces, F.lit(2), F.size(pieces))
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(behind, piece), ""))

    return F.when(F.contains(c, F.lit("&")), joined(F.split(c, "&"))).otherwise(c)


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def visible_text(html: Column) -> Column:
    """Text a reader sees: no comments, scripts, styles, head title or tags.

    A "<" that opens none of these is text, as is markup inside a quoted value.
    """
    return squeezed(unescaped(F.regexp_replace(html, MARKUP, " ")))


def page_title(html: Column) -> Column:
    return squeezed(unescaped(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


# Fixed value: the shape of an e-mail address.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def emails_masked(c: Column, mask: str = "<email>") -> Column:
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, EMAIL, mask)).otherwise(c)
