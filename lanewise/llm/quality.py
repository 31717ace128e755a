"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a column expression over the whole text and every rule a
comparison of two measures, so a verdict costs one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.common import BLANK, let

#: Common function words of the supported languages.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his at are this "
    "der die das und zu den von mit sich des auf für ist im dem nicht ein eine "
    "le la les de et un une des du en que qui dans pour par sur au est "
    "el los las y del se por con para una es lo como"
).split()

#: Characters counted as symbols, and how a list line begins.
SYMBOLS = "[#*$%&|<>]"
BULLET = r"^[\x20\x09]*[-*•‣]"


@dataclass(frozen=True)
class Rule:
    """Keep a text when low <= measure / per <= high; with a zero ``per`` only a zero measure passes a high bound."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None

    def passes(self, measured: Column) -> Column:
        value = measured[self.measure].cast("double")
        unit = measured[self.per].cast("double") if self.per else F.lit(1.0)
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low * unit)
        if self.high is not None:
            ok = ok & (value <= self.high * unit)
        return ok


RULES = (
    Rule("length", "n_words", low=50),
    Rule("word_length", "word_chars", "n_words", low=2, high=16),
    Rule("symbols", "n_symbols", "n_words", high=0.5),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.5),
)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"{BLANK}+"), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """How many words lie in a window of three that the text holds twice or more.

    Windows are told apart by 64-bit hashes. Only texts with a repeated window
    are sorted; equal windows are then neighbours.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            return F.array_sort(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, k: F.struct(
                                x["i"].alias("i"),
                                (
                                    F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                                    | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                                ).alias("again"),
                            ),
                        ),
                        lambda x: x["again"],
                    ),
                    lambda x: x["i"],
                )
            )

        def width(at: Column) -> Column:
            steps = F.transform(
                at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))
            )
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(placed, repeated), width)

    windows = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(
            F.lit(0).cast("long")
        ),
    )


def measures(text: Column) -> Column:
    """All measures of a text as one struct; a null text measures as an empty one."""
    text = F.coalesce(text, F.lit(""))
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])

    def of_lines(lines: Column) -> list[Column]:
        return [
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(BULLET))).cast("long").alias("n_bullet_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))
            .cast("long")
            .alias("n_ellipsis_lines"),
        ]

    def of_words(words: Column) -> list[Column]:
        return [
            F.size(words).cast("long").alias("n_words"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.array_contains(stop, F.lower(w))))
            .cast("long")
            .alias("n_stop_words"),
        ]

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_line = let(lines, lambda x: F.struct(*of_lines(x)))
    by_word = let(_words(text), lambda x: F.struct(*of_words(x)))
    return F.struct(
        F.length(F.regexp_replace(text, BLANK, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        by_line.alias("by_line"),
        by_word.alias("by_word"),
    )


def _flat(m: Column) -> dict[str, Column]:
    return {
        "word_chars": m["word_chars"],
        "n_symbols": m["n_symbols"],
        **{n: m["by_line"][n] for n in ("n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines")},
        **{n: m["by_word"][n] for n in ("n_words", "n_repeat_words", "n_stop_words")},
    }


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``quality``: the measures, the names of failed rules, ``kept``.

    A column named ``quality`` of the input is replaced. A null, empty or blank
    text measures 0 and fails by length. Repeated rows are judged alike; an
    empty table gives an empty one.
    """

    def verdict(m: Column) -> Column:
        flat = _flat(m)
        failed = F.filter(
            F.array(*[F.when(~r.passes(flat), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
        )
        return F.struct(
            *[c.alias(n) for n, c in flat.items()],
            failed.alias("failed"),
            (F.size(failed) == 0).alias("kept"),
        )

    return docs.withColumn("quality", let(measures(F.col(text)), verdict))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass every rule, with their own columns."""
    own = "__quality_rules"
    judged = judge(docs.select(F.col(text).alias("text"), F.struct("*").alias(own)), rules)
    return judged.where("quality.kept").select(f"{own}.*")
