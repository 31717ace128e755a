"""Filter interaction audit: what each filter removes, alone and in every order.

1. A text fails a filter by its measures (one projection, no shuffle) or because a row of a
   smaller doc_id holds the same text. The latter is an existential self-join: a left-semi
   join on the hash, the exact text and a smaller doc_id.
2. The ids it finds are united with those of the other filters' failures, and the bits of
   one row are combined.
3. Rows are counted by their combination of bits. All orders of the filters follow from
   these counts, at most 2 to the number of filters for a part, never from the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.common import BLANK, let, written
from lanewise.plans.lookups import attach


@dataclass(frozen=True)
class Filter:
    """``fails`` is a condition on the measures; without one, on an earlier copy of the text."""

    letter: str
    fails: Callable[[Column], Column] | None


FILTERS = (
    Filter("A", lambda m: m["n_words"] < 50),
    Filter("B", lambda m: 100 * m["n_distinct_words"] < 65 * m["n_words"]),
    Filter("C", lambda m: 100 * m["n_capitals"] > 5 * m["n_chars"]),
    Filter("D", lambda m: m["has_symbol"]),
    Filter("E", None),
)

#: Texts of one hash that one task compares; hashes of more rows are spread over several.
COPIES = 256
#: Hashes spread in this way at most: with more rows in all, a task compares more.
HEAVY = 4096


def measures(text: Column) -> Column:
    """Counts over a whole text that is not null."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return let(
        F.array_remove(F.split(text, BLANK + "+"), ""),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
            (F.length(text) - F.length(F.translate(text, capitals, ""))).cast("long").alias("n_capitals"),
            F.length(text).cast("long").alias("n_chars"),
            F.rlike(text, F.lit("[#$%&*|]")).alias("has_symbol"),
        ),
    )


def _rows(docs: DataFrame, id: str, text: str, part: str) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(id).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        whole.alias("text"),
        F.xxhash64(whole).alias("hash"),
    )


def earlier_copies(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` (id, part, text, hash) whose text another row of a smaller id holds.

    Only hashes of two ids or more are joined; texts that stand alone are never
    shuffled. Of every text the right side keeps its smallest id, combined on the
    map side. The left rows of a hash are spread over tasks by their id.
    """
    spans = rows.groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    repeated = written(spans.where("low < high").select("hash", "n"), "repeated")
    total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    unit = max(COPIES, -(-total // HEAVY))
    # at most HEAVY rows, whatever the size of the table
    heavy = F.broadcast(repeated.where(F.col("n") > unit).select("hash", F.ceil(F.col("n") / unit).alias("salts")))

    again = attach(rows.where("id is not null"), repeated.select("hash"), ["hash"], "left_semi")
    firsts = again.groupBy("hash", "text").agg(F.min("id").alias("first"))
    salts = F.coalesce("salts", F.lit(1))
    left = again.join(heavy, "hash", "left").withColumn("salt", F.pmod(F.xxhash64("id"), salts)).drop("salts")
    right = firsts.join(heavy, "hash", "left").select(
        F.col("hash").alias("_hash"),
        F.col("text").alias("_text"),
        "first",
        F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt"),
    )
    same = (
        (F.col("hash") == F.col("_hash"))
        & (F.col("salt") == F.col("_salt"))
        & (F.col("text") == F.col("_text"))
        & (F.col("first") < F.col("id"))
    )
    return left.join(right, same, "left_semi").drop("salt")


def combinations(
    docs: DataFrame,
    labels: DataFrame,
    filters: tuple[Filter, ...] = FILTERS,
    id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """part, bits, n, good, toxic: how many rows fail exactly the filters of ``bits`` (bit i: filter i).

    A null text is empty, a null part the empty string. Every row counts, repeated
    ones too; rows of one id are not copies of each other. A row with a null id is no
    copy, makes none and has no labels. ``labels``: ``id``, quality, toxic; several
    rows of an id count as one that holds if any of them does. Other columns are
    ignored, and an empty table gives an empty one.
    """
    rows = _rows(docs, id, text, part)
    bit = {f.letter: 1 << i for i, f in enumerate(filters)}
    measured = measures(F.col("text"))
    by_measure = let(
        measured,
        lambda m: sum(
            (F.when(f.fails(m), bit[f.letter]).otherwise(0) for f in filters if f.fails is not None), F.lit(0)
        ),
    )
    marks = rows.select("id", "part", "hash", by_measure.cast("int").alias("bits"), F.lit(1).alias("n"))
    for f in filters:
        if f.fails is None:
            marks = marks.unionByName(
                earlier_copies(rows).select(
                    "id", "part", "hash", F.lit(bit[f.letter]).alias("bits"), F.lit(0).alias("n")
                )
            )
    # one shuffle by id serves the union of failures and the join to labels; null ids spread by their text
    spread = F.when(F.col("id").isNull(), F.col("hash")).otherwise(F.lit(0))
    combined = (
        marks.withColumn("spread", spread)
        .repartition("id", "spread")
        .groupBy("id", "spread", "part", "hash")
        .agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    )
    holds = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    known = (
        labels.where(F.col(id).isNotNull())
        .groupBy(F.col(id).cast("long").alias("id"))
        .agg(holds("quality").alias("good"), holds("toxic").alias("toxic"))
        .withColumn("spread", F.lit(0).cast("long"))
    )
    among = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return (
        combined.join(known, ["id", "spread"], "left")
        .groupBy("part", "bits")
        .agg(F.sum("n").alias("n"), among("good").alias("good"), among("toxic").alias("toxic"))
    )


def interactions(counted: DataFrame, filters: tuple[Filter, ...] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of ``combinations``.

    Columns: part, filter_order (the letters), step (from 1), filter (its letter), and
    counts of rows: kept after the step, removed by it, redundant (failing it, removed
    earlier), unique_fails (failing no other), good_lost and toxic_lost (removed by
    it), shapley (removed by the filter, summed over all orders).
    """
    letters = "".join(f.letter for f in filters)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    bit_of = lambda letter: F.expr(f"shiftleft(1, instr('{letters}', {letter}) - 1)")
    # a part has one element for each combination, so at most 2 to the number of filters
    gathered = counted.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("counts"))
    steps = (
        gathered.select("part", "counts", F.explode(orders).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
        .withColumn("filter", F.substring("filter_order", F.col("step"), 1))
        .withColumn("own", bit_of("filter"))
        .withColumn(
            "before",
            F.expr(
                "aggregate(split(substring(filter_order, 1, step - 1), ''), 0,"
                f" (bits, c) -> bits | if(c = '', 0, shiftleft(1, instr('{letters}', c) - 1)))"
            ),
        )
    )
    fails = lambda c: c["bits"].bitwiseAND(F.col("own")) != 0
    gone = lambda c: c["bits"].bitwiseAND(F.col("before")) != 0

    def total(field: str, where: Callable[[Column], Column]) -> Column:
        held = F.filter("counts", where)
        return F.aggregate(held, F.lit(0).cast("long"), lambda so_far, c: so_far + c[field])

    # among the orders of all filters, one of k failing filters comes first in 1 of k
    all_orders = factorial(len(letters))
    share = lambda c: c["n"] * F.floor(F.lit(all_orders) / F.bit_count(c["bits"]))
    shapley = F.aggregate(
        F.filter("counts", fails), F.lit(0).cast("long"), lambda so_far, c: so_far + share(c)
    )
    removes = lambda c: fails(c) & ~gone(c)
    return steps.select(
        "part",
        "filter_order",
        "step",
        "filter",
        total("n", lambda c: ~fails(c) & ~gone(c)).alias("kept"),
        total("n", removes).alias("removed"),
        total("n", lambda c: fails(c) & gone(c)).alias("redundant"),
        total("n", lambda c: c["bits"] == F.col("own")).alias("unique_fails"),
        total("good", removes).alias("good_lost"),
        total("toxic", removes).alias("toxic_lost"),
        shapley.alias("shapley"),
    )
