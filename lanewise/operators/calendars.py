"""Generators: arrays to rows, calendars, and what is missing from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.plans.lanes import Lane, lay_out, number_cell, with_previous
from lanewise.plans.spans import explode_days, explode_span
from lanewise.sources.tables import require


def explode_col(
    df: DataFrame, keep: list[str], arr: str, alias: str, outer: bool = False
) -> DataFrame:
    """One row per array element; ``outer`` keeps rows with a null or empty array."""
    require(df, *keep, arr)
    rows = F.explode_outer(arr) if outer else F.explode(arr)
    return df.select(*keep, rows.alias(alias))


def calendar(df: DataFrame, key: list[str], date: str, alias: str = "day") -> DataFrame:
    """Every date between the first and last of each key."""
    require(df, *key, date)
    day = F.to_date(date)
    ends = df.groupBy(*key).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return explode_days(ends, "_first", "_last", alias)


def missing_dates(df: DataFrame, key: list[str], date: str, alias: str = "day") -> DataFrame:
    """Dates absent between the first and last of each key.

    Only the gaps are expanded: distinct dates, each compared with the next, then
    one row per day between. A key has at most one row per calendar day here.
    """
    require(df, *key, date)
    days = df.select(*key, F.to_date(date).alias("_day")).where("_day is not null").distinct()
    order = Window.partitionBy(*key).orderBy("_day")
    gaps = days.withColumns(
        {"_from": F.date_add("_day", 1), "_to": F.date_sub(F.lead("_day").over(order), 1)}
    )
    gaps = gaps.where(F.col("_to") >= F.col("_from")).select(*key, "_from", "_to")
    return explode_days(gaps, "_from", "_to", alias)


def missing_numbers(
    df: DataFrame,
    key: tuple[str, ...],
    n: str,
    upper: int | None = None,
    alias: str = "missing",
    **heavy,
) -> DataFrame:
    """Integers absent from 1 to ``upper`` (default: the key's maximum)."""
    require(df, *key, n)
    present = (
        df.select(*key, F.col(n).cast("bigint").alias("_n")).where("_n is not null").distinct()
    )
    lane = Lane(key, ("_n",), number_cell("_n", 100_000), **heavy)
    seen = with_previous(lay_out(present, lane, df), lane, {"_before": "_n"})
    first = F.greatest(F.coalesce("_before", F.lit(0)), F.lit(0)) + 1
    last = F.col("_n") - 1 if upper is None else F.least(F.col("_n") - 1, F.lit(upper))
    gaps = seen.select(*key, first.alias("_from"), last.cast("bigint").alias("_to"))
    if upper is not None:
        tail = present.groupBy(*key).agg(
            (F.greatest(F.max("_n"), F.lit(0)) + 1).alias("_from"),
            F.lit(upper).cast("bigint").alias("_to"),
        )
        gaps = gaps.unionByName(tail)
    return explode_span(gaps.where("_from <= _to"), "_from", "_to", alias)
