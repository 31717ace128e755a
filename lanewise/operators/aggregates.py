"""Grouped aggregates. All combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.plans.lanes import Lane, lay_out, with_previous
from lanewise.sources.tables import require


def signed(
    kind: str, amount: str, negative: str, positive: str | None = None
) -> Column:
    """``amount``, negated for rows of kind ``negative``.

    Any other kind, null included, counts as positive; with ``positive`` given,
    kinds that are neither are left out.
    """
    flipped = F.when(F.col(kind) == negative, -F.col(amount))
    if positive is None:
        return flipped.otherwise(F.col(amount))
    return flipped.when(F.col(kind) == positive, F.col(amount))


def signed_sum(
    df: DataFrame,
    key: list[str],
    kind: str,
    amount: str,
    negative: str,
    positive: str | None = None,
    alias: str = "final_amount",
) -> DataFrame:
    require(df, *key, kind, amount)
    return df.groupBy(*key).agg(F.sum(signed(kind, amount, negative, positive)).alias(alias))


def min_max(df: DataFrame, key: list[str], val: str) -> DataFrame:
    require(df, *key, val)
    return df.groupBy(*key).agg(F.min(val).alias(f"min_{val}"), F.max(val).alias(f"max_{val}"))


def distinct_per(
    df: DataFrame, key: list[str], val: str, alias: str = "n", approximate: bool = False
) -> DataFrame:
    require(df, *key, val)
    counted = F.approx_count_distinct(val) if approximate else F.countDistinct(val)
    return df.groupBy(*key).agg(counted.alias(alias))


def unique_values(df: DataFrame, cols: list[str]) -> DataFrame:
    require(df, *cols)
    return df.select(*cols).distinct()


def duplicates(df: DataFrame, keys: list[str], alias: str = "cnt") -> DataFrame:
    require(df, *keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)).where(F.col(alias) > 1)


def pivot_sum(
    df: DataFrame,
    key: list[str],
    cat: str,
    val: str,
    values: list[str] | None = None,
    fill: float | None = 0,
    other: str | None = "other",
    most: int = 2000,
) -> DataFrame:
    """One summed column per category: a single grouped pass, one shuffle.

    Without ``values`` the categories are found first; a null category is the
    column "null", and more than ``most`` are an error, never left out. With
    ``values``, the rest is summed in the column ``other`` (None: left out on purpose).
    """
    require(df, *key, cat, val)
    found = values
    if found is None:
        found = [r[0] for r in df.select(cat).distinct().orderBy(cat).limit(most + 1).collect()]
        if len(found) > most:
            raise ValueError(f"more than {most} categories in {cat}")
    sums = [F.sum(F.when(F.col(cat).eqNullSafe(F.lit(v)), F.col(val))) for v in found]
    if values is not None and other is not None:
        known = F.coalesce(F.col(cat).isin(*values), F.lit(False))
        sums.append(F.sum(F.when(~known, F.col(val))))
    names = ["null" if v is None else str(v) for v in found]
    if len(names) < len(sums):
        names.append(other)
    if fill is not None:
        sums = [F.coalesce(s, F.lit(fill)) for s in sums]
    return df.groupBy(*key).agg(*[s.alias(v) for s, v in zip(sums, names)])


def always_increasing(df: DataFrame, lane: Lane, val: str) -> DataFrame:
    """Keys whose every value exceeds the one before; the first must exceed 0."""
    require(df, val)
    seen = with_previous(lay_out(df.select(*{*lane.key, *lane.order, val}), lane), lane, {"_p": val})
    rises = F.coalesce(F.col(val) > F.coalesce("_p", F.lit(0)), F.lit(False))
    return seen.groupBy(*lane.key).agg(F.bool_and(rises).alias("_ok")).where("_ok").drop("_ok")


def chain_counts(df: DataFrame, lane: Lane, start: str, end: str) -> DataFrame:
    """Per key: rows, and rows whose end equals the start of the row after."""
    require(df, start, end)
    cols = df.select(*{*lane.key, *lane.order, start, end})
    seen = with_previous(lay_out(cols, lane), lane, {"_end_before": end})
    return seen.groupBy(*lane.key).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_end_before") == F.col(start)).alias("chained"),
    )
