"""Window operators. Work on raw rows goes through lanes, see plans.lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.plans.lanes import (
    CHUNK,
    Lane,
    lay_out,
    with_back,
    with_moving,
    with_previous,
    with_run_number,
    with_running,
)
from lanewise.plans.lookups import join_null_safe
from lanewise.sources.tables import require


def running_sum(df: DataFrame, lane: Lane, val: str, alias: str = "running") -> DataFrame:
    """Cumulative sum in lane order; over the whole table when the lane has no key."""
    require(df, val)
    return with_running(lay_out(df, lane), lane, {alias: ("sum", val)}).drop(CHUNK)


def running_sum_tied(
    df: DataFrame, lane: Lane, val: str, alias: str = "running"
) -> DataFrame:
    """Cumulative sum where rows of one order value share a total, as a RANGE frame gives it.

    Sums per (key, order value) are ordered once each and joined back, so the order
    need not be unique. ``lane.order`` holds no tie-breaker. Null order values come
    first and share a total too.
    """
    require(df, *lane.key, *lane.order, val)
    on = [*lane.key, *lane.order]
    sums = df.groupBy(*on).agg(F.sum(val).alias("_sum"))
    totals = with_running(lay_out(sums, lane), lane, {alias: ("sum", "_sum")})
    return join_null_safe(df, totals.select(*on, alias), on, "left")


def moving_avg(df: DataFrame, lane: Lane, val: str, n: int, alias: str = "moving") -> DataFrame:
    """Mean of the current and the ``n - 1`` rows before."""
    require(df, val)
    return with_moving(lay_out(df, lane), lane, val, n, alias).drop(CHUNK)


def dense_rank_by(
    df: DataFrame, key: tuple[str, ...], val: str, cell: str | None = None, alias: str = "rank", **heavy
) -> DataFrame:
    """Gap-free rank of a number, highest first; null values get no rank.

    Ranks are computed on distinct values and joined back, so ties cost nothing
    in the ordered step. ``cell`` is the lane cell over ``_down``, the negated
    value, counted if not given; ``heavy`` overrides the lane's thresholds. NaN is the largest number, and
    null keys are a group, as in a window.
    """
    require(df, *key, val)
    nan, down = F.lit(False), -F.col(val)
    if dict(df.dtypes)[val] in ("double", "float"):
        nan = F.isnan(val)
        down = F.when(nan, F.lit(float("-inf"))).otherwise(down)
    values = (
        df.select(*key, val)
        .where(F.col(val).isNotNull())
        .distinct()
        .withColumns({"_number": ~nan, "_down": down})
    )
    lane = Lane(key, ("_number", "_down"), cell, **heavy)
    ranks = with_running(lay_out(values, lane, df), lane, {alias: ("count", "_down")})
    return join_null_safe(df, ranks.select(*key, val, alias), list(key), "left", plain=[val])


def nth_highest(df: DataFrame, key: list[str], val: str, n: int = 3) -> DataFrame:
    """The n-th highest distinct value of each key.

    The rank filter becomes a group limit: each task passes on n values a key.
    """
    require(df, *key, val)
    order = Window.partitionBy(*key).orderBy(F.col(val).desc_nulls_last())
    ranked = df.select(*key, val).distinct().withColumn("_r", F.dense_rank().over(order))
    return ranked.where((F.col("_r") == n) & F.col(val).isNotNull()).drop("_r")


def nth_by_offset(df: DataFrame, val: str, n: int = 3) -> DataFrame:
    """The n-th highest distinct value of the table, by sort and offset."""
    require(df, val)
    values = df.select(val).distinct().orderBy(F.col(val).desc_nulls_last())
    return values.offset(n - 1).limit(1)


def repeated_run(df: DataFrame, lane: Lane, val: str, n: int = 3) -> DataFrame:
    """Rows whose value equals each of the ``n - 1`` before."""
    require(df, val)
    seen = with_back(lay_out(df, lane), lane, val, n - 1, "_back")
    same = F.forall("_back", lambda b: F.coalesce(b["v"] == F.col(val), F.lit(False)))
    return seen.where((F.size("_back") == n - 1) & same).drop("_back", CHUNK)


def increases(df: DataFrame, lane: Lane, val: str, alias: str = "prev") -> DataFrame:
    """Rows above the row before, with that earlier value."""
    require(df, val)
    seen = with_previous(lay_out(df, lane), lane, {alias: val})
    return seen.where(F.col(val) > F.col(alias)).drop(CHUNK)


def overlapping(df: DataFrame, lane: Lane, start: str, end: str) -> DataFrame:
    """Keys with an interval that ends at or after the start of the next one.

    Neighbours suffice: if any two intervals of a key overlap, two adjacent ones do.
    """
    require(df, start, end)
    cols = df.select(*{*lane.key, *lane.order, start, end})
    seen = with_previous(lay_out(cols, lane), lane, {"_end_before": end})
    return seen.where(F.col("_end_before") >= F.col(start)).select(*lane.key).distinct()


def sessionize(
    df: DataFrame, lane: Lane, ts: str, gap_s: int = 1800, alias: str = "session"
) -> DataFrame:
    """Session number per key, from 0; a gap longer than ``gap_s`` starts a new one.

    Gaps are compared in full precision, not in whole seconds.
    """
    require(df, ts)
    gap = F.expr(f"make_dt_interval(0, 0, 0, {gap_s})")
    numbered = with_run_number(
        lay_out(df, lane), lane, [ts], lambda before, here: here[ts] - before[ts] > gap, 0, alias
    )
    return numbered.drop(CHUNK)


def date_islands(df: DataFrame, key: list[str], date: str) -> DataFrame:
    """Start and end of each unbroken run of dates per key.

    Repeated dates are dropped before the shuffle by key. What is left of a key
    is at most one row per calendar day, so a plain window is bounded.
    """
    require(df, *key, date)
    days = df.select(*key, F.to_date(date).alias("_day")).where("_day is not null").distinct()
    order = Window.partitionBy(*key).orderBy("_day")
    flagged = days.withColumn("_new", F.datediff("_day", F.lag("_day").over(order)) > 1)
    numbered = flagged.withColumn("_grp", F.count_if("_new").over(order))
    return numbered.groupBy(*key, "_grp").agg(
        F.min("_day").alias("start_date"), F.max("_day").alias("end_date")
    ).drop("_grp")


def daily_balance(
    df: DataFrame, ts: str, amount: str, reset: str | None = None, alias: str = "cum_balance"
) -> DataFrame:
    """Sums per day, cumulated over all days, or within each ``reset`` unit.

    The ordered step sees one row per calendar day, never the raw rows.
    """
    require(df, ts, amount)
    daily = df.groupBy(F.to_date(ts).alias("day")).agg(F.sum(amount).alias("_sum"))
    groups = [F.date_trunc(reset, "day")] if reset else []
    order = Window.partitionBy(*groups).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("day", F.sum("_sum").over(order).alias(alias))
