"""Cash flow, rates, comparisons, anomalies, forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.plans.lanes import Lane, lay_out, with_running
from lanewise.plans.lookups import BROADCAST_BYTES, attach, byte_size, join_null_safe
from lanewise.session import shared_dir
from lanewise.sources.tables import require


def cash_flow(inflow: DataFrame, outflow: DataFrame, ts: str = "ts", amount: str = "amount"):
    """Inflow, outflow and net per month. Each side is summed before they meet."""
    month = F.to_date(F.date_trunc("month", F.col(ts))).alias("month")
    zero = F.lit(0).cast("decimal(28,4)")
    came = inflow.groupBy(month).agg(F.sum(amount).alias("inflow"))
    went = outflow.groupBy(month).agg(F.sum(amount).alias("outflow"))
    both = came.join(went, "month", "full").withColumns(
        {"inflow": F.coalesce("inflow", zero), "outflow": F.coalesce("outflow", zero)}
    )
    return both.withColumn("net", F.col("inflow") - F.col("outflow"))


def compare_periods(df: DataFrame, by: list[str], ts: str, val: str, unit: str) -> DataFrame:
    """Sum per period against the period before. One row per period is ordered."""
    require(df, *by, ts, val)
    period = F.to_date(F.date_trunc(unit, F.col(ts))).alias("period")
    sums = df.groupBy(*by, period).agg(F.sum(val).alias("spend"))
    order = Window.partitionBy(*by).orderBy("period")
    seen = sums.withColumn("spend_before", F.lag("spend").over(order))
    return seen.withColumn("change", F.col("spend") - F.col("spend_before"))


def asof_rate(
    df: DataFrame,
    rates: DataFrame,
    by: list[str],
    ts: str,
    rate: str,
    row_id: str,
    cell: str | None = None,
    max_bytes: int = BROADCAST_BYTES,
    **heavy,
) -> DataFrame:
    """The latest rate at or before each row, by key.

    Rates are written once and measured. Up to ``max_bytes`` they become one sorted array
    a key, which is broadcast, and each row searches its key's array where it lies: ``df``
    is not shuffled. Beyond that rates and rows are ordered together in lanes, by counted
    cells or ``cell`` over ``ts``, and the last rate is carried forward.

    A null key is a key like any other: its rows find its rates. Rates that are null or
    have no time are left out; of several rates of one key and time the largest counts.
    Rows without a time find none.
    """
    require(df, *by, ts, row_id)
    require(rates, *by, ts, rate)
    shared_dir(df.sparkSession)
    known = rates.where(F.col(ts).isNotNull() & F.col(rate).isNotNull())
    known = known.groupBy(*by, ts).agg(F.max(rate).alias(rate)).checkpoint()
    if byte_size(known) <= max_bytes:
        return _searched(df, known, by, ts, rate)
    kind = rates.schema[rate].dataType
    both = df.withColumns({"_is_row": F.lit(1), "_rate": F.lit(None).cast(kind)}).unionByName(
        known.select(*by, F.col(ts), F.col(rate).alias("_rate"), F.lit(0).alias("_is_row")),
        allowMissingColumns=True,
    )
    lane = Lane(tuple(by), (ts, "_is_row", row_id), cell, **heavy)
    seen = with_running(lay_out(both, lane, df), lane, {rate: ("last", "_rate")})
    return seen.where(F.col("_is_row") == 1).select(*df.columns, rate)


def _searched(df: DataFrame, rates: DataFrame, by: list[str], ts: str, rate: str) -> DataFrame:
    """The latest rate by binary search in an array a key; all arrays together are broadcast."""
    arrays = rates.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col(ts).alias("at"), F.col(rate).alias("rate")))).alias("_rates")
    )
    longest = arrays.agg(F.max(F.size("_rates"))).first()[0] or 0
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(longest.bit_length()))]).cast("array<int>")

    def further(at: Column, step: Column) -> Column:
        here = F.get("_rates", at + step - 1)["at"] <= F.col(ts)
        return at + F.when(here, step).otherwise(0)

    found = join_null_safe(df, F.broadcast(arrays), by, "left")
    passed = F.aggregate(steps, F.lit(0), further)
    return found.withColumn(rate, F.get("_rates", passed - 1)["rate"]).select(*df.columns, rate)


def zscore(df: DataFrame, by: list[str], val: str, k: float = 3.0) -> DataFrame:
    """Rows more than ``k`` standard deviations from the mean of their group.

    Group statistics are aggregated, then attached as a lookup: a window would
    gather each group in one task.
    """
    require(df, *by, val)
    stats = df.groupBy(*by).agg(
        F.avg(val).alias("group_mean"), F.stddev_pop(val).alias("group_std")
    )
    scored = attach(df, stats, by)
    z = (F.col(val) - F.col("group_mean")) / F.nullif(F.col("group_std"), F.lit(0.0))
    return scored.withColumn("z", z).where(F.abs("z") > k)


def months_since(date: Column, origin: str) -> Column:
    start = F.lit(origin).cast("date")
    return (
        (F.year(date) - F.year(start)) * 12 + F.month(date) - F.month(start)
    ).cast("bigint")


def linear_forecast(df: DataFrame, by: list[str], period: str, val: str, ahead: int) -> DataFrame:
    """Straight-line trend per group, for the ``ahead`` periods after the last."""
    require(df, *by, period, val)
    fits = df.groupBy(*by).agg(
        F.regr_slope(F.col(val), F.col(period).cast("double")).alias("slope"),
        F.regr_intercept(F.col(val), F.col(period).cast("double")).alias("intercept"),
        F.max(period).alias("_last"),
    )
    steps = F.sequence(F.col("_last") + 1, F.col("_last") + ahead)
    out = fits.select(*by, "slope", "intercept", F.explode(steps).alias(period))
    return out.withColumn("forecast", F.col("intercept") + F.col("slope") * F.col(period))
