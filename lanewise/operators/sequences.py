"""Operators over the sequence of values of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.plans.lanes import (
    CHUNK,
    Lane,
    lay_out,
    number_cell,
    with_previous,
    with_run_number,
    with_running,
)
from lanewise.sources.tables import require


def longest_distinct_run(df: DataFrame, lane: Lane, val: str) -> DataFrame:
    """Per key, the length of the longest stretch without a repeated value.

    A stretch ending at a row starts after the latest position at which any of
    its values was seen before: a running maximum of last-seen positions.
    """
    require(df, val)
    rows = df.select(*{*lane.key, *lane.order, val}).withColumn("_one", F.lit(1))
    placed = with_running(lay_out(rows, lane), lane, {"_pos": ("count", "_one")})
    placed = placed.select(*lane.key, val, "_pos")
    by_value = Lane(
        (*lane.key, val), ("_pos",), number_cell("_pos", 100_000), lane.min_rows, lane.max_heavy
    )
    seen = with_previous(lay_out(placed, by_value, rows), by_value, {"_seen": "_pos"}).drop(CHUNK)
    by_pos = Lane(lane.key, ("_pos",), number_cell("_pos", 100_000), lane.min_rows, lane.max_heavy)
    ends = with_running(lay_out(seen, by_pos, rows), by_pos, {"_stop": ("max", "_seen")})
    length = F.col("_pos") - F.coalesce("_stop", F.lit(0))
    return ends.groupBy(*lane.key).agg(F.max(length).alias("longest"))


def run_length(df: DataFrame, lane: Lane, val: str) -> DataFrame:
    """Runs of equal values per key: number from 1, value, length, first and last.

    ``first`` and ``last`` are those of the leading order column.
    """
    require(df, val)
    rows = df.select(*{*lane.key, *lane.order, val})
    runs = with_run_number(
        lay_out(rows, lane),
        lane,
        [val],
        lambda before, here: ~F.equal_null(before[val], here[val]),
        1,
        "run",
    )
    return runs.groupBy(*lane.key, "run", val).agg(
        F.count(F.lit(1)).alias("length"),
        F.min(lane.order[0]).alias("first"),
        F.max(lane.order[0]).alias("last"),
    )
