"""Event-time windows, sessions and de-duplication on streams.

All run in append mode: a window is written once, when the watermark has passed
its end, so state holds open windows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(stream: DataFrame, by: list[str], window: Column, watermark: str, ts: str):
    counted = stream.withWatermark(ts, watermark).groupBy(window.alias("w"), *by)
    counted = counted.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n"
    )


def click_counts(
    stream: DataFrame, by: list[str], size: str = "1 hour", watermark: str = "1 hour", ts: str = "ts"
) -> DataFrame:
    """Rows per tumbling window and group."""
    return _counts(stream, by, F.window(ts, size), watermark, ts)


def sliding_counts(
    stream: DataFrame,
    by: list[str],
    size: str = "1 hour",
    slide: str = "15 minutes",
    watermark: str = "1 hour",
    ts: str = "ts",
) -> DataFrame:
    """Rows per overlapping window and group."""
    return _counts(stream, by, F.window(ts, size, slide), watermark, ts)


def stream_sessions(
    stream: DataFrame,
    key: str,
    gap: str = "30 minutes",
    watermark: str = "1 hour",
    ts: str = "ts",
) -> DataFrame:
    """Sessions per key; events exactly ``gap`` apart share one."""
    grouped = stream.withWatermark(ts, watermark).groupBy(key, F.session_window(ts, gap).alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("last_ts")).select(
        key, F.col("w.start").alias("first_ts"), "last_ts", "n"
    )


def stream_dedup(
    stream: DataFrame, keys: list[str], watermark: str = "1 hour", ts: str = "ts"
) -> DataFrame:
    """Repeats of ``keys`` within the watermark dropped; state forgets older keys."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def late_rows(progress: list) -> int:
    """Rows the watermark dropped, from a query's progress reports.

    Counted at the input of stateful operators: whole rows for a
    de-duplication, partial sums where an aggregate combines before the shuffle.
    """
    return sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators)
