"""Turning (start, end) pairs into one row per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 65_536


def explode_span(df: DataFrame, start: str, end: str, alias: str) -> DataFrame:
    """One row per integer from ``start`` to ``end``; empty when end < start.

    Explodes in two levels, so that no single row ever holds an array longer
    than a block, whatever the span.
    """
    kept = [c for c in df.columns if c not in (start, end)]
    blocks = df.where(F.col(start) <= F.col(end)).select(
        *kept,
        F.col(end).cast("bigint").alias("_end"),
        F.explode(
            F.sequence(
                F.col(start).cast("bigint"), F.col(end).cast("bigint"), F.lit(BLOCK).cast("bigint")
            )
        ).alias("_from"),
    )
    upto = F.least(F.col("_end"), F.col("_from") + (BLOCK - 1))
    return blocks.select(*kept, F.explode(F.sequence("_from", upto)).alias(alias))


def explode_days(df: DataFrame, start: str, end: str, alias: str) -> DataFrame:
    """One row per date from ``start`` to ``end``."""
    days = df.withColumns(
        {start: F.unix_date(start).cast("bigint"), end: F.unix_date(end).cast("bigint")}
    )
    return explode_span(days, start, end, alias).withColumn(
        alias, F.date_from_unix_date(F.col(alias).cast("int"))
    )
