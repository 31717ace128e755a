"""Casts, null cleaning and date filters: narrow operators, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from lanewise.sources.tables import require

# The numeric types a value is shown in.
CAST_TYPES = {
    "as_float": "float",
    "as_double": "double",
    "as_decimal_10_4": "decimal(10,4)",
    "as_decimal_18_4": "decimal(18,4)",
    "as_decimal_38_10": "decimal(38,10)",
}


def cast_profile(df: DataFrame, col: str) -> DataFrame:
    """``col`` in every type of ``CAST_TYPES``; overflow raises under ANSI mode."""
    require(df, col)
    return df.withColumns({name: F.col(col).cast(kind) for name, kind in CAST_TYPES.items()})


def clean_nulls(
    df: DataFrame, num_default: float = 0, str_default: str = "NA", blanks: bool = True
) -> DataFrame:
    """Numbers: null becomes ``num_default``. Strings: null, and blank text when
    ``blanks`` is set, becomes ``str_default``. Other types stay as they are."""
    cleaned = {}
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, NumericType):
            cleaned[field.name] = F.coalesce(c, F.lit(num_default).cast(field.dataType))
        elif isinstance(field.dataType, StringType):
            empty = c.isNull() | (F.trim(c) == "") if blanks else c.isNull()
            cleaned[field.name] = F.when(empty, F.lit(str_default)).otherwise(c)
    return df.withColumns(cleaned)


def within_months(
    df: DataFrame, date_col: str, as_of: str, n: int = 12, exclude_future: bool = False
) -> DataFrame:
    """Rows at most ``n`` months before ``as_of``, with the distance in months.

    The exact test hides the column inside a function, which no file statistic
    can serve; the plain bound beside it loses no row and reaches the scan.
    """
    require(df, date_col)
    day = F.lit(as_of).cast("date")
    kind = df.schema[date_col].dataType
    earliest = F.date_sub(F.add_months(day, -n), 1).cast(kind)
    months = F.months_between(day, F.col(date_col))
    near = df.where(F.col(date_col) >= earliest)
    if exclude_future:
        near = near.where(F.col(date_col) < F.date_add(day, 1).cast(kind))
    return near.withColumn("months_from", months).where(F.col("months_from") <= n)
