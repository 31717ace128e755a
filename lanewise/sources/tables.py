"""Tables in: parquet folders, literal rows, temp views, catalog tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lanewise.session import prepare


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def literal(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType) -> DataFrame:
    """A table of literal rows with a declared schema."""
    return prepare(spark).createDataFrame(list(rows), schema)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temp view and read it back by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table the session catalog knows."""
    return prepare(spark).table(name)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail before any job runs when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")
    return df
