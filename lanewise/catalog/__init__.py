"""Named queries: each operator on the test tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def money(col: str) -> Column:
    """Amounts as decimals: their sums are exact, whatever the order."""
    return F.col(col).cast("decimal(18,2)")


def text_of(col: str) -> Column:
    return F.col(col).cast("string").alias(col)


def number_of(col: str) -> Column:
    return F.col(col).cast("double").alias(col)


from lanewise.catalog import business, relational, streams, text, windows  # noqa: E402,F401
