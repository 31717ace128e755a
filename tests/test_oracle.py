"""Every query of the catalog against its SQL in DuckDB, on whole tables."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as contract
from lanewise.catalog import QUERIES, SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

ON_LANES = [
    "always_increasing",
    "chained_lead_match",
    "dense_rank_desc",
    "dwell_time",
    "fx_convert",
    "increase_vs_previous",
    "longest_repeat_free_run",
    "missing_numbers",
    "moving_avg_6",
    "overlapping_sessions",
    "run_length",
    "running_total_by_key",
    "sessionize_gap",
    "three_in_a_row",
]


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert oracle.type_differences(df, duck, SQL[name]) == []
    assert oracle.spark_rows(df) == oracle.duck_rows(duck, SQL[name])


@pytest.mark.parametrize("name", ON_LANES)
def test_query_with_every_key_cut(spark, duck, all_heavy, name):
    df = QUERIES[name](spark, SF_DIR)
    assert oracle.spark_rows(df) == oracle.duck_rows(duck, SQL[name])


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "run", "event_type", "length", "first_us", "last_us"]
    assert df.count() > 0
