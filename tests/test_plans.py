"""Plan shapes that decide how the operators scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanewise.catalog import QUERIES
from lanewise.operators import windows as W
from lanewise.plans import cells
from lanewise.plans.lanes import Lane, minute_cell
from lanewise.sources.tables import load

SF_DIR = "/root/testdata/sf0.001"
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan adaptive execution ended with."""
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


def bracketed(line: str) -> list[str]:
    """The top-level [...] groups of a plan line."""
    groups, depth, start = [], 0, 0
    for i, ch in enumerate(line):
        if ch == "[":
            depth += 1
            start = i + 1 if depth == 1 else start
        elif ch == "]":
            depth -= 1
            if depth == 0:
                groups.append(line[start:i])
    return groups


def unkeyed_window_orders(plan: str) -> list[str]:
    windows = [bracketed(x.split("Window ", 1)[1]) for x in plan.splitlines() if "Window [" in x]
    return [groups[1] for groups in windows if len(groups) == 2]


def test_unkeyed_windows_are_recognised(spark):
    events = load(spark, SF_DIR, "events")
    plain = events.select(F.lag("value").over(Window.orderBy("ts")))
    keyed = events.select(F.lag("value").over(Window.partitionBy("user_id").orderBy("ts")))
    assert len(unkeyed_window_orders(planned(plain))) == 1
    assert unkeyed_window_orders(planned(keyed)) == []


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_product_and_no_unbounded_single_task(spark, monkeypatch, name):
    monkeypatch.setattr(cells, "ROWS", 64)  # these tables would fit one cell
    plan = planned(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # without a partition key only chunk summaries or calendar days are ordered
    for order in unkeyed_window_orders(plan):
        assert order.startswith(("_chunk#", "day#")), order


def test_light_keys_run_as_one_plain_window(spark):
    events = load(spark, SF_DIR, "events").select("event_id", "user_id", "ts")
    lane = Lane(("user_id",), ("ts", "event_id"), minute_cell("ts"))
    plan = executed(W.sessionize(events, lane, "ts"))
    # at most the probe of the empty key table is left; no carry is computed
    assert "SortMergeJoin" not in plan
    assert plan.count("Join") <= 1
    assert "cast(null as bigint) AS _carry" in plan
    rows_moved = [x for x in plan.splitlines() if "Exchange hash" in x and "_chunk#" in x]
    assert len(rows_moved) == 1


def test_heavy_keys_are_partitioned_by_chunk(spark, all_heavy):
    events = load(spark, SF_DIR, "events").select("event_id", "user_id", "ts")
    lane = Lane(("user_id",), ("ts", "event_id"), minute_cell("ts"))
    plan = executed(W.sessionize(events, lane, "ts"))
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+L, _chunk#\d+L", plan)


def test_rank_filter_limits_groups_before_the_shuffle(spark):
    for name in ("nth_highest", "recommend_topk"):
        assert "WindowGroupLimit" in planned(QUERIES[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in planned(QUERIES["nth_highest_offset"](spark, SF_DIR))


def test_date_bound_reaches_the_scan(spark):
    plan = planned(QUERIES["recent_within_months"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "GreaterThan(o_orderdate" in planned(QUERIES["turnover_6m"](spark, SF_DIR))


def test_only_needed_columns_are_read(spark):
    plan = planned(QUERIES["signed_balance"](spark, SF_DIR))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == [
        "o_custkey:bigint,o_orderstatus:string,o_totalprice:double"
    ]


@pytest.mark.parametrize(
    "name,exchanges",
    [("signed_balance", 1), ("pivot_sum", 1), ("consecutive_date_ranges", 2), ("missing_dates_anti", 2)],
)
def test_number_of_shuffles(spark, name, exchanges):
    plan = planned(QUERIES[name](spark, SF_DIR))
    assert len(re.findall(r"Exchange (?:hash|range)partitioning", plan)) == exchanges


def test_join_counts_join_one_row_per_key(spark):
    plan = planned(QUERIES["join_null_inner"](spark, SF_DIR))
    assert plan.index("Join") < plan.index("HashAggregate(keys=[id")


def test_no_python_outside_the_two_operators_that_need_it(spark):
    for name in BATCH:
        plan = planned(QUERIES[name](spark, SF_DIR))
        assert ("Python" in plan or "InPandas" in plan) == (name == "embedding_topk"), name


def test_session_zone_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    load(spark, SF_DIR, "events")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"
