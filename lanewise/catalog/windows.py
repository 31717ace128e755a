from __future__ import annotations

from pyspark.sql import functions as F

from lanewise.catalog import money, number_of, query, text_of
from lanewise.catalog.relational import BY_USER
from lanewise.operators import aggregates as A
from lanewise.operators import sequences as Q
from lanewise.operators import windows as W
from lanewise.plans.lanes import Lane
from lanewise.sources.tables import load

BY_CUSTOMER = Lane(("o_custkey",), ("o_orderdate", "o_orderkey"))
ALL_ORDERS = Lane((), ("o_orderdate", "o_orderkey"))


def _orders(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("amount")
    )


@query(
    "running_total_by_key",
    """
    SELECT o_orderkey, o_custkey, CAST(sum(o_totalprice::DECIMAL(18,2)) OVER (
             PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
             ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
    FROM orders
    """,
)
def running_total_by_key(spark, sf_dir):
    out = W.running_sum(_orders(spark, sf_dir), BY_CUSTOMER, "amount")
    return out.select("o_orderkey", "o_custkey", number_of("running"))


@query(
    "running_total_tied",
    """
    SELECT o_orderkey, o_custkey, CAST(sum(o_totalprice::DECIMAL(18,2)) OVER (
             PARTITION BY o_custkey ORDER BY year(o_orderdate)) AS DOUBLE) AS running
    FROM orders
    """,
)
def running_total_tied(spark, sf_dir):
    orders = _orders(spark, sf_dir).withColumn("o_year", F.year("o_orderdate"))
    lane = Lane(("o_custkey",), ("o_year",), bounded=True)
    out = W.running_sum_tied(orders, lane, "amount")
    return out.select("o_orderkey", "o_custkey", number_of("running"))


@query(
    "running_total_overall",
    """
    SELECT o_orderkey, CAST(sum(o_totalprice::DECIMAL(18,2)) OVER (
             ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
    FROM orders
    """,
)
def running_total_overall(spark, sf_dir):
    out = W.running_sum(_orders(spark, sf_dir), ALL_ORDERS, "amount")
    return out.select("o_orderkey", number_of("running"))


@query(
    "moving_avg_6",
    """
    SELECT o_orderkey, o_custkey, round(avg(o_totalprice) OVER (
             PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
             ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 4) AS moving
    FROM orders
    """,
)
def moving_avg_6(spark, sf_dir):
    out = W.moving_avg(_orders(spark, sf_dir), BY_CUSTOMER, "amount", 6)
    return out.select("o_orderkey", "o_custkey", F.round("moving", 4).alias("moving"))


@query(
    "moving_avg_3",
    """
    WITH daily AS (SELECT o_orderdate::DATE AS day, sum(o_totalprice::DECIMAL(18,2)) AS amount
                   FROM orders GROUP BY 1)
    SELECT CAST(day AS VARCHAR) AS day, round(avg(amount::DOUBLE) OVER (
             ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving
    FROM daily
    """,
)
def moving_avg_3(spark, sf_dir):
    daily = _orders(spark, sf_dir).groupBy(F.to_date("o_orderdate").alias("day"))
    daily = daily.agg(F.sum("amount").alias("amount"))
    lane = Lane((), ("day",), bounded=True)
    out = W.moving_avg(daily, lane, "amount", 3)
    return out.select(text_of("day"), F.round("moving", 4).alias("moving"))


@query(
    "dense_rank_desc",
    """
    SELECT o_orderkey, o_orderpriority, dense_rank() OVER (
             PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank
    FROM orders
    """,
)
def dense_rank_desc(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    ranked = W.dense_rank_by(orders, ("o_orderpriority",), "o_totalprice")
    return ranked.select("o_orderkey", "o_orderpriority", "rank")


@query(
    "dense_rank_overall",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_totalprice DESC) AS rank FROM orders",
)
def dense_rank_overall(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    ranked = W.dense_rank_by(orders, (), "o_totalprice")
    return ranked.select("o_orderkey", "rank")


@query(
    "three_in_a_row",
    """
    SELECT event_id, user_id, event_type FROM (
      SELECT *, lag(event_type, 1) OVER w AS a, lag(event_type, 2) OVER w AS b FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = a AND event_type = b
    """,
)
def three_in_a_row(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    runs = W.repeated_run(events, BY_USER, "event_type", 3)
    return runs.select("event_id", "user_id", "event_type")


@query(
    "three_in_a_row_overall",
    """
    SELECT event_id, event_type FROM (
      SELECT *, lag(event_type, 1) OVER w AS a, lag(event_type, 2) OVER w AS b FROM events
      WINDOW w AS (ORDER BY ts, event_id))
    WHERE event_type = a AND event_type = b
    """,
)
def three_in_a_row_overall(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return W.repeated_run(events, Lane((), ("ts", "event_id")), "event_type", 3).select("event_id", "event_type")


@query(
    "increase_vs_previous",
    """
    WITH daily AS (SELECT user_id, ts::DATE AS day, sum(value::DECIMAL(18,2)) AS amount
                   FROM events GROUP BY 1, 2),
         seen AS (SELECT *, lag(amount) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM daily)
    SELECT user_id, CAST(day AS VARCHAR) AS day, CAST(amount AS DOUBLE) AS amount,
           CAST(prev AS DOUBLE) AS prev
    FROM seen WHERE amount > prev
    """,
)
def increase_vs_previous(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    daily = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum(money("value")).alias("amount")
    )
    lane = Lane(("user_id",), ("day",), bounded=True)
    up = W.increases(daily, lane, "amount")
    return up.select("user_id", text_of("day"), number_of("amount"), number_of("prev"))


@query(
    "overlapping_sessions",
    """
    WITH s AS (SELECT user_id, event_id, ts,
                      epoch_us(ts) + CAST(round(value * 60000000) AS BIGINT) AS ends FROM events),
         seen AS (SELECT *, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
                  FROM s)
    SELECT DISTINCT user_id FROM seen WHERE ends >= n
    """,
)
def overlapping_sessions(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    begins = F.unix_micros(F.col("ts").cast("timestamp"))
    sessions = events.withColumns(
        {
            "begins": begins,
            "ends": begins + F.round(F.col("value") * 60_000_000).cast("bigint"),
        }
    )
    return W.overlapping(sessions, BY_USER, "begins", "ends")


@query(
    "sessionize_gap",
    """
    WITH seen AS (SELECT *, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p
                  FROM events)
    SELECT event_id, user_id, CAST(sum(CASE WHEN epoch_us(ts) - p > 1800000000 THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
             AS session
    FROM seen
    """,
)
def sessionize_gap(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return W.sessionize(events, BY_USER, "ts").select("event_id", "user_id", "session")


ISLANDS_SQL = """
    WITH days AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events),
         g AS (SELECT user_id, day, day - CAST(row_number() OVER (
                 PARTITION BY user_id ORDER BY day) AS INTEGER) AS grp FROM days)
    SELECT user_id, CAST(min(day) AS VARCHAR) AS start_date, CAST(max(day) AS VARCHAR) AS end_date
    FROM g GROUP BY user_id, grp
    """


@query("consecutive_date_ranges", ISLANDS_SQL)
def consecutive_date_ranges(spark, sf_dir):
    runs = W.date_islands(load(spark, sf_dir, "events"), ["user_id"], "ts")
    return runs.select("user_id", text_of("start_date"), text_of("end_date"))


@query("ordered_output", ISLANDS_SQL + " ORDER BY user_id, start_date")
def ordered_output(spark, sf_dir):
    return consecutive_date_ranges(spark, sf_dir).orderBy("user_id", "start_date")


def _signed_orders(spark, sf_dir):
    amount = A.signed("o_orderstatus", "amount", "F")
    orders = load(spark, sf_dir, "orders").withColumn("amount", money("o_totalprice"))
    return orders.select("o_orderdate", amount.alias("amount"))


def _balance_sql(partition: str) -> str:
    return f"""
    WITH daily AS (
      SELECT o_orderdate::DATE AS day, sum(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END
             * o_totalprice::DECIMAL(18,2)) AS s FROM orders GROUP BY 1)
    SELECT CAST(day AS VARCHAR) AS day, CAST(sum(s) OVER ({partition} ORDER BY day
             ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_balance
    FROM daily
    """


@query("running_daily_balance", _balance_sql(""))
def running_daily_balance(spark, sf_dir):
    out = W.daily_balance(_signed_orders(spark, sf_dir), "o_orderdate", "amount")
    return out.select(text_of("day"), number_of("cum_balance"))


@query("monthly_reset_balance", _balance_sql("PARTITION BY date_trunc('month', day)"))
def monthly_reset_balance(spark, sf_dir):
    out = W.daily_balance(_signed_orders(spark, sf_dir), "o_orderdate", "amount", "month")
    return out.select(text_of("day"), number_of("cum_balance"))


@query(
    "nth_highest",
    """
    SELECT DISTINCT o_orderpriority, o_totalprice FROM (
      SELECT *, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS r
      FROM orders)
    WHERE r = 3
    """,
)
def nth_highest(spark, sf_dir):
    return W.nth_highest(load(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", 3)


@query(
    "nth_highest_offset",
    "SELECT DISTINCT o_totalprice FROM orders ORDER BY o_totalprice DESC LIMIT 1 OFFSET 2",
)
def nth_highest_offset(spark, sf_dir):
    return W.nth_by_offset(load(spark, sf_dir, "orders"), "o_totalprice", 3)


@query(
    "longest_repeat_free_run",
    """
    WITH p AS (SELECT user_id, event_type,
                      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
         s AS (SELECT *, lag(pos) OVER (PARTITION BY user_id, event_type ORDER BY pos) AS seen FROM p),
         m AS (SELECT *, max(seen) OVER (PARTITION BY user_id ORDER BY pos
                                         ROWS UNBOUNDED PRECEDING) AS stop FROM s)
    SELECT user_id, max(pos - coalesce(stop, 0)) AS longest FROM m GROUP BY user_id
    """,
)
def longest_repeat_free_run(spark, sf_dir):
    return Q.longest_distinct_run(load(spark, sf_dir, "events"), BY_USER, "event_type")


@query(
    "run_length",
    """
    WITH f AS (SELECT user_id, event_type, ts, event_id,
                      CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS start
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         r AS (SELECT *, CAST(sum(start) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM f)
    SELECT user_id, run, event_type, count(*) AS length,
           epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us
    FROM r GROUP BY user_id, run, event_type
    """,
)
def run_length(spark, sf_dir):
    runs = Q.run_length(load(spark, sf_dir, "events"), BY_USER, "event_type")
    return runs.select(
        "user_id",
        "run",
        "event_type",
        "length",
        F.unix_micros(F.col("first").cast("timestamp")).alias("first_us"),
        F.unix_micros(F.col("last").cast("timestamp")).alias("last_us"),
    )
