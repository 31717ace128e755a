from __future__ import annotations

from pyspark.sql import functions as F

from lanewise.catalog import money, number_of, query, text_of
from lanewise.operators import aggregates as A
from lanewise.operators import calendars as C
from lanewise.operators import joins as J
from lanewise.operators import projections as P
from lanewise.plans.lanes import Lane
from lanewise.sources.tables import as_view, load

BY_CUSTOMER_YEAR = Lane(("o_custkey", "o_year"), ("o_orderdate", "o_orderkey"))
BY_USER = Lane(("user_id",), ("ts", "event_id"))
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("scan_table", "SELECT r_regionkey, r_name FROM region")
def scan_table(spark, sf_dir):
    return as_view(load(spark, sf_dir, "region"), "lanewise_region")


@query(
    "numeric_casts",
    """
    SELECT l_orderkey, l_linenumber, CAST(v AS FLOAT)::DOUBLE AS as_float, v AS as_double,
           CAST(CAST(v AS DECIMAL(10,4)) AS VARCHAR) AS as_decimal_10_4,
           CAST(CAST(v AS DECIMAL(18,4)) AS VARCHAR) AS as_decimal_18_4,
           CAST(CAST(v AS DECIMAL(38,10)) AS VARCHAR) AS as_decimal_38_10
    FROM (SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS v FROM lineitem)
    """,
)
def numeric_casts(spark, sf_dir):
    value = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", value.alias("v"))
    decimals = [text_of(c) for c in P.CAST_TYPES if "decimal" in c]
    cast = P.cast_profile(rows, "v")
    return cast.select(
        "l_orderkey", "l_linenumber", number_of("as_float"), "as_double", *decimals
    )


@query(
    "null_cleaning",
    """
    SELECT event_id, coalesce(nullif(user_id, 7), 0) AS user_id,
           CASE WHEN event_type IN ('view', 'click') THEN 'NA' ELSE event_type END AS event_type,
           CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value
    FROM events
    """,
)
def null_cleaning(spark, sf_dir):
    kind = F.col("event_type")
    dirty = load(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("user_id", F.lit(7)).alias("user_id"),
        F.when(kind == "view", "  ").when(kind != "click", kind).alias("event_type"),
        F.when(kind != "error", F.col("value")).alias("value"),
    )
    return P.clean_nulls(dirty)


@query(
    "recent_within_months",
    """
    SELECT o_orderkey, months_from FROM (
      SELECT o_orderkey, round((2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate)
             + CASE WHEN day(o_orderdate) = 1 THEN 0 ELSE (1 - day(o_orderdate)) / 31.0 END, 8)
             ::DOUBLE AS months_from
      FROM orders)
    WHERE months_from <= 12
    """,
)
def recent_within_months(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return P.within_months(orders, "o_orderdate", "2001-08-01").select("o_orderkey", "months_from")


@query(
    "theta_join",
    """
    SELECT c_custkey, c_acctbal, s_suppkey, s_acctbal
    FROM customer JOIN supplier ON c_acctbal > s_acctbal
    """,
)
def theta_join(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    pairs = J.theta_join(customers, suppliers, "c_acctbal", "s_acctbal")
    return pairs.select("c_custkey", "c_acctbal", "s_suppkey", "s_acctbal")


@query(
    "theta_join_counts",
    """
    SELECT o_orderkey, o_totalprice,
           (SELECT count(*) FROM supplier s WHERE o.o_totalprice > s.s_acctbal * 50) AS n_smaller
    FROM orders o
    """,
)
def theta_join_counts(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    suppliers = load(spark, sf_dir, "supplier").select((F.col("s_acctbal") * 50).alias("limit"))
    return J.theta_counts(orders, suppliers, "o_totalprice", "limit")


@query(
    "theta_join_nearest",
    """
    SELECT c_custkey, s_suppkey, s_acctbal, place FROM (
      SELECT c_custkey, s_suppkey, s_acctbal, row_number() OVER (
               PARTITION BY c_custkey ORDER BY s_acctbal DESC, s_suppkey DESC) AS place
      FROM customer JOIN supplier ON c_acctbal > s_acctbal)
    WHERE place <= 3
    """,
)
def theta_join_nearest(spark, sf_dir):
    """Of the suppliers a customer's balance exceeds, the three nearest: the end of its interval."""
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    ranked = J.with_positions(suppliers, "s_acctbal", "s_suppkey")
    beaten = J.theta_counts(customers, suppliers, "c_acctbal", "s_acctbal").withColumns(
        {"first": F.greatest(F.col("n_smaller") - 2, F.lit(1)), "last": F.col("n_smaller")}
    )
    pairs = J.at_positions(beaten, ranked, "first", "last")
    place = (F.col("n_smaller") - F.col("position") + 1).alias("place")
    return pairs.select("c_custkey", "s_suppkey", "s_acctbal", place)


def _join_sql(how: str) -> str:
    return f"""
    WITH t1 AS (SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS id FROM orders),
         t2 AS (SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS id FROM customer)
    SELECT count(*) AS row_count FROM t1 {how} JOIN t2 ON t1.id = t2.id
    """


def _null_join(how: str):
    def build(spark, sf_dir):
        left = load(spark, sf_dir, "orders").select(
            F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("id")
        )
        right = load(spark, sf_dir, "customer").select(
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("id")
        )
        return J.join_counts(left, right, ["id"], how)

    return build


for _how in ("inner", "left", "right", "full"):
    query(f"join_null_{_how}", _join_sql(_how))(_null_join(_how))


@query(
    "missing_dates_anti",
    """
    WITH days AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events),
         ends AS (SELECT user_id, min(day) AS a, max(day) AS b FROM days GROUP BY user_id),
         every_day AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day
                       FROM ends)
    SELECT user_id, CAST(day AS VARCHAR) AS day
    FROM every_day e ANTI JOIN days d USING (user_id, day)
    """,
)
def missing_dates_anti(spark, sf_dir):
    gaps = C.missing_dates(load(spark, sf_dir, "events"), ["user_id"], "ts")
    return gaps.select("user_id", text_of("day"))


@query(
    "signed_balance",
    """
    SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN -o_totalprice::DECIMAL(18,2)
                               ELSE o_totalprice::DECIMAL(18,2) END) AS DOUBLE) AS final_amount
    FROM orders GROUP BY o_custkey
    """,
)
def signed_balance(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").withColumn("amount", money("o_totalprice"))
    balance = A.signed_sum(orders, ["o_custkey"], "o_orderstatus", "amount", "F")
    return balance.select("o_custkey", number_of("final_amount"))


@query(
    "group_min_max",
    """
    SELECT l_returnflag, min(l_extendedprice) AS min_l_extendedprice,
           max(l_extendedprice) AS max_l_extendedprice
    FROM lineitem GROUP BY l_returnflag
    """,
)
def group_min_max(spark, sf_dir):
    return A.min_max(load(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query(
    "count_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type",
)
def count_distinct(spark, sf_dir):
    return A.distinct_per(load(spark, sf_dir, "events"), ["event_type"], "user_id", "users")


@query("group_by_dedup", "SELECT p_brand FROM part GROUP BY p_brand")
def group_by_dedup(spark, sf_dir):
    return A.unique_values(load(spark, sf_dir, "part"), ["p_brand"])


@query(
    "duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS cnt
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def duplicate_keys(spark, sf_dir):
    return A.duplicates(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "pivot_sum",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(coalesce(sum(value::DECIMAL(18,2)) FILTER (event_type = '{t}'), 0) AS DOUBLE) AS {t}"
        for t in EVENT_TYPES
    )
    + ", CAST(coalesce(sum(value::DECIMAL(18,2)) FILTER (coalesce(event_type NOT IN ("
    + ", ".join(f"'{t}'" for t in EVENT_TYPES)
    + "), true)), 0) AS DOUBLE) AS other FROM events GROUP BY user_id",
)
def pivot_sum(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("value", money("value"))
    wide = A.pivot_sum(events, ["user_id"], "event_type", "value", EVENT_TYPES)
    return wide.select("user_id", *[number_of(t) for t in [*EVENT_TYPES, "other"]])


@query(
    "always_increasing",
    """
    WITH seen AS (
      SELECT o_custkey, year(o_orderdate) AS o_year, o_totalprice,
             lag(o_totalprice) OVER (PARTITION BY o_custkey, year(o_orderdate)
                                     ORDER BY o_orderdate, o_orderkey) AS p
      FROM orders)
    SELECT o_custkey, CAST(o_year AS BIGINT) AS o_year FROM seen
    GROUP BY o_custkey, o_year HAVING bool_and(o_totalprice > coalesce(p, 0))
    """,
)
def always_increasing(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").withColumn(
        "o_year", F.year("o_orderdate").cast("bigint")
    )
    return A.always_increasing(orders, BY_CUSTOMER_YEAR, "o_totalprice")


@query(
    "chained_lead_match",
    """
    WITH seen AS (
      SELECT user_id, event_type,
             lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type
      FROM events)
    SELECT user_id, count(*) AS total,
           CAST(sum(CASE WHEN event_type = next_type THEN 1 ELSE 0 END) AS BIGINT) AS chained
    FROM seen GROUP BY user_id
    """,
)
def chained_lead_match(spark, sf_dir):
    return A.chain_counts(load(spark, sf_dir, "events"), BY_USER, "event_type", "event_type")


@query(
    "explode_array",
    "SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS component FROM embeddings",
)
def explode_array(spark, sf_dir):
    rows = C.explode_col(load(spark, sf_dir, "embeddings"), ["vec_id"], "embedding", "component")
    return rows.select("vec_id", number_of("component"))


@query(
    "date_calendar",
    """
    WITH ends AS (SELECT user_id, min(ts::DATE) AS a, max(ts::DATE) AS b FROM events GROUP BY user_id)
    SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS VARCHAR) AS day
    FROM ends
    """,
)
def date_calendar(spark, sf_dir):
    days = C.calendar(load(spark, sf_dir, "events"), ["user_id"], "ts")
    return days.select("user_id", text_of("day"))


@query(
    "missing_numbers",
    """
    WITH ends AS (SELECT l_orderkey, max(l_linenumber) AS b FROM lineitem GROUP BY l_orderkey),
         every_n AS (SELECT l_orderkey, unnest(generate_series(1, b)) AS n FROM ends)
    SELECT l_orderkey, CAST(n AS BIGINT) AS missing FROM every_n e
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l
                      WHERE l.l_orderkey = e.l_orderkey AND l.l_linenumber = e.n)
    """,
)
def missing_numbers(spark, sf_dir):
    return C.missing_numbers(load(spark, sf_dir, "lineitem"), ("l_orderkey",), "l_linenumber")
