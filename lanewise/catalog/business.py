from __future__ import annotations

from pyspark.sql import functions as F

from lanewise.catalog import money, number_of, query, text_of
from lanewise.catalog.relational import BY_USER
from lanewise.operators import customers as U
from lanewise.operators import finance as N
from lanewise.operators import governance as G
from lanewise.operators import similarity as V
from lanewise.sources.tables import load

AS_OF = "2001-08-01"


def _orders(spark, sf_dir):
    return load(spark, sf_dir, "orders").withColumn("amount", money("o_totalprice"))


@query(
    "rfm_variety",
    f"""
    WITH base AS (
      SELECT o_custkey, DATE '{AS_OF}' - max(o_orderdate)::DATE AS recency, count(*) AS frequency,
             CAST(sum(o_totalprice::DECIMAL(18,2)) AS DOUBLE) AS spend
      FROM orders GROUP BY o_custkey),
    v AS (SELECT o_custkey, count(DISTINCT l_partkey) AS variety
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
    j AS (SELECT b.*, coalesce(variety, 0) AS variety FROM base b LEFT JOIN v USING (o_custkey))
    SELECT o_custkey, CAST(recency AS BIGINT) AS recency, frequency, spend, variety,
           ntile(5) OVER (ORDER BY recency DESC, o_custkey) AS r_group,
           ntile(5) OVER (ORDER BY frequency, o_custkey) AS f_group,
           ntile(5) OVER (ORDER BY variety, o_custkey) AS v_group
    FROM j
    """,
)
def rfm_variety(spark, sf_dir):
    scored = U.rfm(_orders(spark, sf_dir), load(spark, sf_dir, "lineitem"), AS_OF)
    return scored.withColumn("spend", F.col("spend").cast("double"))


@query(
    "turnover_6m",
    f"""
    SELECT o_custkey, CAST(sum(o_totalprice::DECIMAL(18,2)) AS DOUBLE) AS turnover
    FROM orders WHERE o_orderdate > DATE '{AS_OF}' - INTERVAL 6 MONTH
                  AND o_orderdate < DATE '{AS_OF}' + INTERVAL 1 DAY
    GROUP BY o_custkey
    """,
)
def turnover_6m(spark, sf_dir):
    out = U.turnover(_orders(spark, sf_dir), AS_OF, 6)
    return out.select("o_custkey", number_of("turnover"))


@query(
    "dwell_time",
    """
    WITH e AS (
      SELECT user_id, event_type, epoch_us(ts) AS us,
             min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) OVER (
               PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS closes
      FROM events WHERE event_type IN ('view', 'purchase'))
    SELECT user_id, count(*) AS visits, CAST(sum(closes - us) AS BIGINT) AS dwell_micros
    FROM e WHERE event_type = 'view' AND closes IS NOT NULL GROUP BY user_id
    """,
)
def dwell_time(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return U.dwell(events, BY_USER, "ts", "event_type", "view", "purchase")


@query(
    "consent_filter",
    """
    WITH consent AS (
      SELECT user_id FROM events WHERE event_type = 'signup' GROUP BY user_id
      HAVING arg_max(CAST(json_extract_string(props, '$.k') AS BIGINT), (ts, event_id)) >= 50)
    SELECT event_id, user_id, event_type FROM events SEMI JOIN consent USING (user_id)
    """,
)
def consent_filter(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    given = F.get_json_object("props", "$.k").cast("bigint") >= 50
    signups = events.where(F.col("event_type") == "signup")
    consent = U.latest_consent(signups, "user_id", ["ts", "event_id"], given)
    return U.with_consent(events, consent, ["user_id"]).select("event_id", "user_id", "event_type")


@query(
    "pii_mask",
    r"""
    SELECT sha256(sha256('example secret') || ':' || CAST(doc_id AS VARCHAR)) AS doc_id, lang,
           regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<email>', 'g')
             AS text
    FROM documents
    """,
)
def pii_mask(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return G.mask(docs, "text", "doc_id", secret="example secret")


RULES = {
    "quantity_in_range": "l_quantity between 1 and 45",
    "discount_below_ten_percent": "l_discount < 0.10",
    "price_positive": "l_extendedprice > 0",
    "shipped_after_1995": "l_shipdate >= timestamp_ntz'1996-01-01'",
    "returned_has_no_tax": "l_returnflag <> 'R' or l_tax = 0",
}


@query(
    "quality_rules",
    " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER ({rule}) AS passed,"
        f" count(*) FILTER (NOT ({rule})) AS failed FROM lineitem"
        for name, rule in (
            (n, r.replace("timestamp_ntz'", "TIMESTAMP '")) for n, r in RULES.items()
        )
    ),
)
def quality_rules(spark, sf_dir):
    return G.check_rules(load(spark, sf_dir, "lineitem"), RULES)


@query(
    "quality_quarantine",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           concat_ws(',', CASE WHEN NOT (l_quantity BETWEEN 1 AND 45) THEN 'quantity_in_range' END,
             CASE WHEN NOT (l_returnflag <> 'R' OR l_tax = 0) THEN 'returned_has_no_tax' END)
             AS failed_rules
    FROM lineitem
    WHERE NOT (l_quantity BETWEEN 1 AND 45) OR NOT (l_returnflag <> 'R' OR l_tax = 0)
    """,
)
def quality_quarantine(spark, sf_dir):
    rules = {n: RULES[n] for n in ("quantity_in_range", "returned_has_no_tax")}
    bad = G.quarantine(load(spark, sf_dir, "lineitem"), rules)
    names = F.array_join("failed_rules", ",").alias("failed_rules")
    return bad.select("l_orderkey", "l_partkey", "l_linenumber", names)


@query(
    "recommend_topk",
    """
    WITH b AS (
      SELECT DISTINCT c_mktsegment, l_partkey, o_custkey
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    n AS (SELECT c_mktsegment, l_partkey, count(*) AS buyers FROM b GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment
                                       ORDER BY buyers DESC, l_partkey) AS place FROM n)
    SELECT c_mktsegment, l_partkey, buyers, place FROM r WHERE place <= 10
    """,
)
def recommend_topk(spark, sf_dir):
    tables = [load(spark, sf_dir, t) for t in ("orders", "lineitem", "customer")]
    return U.recommend_topk(*tables, k=10)


@query(
    "cash_flow_monthly",
    """
    WITH i AS (SELECT date_trunc('month', o_orderdate)::DATE AS month,
                      sum(o_totalprice::DECIMAL(18,2)) AS inflow FROM orders GROUP BY 1),
         o AS (SELECT date_trunc('month', l_shipdate)::DATE AS month,
                      sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2))) AS outflow
               FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT CAST(month AS VARCHAR) AS month, CAST(coalesce(inflow, 0) AS DOUBLE) AS inflow,
           CAST(coalesce(outflow, 0) AS DOUBLE) AS outflow,
           CAST(coalesce(inflow, 0) - coalesce(outflow, 0) AS DOUBLE) AS net
    FROM i FULL JOIN o USING (month)
    """,
)
def cash_flow_monthly(spark, sf_dir):
    sold = _orders(spark, sf_dir).select(F.col("o_orderdate").alias("ts"), "amount")
    refund = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    lines = load(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    returned = lines.select(F.col("l_shipdate").alias("ts"), refund.alias("amount"))
    flow = N.cash_flow(sold, returned)
    return flow.select(text_of("month"), *[number_of(c) for c in ("inflow", "outflow", "net")])


@query(
    "embedding_topk",
    """
    WITH parts AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m
                   FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i
                         FROM embeddings) GROUP BY label, i),
         q AS (SELECT label AS query_id, list(m ORDER BY i) AS c FROM parts GROUP BY label),
         s AS (SELECT query_id, vec_id, list_cosine_similarity(c, embedding::DOUBLE[]) AS score
               FROM q CROSS JOIN embeddings),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                 AS place FROM s)
    SELECT query_id, vec_id, round(score, 6) AS score, place FROM r WHERE place <= 10
    """,
)
def embedding_topk(spark, sf_dir):
    vectors = load(spark, sf_dir, "embeddings")
    found = V.cosine_topk(vectors, V.centroids(vectors, "label", "embedding"), k=10)
    return found.select("query_id", "vec_id", F.round("score", 6).alias("score"), "place")


@query(
    "spend_comparison",
    """
    WITH s AS (SELECT c_mktsegment, date_trunc('year', o_orderdate)::DATE AS period,
                      sum(o_totalprice::DECIMAL(18,2)) AS spend
               FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
         p AS (SELECT *, lag(spend) OVER (PARTITION BY c_mktsegment ORDER BY period) AS before FROM s)
    SELECT c_mktsegment, CAST(period AS VARCHAR) AS period, CAST(spend AS DOUBLE) AS spend,
           CAST(before AS DOUBLE) AS spend_before, CAST(spend - before AS DOUBLE) AS change
    FROM p
    """,
)
def spend_comparison(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = _orders(spark, sf_dir).select("o_custkey", "o_orderdate", "amount")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    out = N.compare_periods(joined, ["c_mktsegment"], "o_orderdate", "amount", "year")
    values = [number_of(c) for c in ("spend", "spend_before", "change")]
    return out.select("c_mktsegment", text_of("period"), *values)


@query(
    "fx_convert",
    """
    WITH m AS (SELECT o_orderpriority, (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) AS day,
                      avg(o_totalprice) / 250000 AS rate
               FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
         r AS (SELECT o_orderpriority, day, CAST(round(rate, 4) AS DECIMAL(10,4)) AS rate FROM m)
    SELECT o_orderkey, CAST(r.rate AS DOUBLE) AS rate,
           CAST(round(o_totalprice::DECIMAL(18,2) * r.rate, 2) AS DOUBLE) AS converted
    FROM orders o ASOF LEFT JOIN r
      ON o.o_orderpriority = r.o_orderpriority AND o.o_orderdate >= r.day
    """,
)
def fx_convert(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    # the mean of a month is the rate from the first of the next
    month = F.date_trunc("month", F.col("o_orderdate"))
    effective = F.add_months(F.to_date(month), 1).cast("timestamp_ntz")
    rates = (
        orders.where(F.col("o_orderstatus") == "F")
        .groupBy("o_orderpriority", effective.alias("o_orderdate"))
        .agg(F.round(F.avg("o_totalprice") / 250_000, 4).cast("decimal(10,4)").alias("rate"))
    )
    out = N.asof_rate(orders, rates, ["o_orderpriority"], "o_orderdate", "rate", "o_orderkey")
    converted = F.round(money("o_totalprice") * F.col("rate"), 2).cast("double")
    return out.select("o_orderkey", number_of("rate"), converted.alias("converted"))


@query(
    "anomaly_zscore",
    """
    WITH s AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS d
               FROM events GROUP BY event_type)
    SELECT event_id, event_type, value, round((value - m) / d, 6) AS z
    FROM events JOIN s USING (event_type) WHERE abs((value - m) / d) > 3
    """,
)
def anomaly_zscore(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    found = N.zscore(events, ["event_type"], "value", 3.0)
    return found.select("event_id", "event_type", "value", F.round("z", 6).alias("z"))


@query(
    "cashflow_forecast",
    """
    WITH m AS (SELECT o_orderpriority, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1
                        AS month_no, CAST(sum(o_totalprice::DECIMAL(18,2)) AS DOUBLE) AS amount
               FROM orders GROUP BY 1, 2),
         f AS (SELECT o_orderpriority, regr_slope(amount, month_no) AS s,
                      regr_intercept(amount, month_no) AS i, max(month_no) AS last
               FROM m GROUP BY 1)
    SELECT o_orderpriority, CAST(last + step AS BIGINT) AS month_no,
           round(i + s * (last + step), 2) AS forecast
    FROM f, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS step)
    """,
)
def cashflow_forecast(spark, sf_dir):
    month = N.months_since(F.col("o_orderdate"), "1995-01-01").alias("month_no")
    monthly = (
        _orders(spark, sf_dir)
        .groupBy("o_orderpriority", month)
        .agg(F.sum("amount").cast("double").alias("amount"))
    )
    out = N.linear_forecast(monthly, ["o_orderpriority"], "month_no", "amount", 6)
    return out.select("o_orderpriority", "month_no", F.round("forecast", 2).alias("forecast"))


@query(
    "hot_cold_split",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '{AS_OF}' - INTERVAL 365 DAY THEN 'hot'
                       ELSE 'archive' END AS tier, CAST(year(o_orderdate) AS BIGINT) AS year
    FROM orders
    """,
)
def hot_cold_split(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return G.split_by_age(orders, "o_orderdate", AS_OF, 365).select("o_orderkey", "tier", "year")


GOLD_SQL = """
    SELECT CAST(ts::DATE AS VARCHAR) AS day, event_type, count(*) AS events,
           count(DISTINCT user_id) AS users,
           CAST(sum(value::DECIMAL(18,2)) AS DOUBLE) AS value,
           max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k
    FROM events GROUP BY ts::DATE, event_type
    """


@query("medallion_batch", GOLD_SQL)
def medallion_batch(spark, sf_dir):
    served = G.gold(G.silver(load(spark, sf_dir, "events")))
    return served.select(
        text_of("day"), "event_type", "events", "users", number_of("value"), "max_k"
    )
