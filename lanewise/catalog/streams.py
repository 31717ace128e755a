"""Streams over the event table, run to what has arrived.

Append mode writes a window once the watermark has passed it; the SQL states the
same closing rule on the batch table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lanewise.catalog import number_of, query, text_of
from lanewise.catalog.business import GOLD_SQL
from lanewise.sources.tables import literal, load
from lanewise.streaming import windows as W
from lanewise.streaming.late import in_time, late_table, split_late
from lanewise.streaming.medallion import run_medallion
from lanewise.streaming.runs import event_stream, new_folder, run_available, run_to_table
from lanewise.streaming.stateful import stream_increases as increases_on

_WATERMARK = "(SELECT epoch_ms(max(ts)) - 3600000 FROM {rows})"
_ALL = _WATERMARK.format(rows="events")


def _events(spark, sf_dir):
    return event_stream(spark, sf_dir, "events.parquet")


def _seconds(col: str):
    return F.unix_seconds(col).alias(col)


@query(
    "stream_click_counts",
    f"""
    WITH clicks AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS s,
                           CAST(json_extract_string(props, '$.k') AS BIGINT) AS product, ts
                    FROM events WHERE event_type = 'click')
    SELECT CAST(epoch(s) AS BIGINT) AS window_start, product, count(*) AS n FROM clicks
    GROUP BY s, product
    HAVING epoch_ms(s) + 3600000 <= {_WATERMARK.format(rows="clicks")}
    """,
)
def stream_click_counts(spark, sf_dir):
    product = F.get_json_object("props", "$.k").cast("bigint").alias("product")
    clicks = _events(spark, sf_dir).where(F.col("event_type") == "click").select("ts", product)
    out = run_to_table(W.click_counts(clicks, ["product"]), "clicks")
    return out.select(_seconds("window_start"), "product", "n")


@query(
    "stream_sliding",
    f"""
    WITH spread AS (
      SELECT event_type, time_bucket(INTERVAL '15 minutes', ts) - i * INTERVAL '15 minutes' AS s
      FROM events, (SELECT unnest([0, 1, 2, 3]) AS i))
    SELECT CAST(epoch(s) AS BIGINT) AS window_start, event_type, count(*) AS n FROM spread
    GROUP BY s, event_type HAVING epoch_ms(s) + 3600000 <= {_ALL}
    """,
)
def stream_sliding(spark, sf_dir):
    events = _events(spark, sf_dir).select("ts", "event_type")
    out = run_to_table(W.sliding_counts(events, ["event_type"]), "sliding")
    return out.select(_seconds("window_start"), "event_type", "n")


@query(
    "stream_sessions",
    f"""
    WITH seen AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
         s AS (SELECT *, sum(CASE WHEN epoch_us(ts) - epoch_us(p) > 1800000000 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM seen)
    SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n
    FROM s GROUP BY user_id, session HAVING epoch_us(max(ts)) + 1800000000 <= {_ALL} * 1000
    """,
)
def stream_sessions(spark, sf_dir):
    events = _events(spark, sf_dir).select("ts", "user_id")
    out = run_to_table(W.stream_sessions(events, "user_id"), "sessions")
    first, last = F.unix_micros("first_ts"), F.unix_micros("last_ts")
    return out.select("user_id", first.alias("first_us"), last.alias("last_us"), "n")


@query("stream_dedup", "SELECT DISTINCT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    twice = events.union(events)  # a retry sends everything again
    out = run_to_table(W.stream_dedup(twice, ["event_id"]), "dedup")
    return out.select("event_id", "user_id", "event_type")


@query(
    "stream_late_data",
    f"""
    WITH early AS (SELECT * FROM events WHERE event_type <> 'purchase'),
         late AS (SELECT * FROM events WHERE event_type = 'purchase'),
         w AS (SELECT {_WATERMARK.format(rows="early")} * 1000 AS us)
    SELECT 'kept' AS kind, (SELECT count(*) FROM early)
             + (SELECT count(*) FROM late, w WHERE epoch_us(ts) > us) AS n
    UNION ALL
    SELECT 'dropped', (SELECT count(*) FROM late, w WHERE epoch_us(ts) <= us)
    """,
)
def stream_late_data(spark, sf_dir):
    """The purchases arrive after all else; those the watermark has passed go to a table of their own."""
    events = load(spark, sf_dir, "events")
    home = new_folder(spark, "late")
    src, table = f"{home}/src", f"{home}/table"
    for late in (False, True):
        part = events.where((F.col("event_type") == "purchase") == F.lit(late))
        part.write.mode("append").parquet(src)
        arriving = event_stream(spark, src)
        split_late(arriving, f"{home}/split", f"{home}/splitting")
        unique = W.stream_dedup(in_time(arriving, f"{home}/split"), ["event_id"])
        run_available(unique, f"{home}/checkpoint", table)
    kept = spark.read.parquet(table).select(F.lit("kept").alias("kind"))
    dropped = late_table(arriving, f"{home}/split").select(F.lit("dropped").alias("kind"))
    found = kept.union(dropped).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    kinds = literal(spark, [("kept",), ("dropped",)], "kind string")
    return kinds.join(found, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "stream_stateful_chain",
    f"""
    WITH seen AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
                  FROM events)
    SELECT user_id, event_id, value, prev FROM seen
    WHERE value > prev AND epoch_us(ts) <= {_ALL} * 1000
    """,
)
def stream_stateful_chain(spark, sf_dir):
    rising = increases_on(_events(spark, sf_dir), "user_id", "event_id", "value")
    return run_to_table(rising, "increases")


@query("stream_medallion", GOLD_SQL)
def stream_medallion(spark, sf_dir):
    home = new_folder(spark, "medallion")
    served = run_medallion(spark, sf_dir, f"{home}/out", f"{home}/checkpoint", "events.parquet")
    return served.select(
        text_of("day"), "event_type", "events", "users", number_of("value"), "max_k"
    )
