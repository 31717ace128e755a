"""Customer and membership analytics."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.plans.lanes import CHUNK, Lane, lay_out, with_running
from lanewise.plans.lookups import join_null_safe
from lanewise.session import shared_dir
from lanewise.sources.tables import require


def equal_groups(
    df: DataFrame, order: tuple[str, ...], cell: str | tuple[str, ...], k: int, alias: str
) -> DataFrame:
    """Groups 1 to ``k`` of equal size over the whole table, as ``ntile`` forms them.

    The row number comes from a keyless lane, so no task sorts the whole table.
    """
    lane = Lane((), order, cell)
    total = df.select(F.count(F.lit(1))).scalar()
    numbered = with_running(
        lay_out(df.withColumn("_one", F.lit(1)), lane), lane, {"_row": ("count", "_one")}
    )
    sized = numbered.withColumn("_total", total)
    sized = sized.withColumns({"_size": F.expr(f"_total div {k}"), "_extra": F.col("_total") % k})
    # the first groups take one row more each
    big = F.expr("(_row - 1) div (_size + 1) + 1")
    small = F.expr("_extra + (_row - 1 - _extra * (_size + 1)) div greatest(_size, 1L) + 1")
    group = F.when(F.col("_row") <= F.col("_extra") * (F.col("_size") + 1), big).otherwise(small)
    return sized.withColumn(alias, group.cast("bigint")).drop(
        "_one", "_row", "_total", "_size", "_extra", CHUNK
    )


def _after(x: Column, y: Column) -> Column:
    """``x > y`` where null comes first."""
    return F.coalesce(x > y, x.isNotNull() & y.isNull())


def border_groups(df: DataFrame, metrics: dict[str, str], key: str, k: int) -> DataFrame:
    """Groups 1 to ``k`` of equal size over the whole table, as ``ntile`` forms them.

    ``metrics`` names the column behind each new group column; they share a type. Rows are
    ordered by the metric, ascending with null first, then by ``key``, unique in the table.
    No row is numbered that need not be: counts by value, added up in order, tell which
    value holds the last row of a group. Only values that straddle such a border are put
    in order, to find the row at it. A row's group is the number of border rows before it,
    at most ``k - 1`` a metric, so the table itself is neither sorted nor shuffled.
    """
    require(df, key, *metrics.values())
    size, extra = divmod(df.count(), k)
    ends = sorted({j * size + min(j, extra) for j in range(1, k)} - {0})
    if not ends:
        return df.withColumns({alias: F.lit(1).cast("bigint") for alias in metrics})
    columns = F.array(*[F.col(c) for c in metrics.values()])
    long = df.select(F.col(key).alias("_key"), F.posexplode(columns).alias("_metric", "_value"))
    counts = long.groupBy("_metric", "_value").agg(F.count(F.lit(1)).alias("_n"))
    by_value = Lane(("_metric",), ("_value",))
    summed = with_running(lay_out(counts, by_value), by_value, {"_last": ("sum", "_n")})
    at_border = reduce(or_, [(F.col("_last") >= e) & (F.col("_last") - F.col("_n") < e) for e in ends])
    # a value for each border at most; (metric, value, rank within the value, whether it ends there)
    borders = [
        (row["_metric"], row["_value"], e - row["_last"] + row["_n"], e == row["_last"])
        for row in summed.where(at_border).select("_metric", "_value", "_n", "_last").collect()
        for e in ends
        if row["_last"] - row["_n"] < e <= row["_last"]
    ]
    kind, key_kind = df.schema[next(iter(metrics.values()))].dataType, df.schema[key].dataType
    value = lambda v: F.lit(v).cast(kind)
    inside = [b for b in borders if not b[3]]
    keys = {}
    if inside:
        held = reduce(or_, [(F.col("_metric") == m) & F.col("_value").eqNullSafe(value(v)) for m, v, _, _ in inside])
        by_key = Lane(("_metric", "_value"), ("_key",))
        crowd = long.where(held).withColumn("_one", F.lit(1))
        numbered = with_running(lay_out(crowd, by_key), by_key, {"_rank": ("count", "_one")})
        wanted = [
            (F.col("_metric") == m) & F.col("_value").eqNullSafe(value(v)) & (F.col("_rank") == r)
            for m, v, r, _ in inside
        ]
        for row in numbered.where(reduce(or_, wanted)).select("_metric", "_value", "_rank", "_key").collect():
            keys[row["_metric"], row["_value"], row["_rank"]] = row["_key"]

    def group(number: int, column: str) -> Column:
        out = F.lit(1).cast("bigint")
        for m, v, r, whole in borders:
            if m != number:
                continue
            beyond = _after(F.col(column), value(v))
            if not whole:
                later = _after(F.col(key), F.lit(keys[m, v, r]).cast(key_kind))
                beyond |= F.col(column).eqNullSafe(value(v)) & later
            out += beyond.cast("bigint")
        return out

    return df.withColumns({alias: group(i, c) for i, (alias, c) in enumerate(metrics.items())})


def rfm(orders: DataFrame, lines: DataFrame, as_of: str) -> DataFrame:
    """Recency, frequency, spend and variety per customer, with quintiles (5 best)."""
    require(orders, "o_orderkey", "o_custkey", "o_orderdate", "amount")
    require(lines, "l_orderkey", "l_partkey")
    base = orders.groupBy("o_custkey").agg(
        F.datediff(F.lit(as_of).cast("date"), F.to_date(F.max("o_orderdate")))
        .cast("bigint")
        .alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("amount").alias("spend"),
    )
    owner = orders.select("o_orderkey", "o_custkey")
    variety = (
        lines.select("l_orderkey", "l_partkey")
        .join(owner, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.countDistinct("l_partkey").alias("variety"))
    )
    scored = join_null_safe(base, variety, ["o_custkey"], "left").withColumns(
        {"variety": F.coalesce("variety", F.lit(0)), "_older": -F.col("recency")}
    )
    # one row per customer, written once: counts and borders are taken from it
    shared_dir(orders.sparkSession)
    metrics = {"r_group": "_older", "f_group": "frequency", "v_group": "variety"}
    return border_groups(scored.checkpoint(), metrics, "o_custkey", 5).drop("_older")


def turnover(orders: DataFrame, as_of: str, months: int = 6) -> DataFrame:
    """Spend per customer in the ``months`` up to and including ``as_of``."""
    require(orders, "o_custkey", "o_orderdate", "amount")
    kind = orders.schema["o_orderdate"].dataType
    day = F.lit(as_of).cast("date")
    recent = orders.where(
        (F.col("o_orderdate") > F.add_months(day, -months).cast(kind))
        & (F.col("o_orderdate") < F.date_add(day, 1).cast(kind))
    )
    return recent.groupBy("o_custkey").agg(F.sum("amount").alias("turnover"))


def dwell(df: DataFrame, lane: Lane, ts: str, kind: str, start: str, end: str) -> DataFrame:
    """Time from each start event to the next end event, summed per key.

    Rows between two end events share the number of ends before them, and so do
    the starts that the later one closes; each such stretch is one combining
    aggregate: starts times end minus the sum of the starts.
    """
    require(df, ts, kind)
    rows = df.select(*{*lane.key, *lane.order, ts, kind})
    rows = rows.where(F.col(kind).isin(start, end))
    rows = rows.withColumns(
        {
            "_is_end": (F.col(kind) == end).cast("bigint"),
            "_us": F.unix_micros(F.col(ts).cast("timestamp")),
        }
    )
    seen = with_running(lay_out(rows, lane), lane, {"_ends": ("sum", "_is_end")})
    stretch = (F.col("_ends") - F.col("_is_end")).alias("_stretch")
    begun = F.col(kind) == start
    spans = seen.groupBy(*lane.key, stretch).agg(
        F.count_if(begun).alias("_starts"),
        F.sum(F.when(begun, F.col("_us")).cast("decimal(38,0)")).alias("_sum"),
        F.max(F.when(F.col("_is_end") == 1, F.col("_us"))).alias("_end"),
    )
    closed = spans.where(F.col("_end").isNotNull() & (F.col("_starts") > 0))
    micros = F.col("_starts").cast("decimal(18,0)") * F.col("_end").cast("decimal(18,0)")
    return closed.groupBy(*lane.key).agg(
        F.sum("_starts").alias("visits"),
        F.sum((micros - F.col("_sum")).cast("bigint")).alias("dwell_micros"),
    )


def latest_consent(df: DataFrame, key: str, order: list[str], given) -> DataFrame:
    """Keys whose most recent consent record says yes."""
    last = df.groupBy(key).agg(F.max_by(given, F.struct(*order)).alias("_yes"))
    return last.where("_yes").select(key)


def with_consent(df: DataFrame, consent: DataFrame, key: list[str]) -> DataFrame:
    """Rows of consenting keys; adaptive execution splits a crowded key."""
    return df.join(consent, key, "left_semi")


def recommend_topk(orders: DataFrame, lines: DataFrame, customers: DataFrame, k: int) -> DataFrame:
    """The ``k`` parts most customers of a segment bought.

    Built on distinct buyers per part, which grows with the lines; pairs of
    parts inside an order would grow with the square of the largest order.
    """
    buys = (
        lines.select("l_orderkey", "l_partkey")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey", "l_partkey")
        .distinct()
        .join(
            customers.select("c_custkey", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
    )
    buyers = buys.groupBy("c_mktsegment", "l_partkey").agg(F.count(F.lit(1)).alias("buyers"))
    best = Window.partitionBy("c_mktsegment").orderBy(F.desc("buyers"), "l_partkey")
    ranked = buyers.withColumn("place", F.row_number().over(best).cast("bigint"))
    return ranked.where(F.col("place") <= k)
