"""Joins: value comparison, null-aware join counts."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.plans.lanes import CHUNK, Lane, lay_out, with_running
from lanewise.plans.lookups import BROADCAST_BYTES, attach, byte_size
from lanewise.plans.spans import explode_span
from lanewise.sources.tables import require

PAIRS = 1 << 25  # of rows that one task of a value comparison may meet, if the right side is broadcast
TASKS = 1 << 16  # of such a join at most; beyond, they meet more
RUN = 256  # right rows that the left rows of a task meet one after the other
STRIP = 8  # runs that a task meets at least, if it has them


def theta_join(
    left: DataFrame,
    right: DataFrame,
    left_val: str,
    right_val: str,
    buckets: int = 32,
    salts: int = 4,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All pairs with ``left_val > right_val``, by equality on value buckets.

    The range of the right values is cut into equal buckets. A left row is sent
    to its own bucket and those below, a right row to its own only, so each pair
    meets exactly once and nothing is compared that lies in a higher bucket.
    A right side of up to ``max_bytes`` is broadcast and the pairs are dealt over
    tasks by the number there may be, as few bytes can make many (see ``_met_in_runs``).
    Beyond that bucket and salt form the join key: both sides may be large, and the rows of
    a crowded bucket spread over ``salts`` tasks. The bucket rule depends only
    on the exact minimum and maximum, never on a sample.
    """
    require(left, left_val)
    require(right, right_val)
    number = F.col(right_val).cast("double")
    finite = F.when(F.abs(number) < float("inf"), number)
    least, low, high = right.agg(F.min(right_val), F.min(finite), F.max(finite)).first()

    def bucket(col: str):
        """Grows with the value in double precision: never above the bucket of a larger value."""
        value = F.col(col).cast("double")
        share = (value - F.lit(low)) / F.nullif(F.lit(high) - F.lit(low), F.lit(0.0))
        at = F.floor(F.coalesce(share, F.lit(0.0)) * buckets)
        return F.when(F.isnan(value), F.lit(buckets - 1)).otherwise(
            F.greatest(F.least(at, F.lit(buckets - 1)), F.lit(0))
        ).cast("bigint")

    others = left.columns
    sent = left.where(F.col(left_val) > F.lit(least))
    kept = right.where(F.col(right_val).isNotNull()).withColumn("_bucket", bucket(right_val))
    if byte_size(right) <= max_bytes:
        return _met_in_runs(sent, kept, left_val, right_val, bucket(left_val), buckets)
    reached = F.explode(F.sequence(F.lit(0).cast("bigint"), bucket(left_val)))
    salted = F.pmod(F.xxhash64(*others), F.lit(salts))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    sent = sent.withColumns({"_bucket": reached, "_salt": salted})
    pairs = sent.join(kept.withColumn("_salt", copies), ["_bucket", "_salt"])
    return pairs.where(F.col(left_val) > F.col(right_val)).drop("_bucket", "_salt")


def _met_in_runs(
    left: DataFrame, right: DataFrame, left_val: str, right_val: str, reached: Column, buckets: int
) -> DataFrame:
    """The pairs of a value comparison with a broadcast right side that has its ``_bucket``.

    Right rows are numbered by bucket and value and cut into runs of ``RUN``; a left row meets the
    runs up to the end of the bucket it has ``reached``. All left rows of a task meet one run before
    any meets the next, and a task has few runs: what is written repeats within a page and names few
    values, so files are small. Nothing repeats if a left row meets all right rows before the next does.
    """
    counts = dict(right.groupBy("_bucket").count().collect())
    below = [0, *accumulate(counts.get(b, 0) for b in range(buckets))]
    upto = F.array(*(F.lit(x).cast("bigint") for x in below))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(right_val))
    run = F.floor((F.get(upto, F.col("_bucket").cast("int")) + place - 1) / RUN)
    last = F.floor((F.get(upto, reached.cast("int") + 1) - 1) / RUN)
    runs = -(-below[-1] // RUN)
    tasks = min(-(-left.count() * below[-1] // PAIRS), TASKS)
    strips = max(min(tasks, -(-runs // STRIP)), 1)
    parts = -(-tasks // strips)
    first, end = F.lit(0).cast("bigint"), last
    if parts > 1:
        left = left.repartition(parts)
    if strips > 1:
        wide = -(-runs // strips)
        part = F.spark_partition_id() if parts > 1 else F.lit(0)
        left = left.withColumn("_strip", F.explode(F.sequence(first, F.floor(last / wide))))
        left = left.withColumn("_tile", (part * strips + F.col("_strip")).cast("int"))
        left = left.repartitionById(parts * strips, "_tile")
        first = F.col("_strip") * wide
        end = F.least(last, first + (wide - 1))
    met = left.withColumn("_run", F.explode(F.sequence(first, end))).drop("_strip", "_tile")
    if runs > 1:
        # the filter keeps all rows; without it the optimizer drops an order below a join
        met = met.sortWithinPartitions("_run", F.desc(left_val)).where(F.spark_partition_id() >= 0)
    pairs = met.join(F.broadcast(right.withColumn("_run", run).drop("_bucket")), "_run")
    return pairs.where(F.col(left_val) > F.col(right_val)).drop("_run")


def theta_counts(
    left: DataFrame, right: DataFrame, left_val: str, right_val: str, cell: str | None = None
) -> DataFrame:
    """Per left row, how many right rows are smaller, without building pairs.

    The answer depends on the value only, so values are counted first and
    ordered once each, however often they repeat. ``cell`` is the lane cell over
    the column ``_val``; counted if not given. Null values compare with nothing and count none.
    """
    require(left, left_val)
    require(right, right_val)
    asked = left.select(F.col(left_val).alias("_val"), F.lit(0).cast("bigint").alias("_n"))
    known = right.select(F.col(right_val).alias("_val"), F.lit(1).cast("bigint").alias("_n"))
    values = asked.unionByName(known).where(F.col("_val").isNotNull())
    values = values.groupBy("_val").agg(F.sum("_n").alias("_n"))
    lane = Lane((), ("_val",), cell)
    upto = with_running(lay_out(values, lane), lane, {"_upto": ("sum", "_n")})
    smaller = upto.select(
        F.col("_val").alias(left_val), (F.col("_upto") - F.col("_n")).alias("n_smaller")
    )
    found = left.join(smaller, left_val, "left")
    return found.withColumn("n_smaller", F.coalesce("n_smaller", F.lit(0).cast("bigint")))


def with_positions(right: DataFrame, right_val: str, right_id: str, alias: str = "position") -> DataFrame:
    """Rows whose value is known, numbered from 1 by value, then id, which must be unique.

    A left row of ``n_smaller`` (see ``theta_counts``) is joined by ``left_val > right_val``
    with exactly the positions 1 to ``n_smaller``: the pairs as one interval a row.
    """
    require(right, right_val, right_id)
    lane = Lane((), (right_val, right_id))
    known = right.where(F.col(right_val).isNotNull()).withColumn("_one", F.lit(1))
    numbered = with_running(lay_out(known, lane), lane, {alias: ("count", "_one")})
    return numbered.drop("_one", CHUNK)


def at_positions(left: DataFrame, ranked: DataFrame, start: str, end: str, position: str = "position") -> DataFrame:
    """The pairs of the left rows given: one row for each position from ``start`` to ``end``.

    Any number of left rows may ask for one position: the ranked rows, unique on it, are
    joined as a size-checked lookup.
    """
    require(left, start, end)
    return attach(explode_span(left, start, end, position), ranked, [position])


def join_counts(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Row count of ``left JOIN right USING (on)`` without building the rows.

    Each side is first counted per key, so a key with many rows on both sides
    costs one joined row instead of their product. Null keys match nothing and
    survive only on an outer side.
    """
    l_n = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_l"))
    r_n = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r"))
    rows = F.coalesce(F.col("_l"), F.lit(1)) * F.coalesce(F.col("_r"), F.lit(1))
    joined = l_n.join(r_n, on, how)
    return joined.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("row_count"))
