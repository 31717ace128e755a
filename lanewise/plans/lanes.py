"""Ordered work per key that stays parallel when one key holds most rows.

``Window.partitionBy(key)`` puts a whole key into one task. A *lane* says how
to cut a heavy key instead: ``cell`` maps the order column to a coarse integer
that never decreases along the order, such as the day of a timestamp. Rows of a
heavy key are windowed per (key, cell); what the cells before contribute comes
from one summary row per cell and is joined back as a carry. Light keys keep a
null chunk, so they form one window partition each, exactly as without lanes.

Heavy keys are found by counting: the ``max_heavy`` largest of those with more
than ``min_rows`` rows. Their number is bounded however large the input grows,
which is what makes broadcasting them safe, and a key left out holds less than
``1 / max_heavy`` of all rows. When there are none, adaptive execution sees the
empty broadcast and drops every carry join: the plan that runs is the plain
one-shuffle window.

A lane without a cell gets cells of equal numbers of rows, counted over the rows of
heavy keys; what is heavy is then known before the plan is made, and without heavy
keys the plan is the plain window itself.

A lane without a key orders the whole table. Then every row has a chunk. Summaries of
counted cells, of which there is a bounded number, meet in one task; those of given
cells are summed up by ``SPAN`` cells at a time, and these summaries of summaries meet.

Where many rows may share one given cell, ``cell`` can be a tuple: a second expression
cuts the rows that agree on the first. The first must then be the leading order
column itself, or the cells would not follow the order.

Null keys form a group of their own, as in a window, and are cut like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lanewise.plans.cells import counted_cells
from lanewise.plans.lookups import join_null_safe
from lanewise.sources.tables import require

CHUNK = "_chunk"
BELOW = "_below"
FEW = 1_000_000  # rows among which no key is looked for
SPAN = 256  # cells of a lane without a key that are scanned as one


@dataclass(frozen=True)
class Lane:
    key: tuple[str, ...]
    order: tuple[str, ...]  # ascending; must be unique within the key
    cell: str | tuple[str, ...] | None = None  # SQL, never decreasing along ``order``; counted if not given
    min_rows: int = 1_000_000
    max_heavy: int = 10_000
    bounded: bool = False  # no key can be large: rows are, say, one per calendar day

    @property
    def chunk(self) -> list[str]:
        return [*self.key, CHUNK]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.chunk).orderBy(*self.order)

    def across(self) -> WindowSpec:
        """The chunks of one key in order; one summary row per chunk."""
        return Window.partitionBy(*self.key).orderBy(CHUNK)

    @property
    def above(self) -> Lane | None:
        """The lane over this one's summaries; none if one task holds the summaries of a key."""
        if self.key or self.bounded or self.order == (BELOW,) or not isinstance(self.cell, str):
            return None  # of counted cells there are never many
        return Lane((), (BELOW,), f"{BELOW} div {SPAN}")


def day_cell(col: str) -> str:
    return f"cast(unix_date(cast({col} as date)) as bigint)"


def minute_cell(col: str, minutes: int = 10) -> str:
    """Cells of a few minutes, by the clock of the session zone, which must be UTC
    (elsewhere the clock is set back once a year)."""
    return (
        f"(unix_date(cast({col} as date)) * 1440L + hour({col}) * 60 + minute({col}))"
        f" div {minutes}"
    )


def number_cell(col: str, width: float) -> str:
    """Cells of equal width; infinities and NaN, the largest number, have cells of their own."""
    return (
        f"CASE WHEN isnan(cast({col} as double)) THEN {2**63 - 1}"
        f" ELSE cast(floor({col} / {width}) as bigint) END"
    )


def heavy_keys(df: DataFrame, key: tuple[str, ...], min_rows: int, max_heavy: int) -> DataFrame:
    """The ``max_heavy`` largest keys of more than ``min_rows`` rows.

    The key breaks ties, so that every branch of a plan finds the same ones.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_rows)
    return counts.orderBy(F.desc("_n"), *key).limit(max_heavy).select(*key)


def _cell(lane: Lane, df: DataFrame) -> Column:
    if lane.cell is None:
        found = counted_cells(df, lane.order)
        return F.lit(None).cast("bigint") if found is None else found
    if isinstance(lane.cell, str):
        return F.coalesce(F.expr(lane.cell).cast("bigint"), F.lit(-(2**63)))
    return F.struct(*[F.expr(c).alias(f"c{i}") for i, c in enumerate(lane.cell)])


def lay_out(df: DataFrame, lane: Lane, basis: DataFrame | None = None) -> DataFrame:
    """Add the chunk column: the cell for heavy keys, null for light ones.

    Keys are counted on ``basis`` where a cheaper table has as many rows per key.
    """
    require(df, *lane.key, *lane.order)
    if lane.bounded:
        return df.withColumn(CHUNK, F.lit(None).cast("bigint"))
    if not lane.key:
        return df.withColumn(CHUNK, _cell(lane, df))
    counted = df if basis is None else basis
    heavy = heavy_keys(counted, lane.key, lane.min_rows, lane.max_heavy)
    if lane.cell is None:
        # a count of rows reads less than one by key
        found = heavy.collect() if counted.count() > min(lane.min_rows, FEW) else []  # at most max_heavy keys
        if not found:
            return df.withColumn(CHUNK, F.lit(None).cast("bigint"))
        heavy = df.sparkSession.createDataFrame(found, heavy.schema)
        cell = _cell(lane, join_null_safe(df, F.broadcast(heavy), list(lane.key), "left_semi"))
    else:
        cell = _cell(lane, df)
    heavy = heavy.withColumn("_heavy", F.lit(True))
    return (
        join_null_safe(df, F.broadcast(heavy), list(lane.key), "left")
        .withColumn(CHUNK, F.when(F.col("_heavy"), cell))
        .drop("_heavy")
    )


def _chunked(laid: DataFrame) -> DataFrame:
    return laid.where(F.col(CHUNK).isNotNull())


def _give(laid: DataFrame, carry: DataFrame, lane: Lane) -> DataFrame:
    return join_null_safe(laid, carry, list(lane.key), "left", plain=[CHUNK])


def _lifted(summary: DataFrame, lane: Lane) -> DataFrame:
    """A summary as rows of the lane above."""
    return lay_out(summary.withColumnRenamed(CHUNK, BELOW), lane.above)


def _lowered(laid: DataFrame) -> DataFrame:
    return laid.drop(CHUNK).withColumnRenamed(BELOW, CHUNK)


def _ahead(summary: DataFrame, lane: Lane, col: str, alias: str) -> DataFrame:
    """Add ``col`` of the chunk before."""
    if lane.above is None:
        return summary.withColumn(alias, F.lag(col).over(lane.across()))
    return _lowered(with_previous(_lifted(summary, lane), lane.above, {alias: col}))


def _behind(tails: DataFrame, lane: Lane, n: int, alias: str) -> DataFrame:
    """Add the last ``n`` elements of the chunks before, nearest first, from their ``_tail`` arrays.

    ``n`` chunks hold ``n`` rows or more, since no chunk is empty.
    """
    if lane.above is None:
        kind = tails.schema["_tail"].dataType.simpleString()
        empty = F.array().cast(kind)
        behind = [F.coalesce(F.lag("_tail", i).over(lane.across()), empty) for i in range(1, n + 1)]
        return tails.withColumn(alias, F.slice(F.concat(*behind), 1, n))
    seen = _lowered(with_back(_lifted(tails, lane), lane.above, "_tail", n, "_tails"))
    nearest = F.slice(F.flatten(F.transform("_tails", lambda x: x["v"])), 1, n)
    return seen.withColumn(alias, nearest).drop("_tails")


def _before(summary: DataFrame, lane: Lane, folds: dict[str, tuple[str, str]]) -> DataFrame:
    """Add running aggregates over the chunks before: ``folds`` maps an alias to (function, column)."""
    if lane.above is None:
        before = lane.across().rowsBetween(Window.unboundedPreceding, -1)
        return summary.withColumns({a: _fold(fn, c).over(before) for a, (fn, c) in folds.items()})
    shifted = {f"_shifted_{a}": c for a, (_, c) in folds.items()}
    lagged = with_previous(_lifted(summary, lane), lane.above, shifted)
    total = {a: (fn, f"_shifted_{a}") for a, (fn, _) in folds.items()}
    return _lowered(with_running(lagged, lane.above, total)).drop(*shifted)


def _fold(fn: str, col: str) -> Column:
    if fn == "last":
        return F.last(col, ignorenulls=True)
    return {"sum": F.sum, "min": F.min, "max": F.max}[fn](col)


def _lagged(laid: DataFrame, lane: Lane, cols: dict[str, str], i: int = 1) -> Column:
    """A struct of the values ``i`` rows before, inside the chunk; null before its first row.

    Built from plain columns, so that the shuffle carries no structs.
    """
    w = lane.window()
    values = F.struct(*[F.lag(c, i).over(w).alias(a) for a, c in cols.items()])
    return F.when(F.lag(F.lit(True), i).over(w), values)


def with_previous(laid: DataFrame, lane: Lane, cols: dict[str, str]) -> DataFrame:
    """Add ``alias -> column`` taken from the row before; null on the first."""
    here = F.struct(*[F.col(c).alias(a) for a, c in cols.items()])
    last = F.max(F.struct(F.struct(*lane.order).alias("at"), here.alias("row")))
    summary = _chunked(laid).groupBy(*lane.chunk).agg(last.alias("_last"))
    summary = summary.select(*lane.chunk, F.col("_last.row").alias("_row"))
    carry = _ahead(summary, lane, "_row", "_carry").select(*lane.chunk, "_carry")
    out = _give(laid.withColumn("_before", _lagged(laid, lane, cols)), carry, lane)
    out = out.withColumn("_before", F.coalesce("_before", "_carry"))
    kept = [c for c in laid.columns if c not in cols]
    return out.select(*kept, *[F.col(f"_before.{a}").alias(a) for a in cols])


def with_back(laid: DataFrame, lane: Lane, col: str, n: int, alias: str) -> DataFrame:
    """Add an array of the (at most ``n``) values before, nearest first.

    Each element is a struct with field ``v``, so null values keep their place.
    """
    here = F.struct(F.col(col).alias("v"))
    from_end = Window.partitionBy(*lane.chunk).orderBy(*[F.desc(c) for c in lane.order])
    empty = F.array().cast(f"array<struct<v:{laid.schema[col].dataType.simpleString()}>>")
    tails = (
        _chunked(laid)
        .withColumn("_rn", F.row_number().over(from_end))
        .where(F.col("_rn") <= n)
        .groupBy(*lane.chunk)
        .agg(F.array_sort(F.collect_list(F.struct("_rn", here.alias("row")))).alias("_tail"))
        .withColumn("_tail", F.col("_tail.row"))
    )
    carry = _behind(tails, lane, n, "_carry").select(*lane.chunk, "_carry")
    lags = [_lagged(laid, lane, {"v": col}, i) for i in range(1, n + 1)]
    near = F.array_compact(F.array(*lags))
    out = _give(laid.withColumn("_near", near), carry, lane)
    whole = F.slice(F.concat("_near", F.coalesce("_carry", empty)), 1, n)
    return out.withColumn(
        alias, F.when(F.col("_carry").isNull(), F.col("_near")).otherwise(whole)
    ).drop("_near", "_carry")


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def with_running(laid: DataFrame, lane: Lane, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add running aggregates up to and including each row.

    ``aggs`` maps an alias to (function, column); functions are ``sum``,
    ``count``, ``min``, ``max`` and ``last`` (latest value that is not null).
    """
    frame = lane.window().rowsBetween(Window.unboundedPreceding, 0)
    totals, folds, inside = [], {}, {}
    for alias, (fn, col) in aggs.items():
        part, c = f"_part_{alias}", F.col(col)
        if fn == "last":
            seen = F.when(c.isNotNull(), F.struct(*lane.order))
            totals.append(F.max_by(c, seen).alias(part))
            inside[alias] = F.last(c, ignorenulls=True).over(frame)
        else:
            agg = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[fn]
            totals.append(agg(c).alias(part))
            inside[alias] = agg(c).over(frame)
        folds[f"_carry_{alias}"] = ("sum" if fn == "count" else fn, part)
    summary = _chunked(laid).groupBy(*lane.chunk).agg(*totals)
    carry = _before(summary, lane, folds).select(*lane.chunk, *folds)
    out = _give(laid.withColumns({f"_in_{a}": e for a, e in inside.items()}), carry, lane)
    join = {
        "sum": _plus,
        "count": _plus,
        "min": F.least,
        "max": F.greatest,
        "last": lambda a, b: F.coalesce(a, b),
    }
    return out.withColumns(
        {a: join[fn](F.col(f"_in_{a}"), F.col(f"_carry_{a}")) for a, (fn, _) in aggs.items()}
    ).drop(*[f"_in_{a}" for a in aggs], *[f"_carry_{a}" for a in aggs])


def with_run_number(
    laid: DataFrame,
    lane: Lane,
    cols: list[str],
    starts: Callable[[Column, Column], Column],
    first: int,
    alias: str,
) -> DataFrame:
    """Number the runs of each key; its first row has the number ``first``.

    ``starts(before, here)`` says whether a row opens a run, from the structs of
    ``cols`` of the row before and of the row itself. A chunk is summed up by its
    first and last row and the runs opened inside, so one carry serves both the
    comparison across its border and the count.
    """
    here = F.struct(*cols)
    before = F.struct(*[F.col(f"_before_{c}").alias(c) for c in cols])
    lags = {f"_before_{c}": F.lag(c).over(lane.window()) for c in cols}
    marked = laid.withColumns({**lags, "_follows": F.lag(F.lit(True)).over(lane.window())})
    opened = F.col("_follows") & F.coalesce(starts(before, here), F.lit(False))
    marked = marked.withColumn("_opened", F.when(opened, 1).otherwise(0).cast("bigint"))
    at = F.struct(F.struct(*lane.order).alias("at"), here.alias("row"))
    summary = (
        _chunked(marked)
        .groupBy(*lane.chunk)
        .agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.sum("_opened").alias("_inside"))
        .select(*lane.chunk, "_first", F.col("_last.row").alias("_row"), "_inside")
    )
    summary = _ahead(summary, lane, "_row", "_ahead")
    border = F.coalesce(starts(F.col("_ahead"), F.col("_first.row")), F.lit(False))
    border = F.when(F.col("_ahead").isNull(), F.lit(first)).otherwise(border.cast("int"))
    summary = summary.select(*lane.chunk, border.cast("bigint").alias("_border"), "_inside")
    summary = summary.withColumn("_opened", F.col("_border") + F.col("_inside"))
    summary = _before(summary, lane, {"_so_far": ("sum", "_opened")})
    so_far = F.coalesce("_so_far", F.lit(0)) + F.col("_border")
    carry = summary.select(*lane.chunk, so_far.alias("_carry"))
    within = F.sum("_opened").over(lane.window().rowsBetween(Window.unboundedPreceding, 0))
    out = _give(marked.withColumn("_within", within), carry, lane)
    number = F.col("_within") + F.coalesce("_carry", F.lit(first))
    return out.withColumn(alias, number).drop(
        *lags, "_follows", "_opened", "_within", "_carry"
    )


def with_moving(laid: DataFrame, lane: Lane, col: str, n: int, alias: str) -> DataFrame:
    """Add the mean of the current and the ``n - 1`` rows before.

    Window frames do the work; only the first ``n - 1`` rows of a chunk look
    into the carry.
    """
    if n == 1:
        return laid.withColumn(alias, F.col(col).cast("double"))
    frame = lane.window().rowsBetween(-(n - 1), 0)
    laid = laid.withColumns(
        {
            "_sum": F.sum(col).over(frame),
            "_cnt": F.count(col).over(frame),
            "_pos": F.row_number().over(lane.window()),
        }
    )
    from_end = Window.partitionBy(*lane.chunk).orderBy(*[F.desc(c) for c in lane.order])
    tails = (
        _chunked(laid)
        .withColumn("_rn", F.row_number().over(from_end))
        .where(F.col("_rn") < n)
        .groupBy(*lane.chunk)
        .agg(F.array_sort(F.collect_list(F.struct("_rn", F.col(col).alias("v")))).alias("_tail"))
    )
    carry = _behind(tails, lane, n - 1, "_carry").select(*lane.chunk, "_carry")
    out = _give(laid, carry, lane)
    missing = F.slice("_carry", F.lit(1), F.greatest(F.lit(n) - F.col("_pos"), F.lit(0)))
    kind = laid.schema["_sum"].dataType.simpleString()
    needed = F.col("_carry").isNotNull() & (F.col("_pos") < n)
    extra_sum = F.aggregate(
        missing, F.lit(0).cast(kind), lambda a, x: (a + F.coalesce(x["v"], F.lit(0))).cast(kind)
    )
    extra_cnt = F.size(F.filter(missing, lambda x: x["v"].isNotNull()))
    total = F.when(needed, F.coalesce("_sum", F.lit(0)) + extra_sum).otherwise(F.col("_sum"))
    count = F.when(needed, F.col("_cnt") + extra_cnt).otherwise(F.col("_cnt"))
    mean = total.cast("double") / F.nullif(count, F.lit(0))
    return out.withColumn(alias, mean).drop("_sum", "_cnt", "_pos", "_carry")
