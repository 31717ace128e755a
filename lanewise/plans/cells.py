"""Cells of about equal numbers of rows along an order, found by counting.

Rows picked by a hash of their order columns say where a cell may begin; all rows
are then counted by cell, and a cell that holds too many is split again, as fine as
its count asks for. A cell begins at a whole tuple of the order columns, so a crowded
first column is cut by the next. The borders become part of the plan as constants:
every branch, and every retry, cuts the data in the same places.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 8192  # of a cell, as long as there are no more than CELLS
CELLS = 16_384  # beyond, cells grow with the table
PICKED = 16  # rows picked for each cell
CROWDED = 4  # times its share that a cell may hold
CHECKED = 64  # with fewer cells, no cell is counted: a task could take all rows
ROUNDS = 8  # of splitting; a cell of equal tuples can't be split


def _sortable(df: DataFrame, col: str) -> tuple[Column, str]:
    """A column of the same order that JSON can carry, and its type."""
    kind = df.schema[col].dataType.simpleString()
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(col).cast("timestamp")), "bigint"
    if kind == "date":
        return F.unix_date(col), "int"
    if kind == "boolean":
        return F.col(col).cast("int"), "int"
    return F.col(col), kind


def _text(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return json.dumps(value)
    if isinstance(value, float) and not math.isfinite(value):
        return '"NaN"' if math.isnan(value) else '"Infinity"' if value > 0 else '"-Infinity"'
    return repr(value) if isinstance(value, float) else str(value)


def _rank(value) -> tuple:
    """Sorts as Spark does: null first, NaN last."""
    if value is None:
        return (0, 0)
    return (2, 0) if isinstance(value, float) and math.isnan(value) else (1, value)


class Cells:
    """Borders of cells along ``order``; ``df`` shows the types of the columns."""

    def __init__(self, df: DataFrame, order: tuple[str, ...]):
        columns = [_sortable(df, c) for c in order]
        self.key = F.struct(*[c.alias(f"c{i}") for i, (c, _) in enumerate(columns)])
        self.schema = "array<struct<" + ",".join(f"c{i}:{kind}" for i, (_, kind) in enumerate(columns)) + ">>"
        self.borders: list[tuple] = []

    def number(self) -> Column:
        """How many borders lie at or before a row: a binary search among constants."""
        depth = len(self.borders).bit_length()
        # null behind the last border is never passed
        padded = [*self.borders, *[None] * ((1 << depth) - 1 - len(self.borders))]
        rows = (
            "null" if b is None else "{" + ",".join(f'"c{i}":{_text(v)}' for i, v in enumerate(b)) + "}" for b in padded
        )
        known = F.from_json(F.lit("[" + ",".join(rows) + "]"), self.schema)
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(depth))])

        def search(key: Column) -> Column:
            passed = lambda at, step: F.get(known, at + step - 1) <= key
            return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(passed(at, step), step).otherwise(0))

        # the key is made once a row, not once a step
        return F.get(F.transform(F.array(self.key), search), F.lit(0)).cast("bigint")

    def split(self, df: DataFrame, order: tuple[str, ...], every: int) -> bool:
        """Add a border at one of PICKED rows of those picked from ``df``, one of ``every``."""
        picked = df.where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).select(self.key.alias("k")).distinct()
        # about CELLS * PICKED tuples at most
        tuples = [(tuple(r["k"]), False) for r in picked.collect()] + [(b, True) for b in self.borders]
        ordered = sorted(tuples, key=lambda t: ([_rank(v) for v in t[0]], t[1]))
        borders, since = [], 0
        for k, old in ordered:
            since += 1
            if old or since >= PICKED:
                if not borders or borders[-1] != k:
                    borders.append(k)
                since = 0
        grown = len(borders) > len(self.borders)
        self.borders = borders
        return grown


def counted_cells(df: DataFrame, order: tuple[str, ...]) -> Column | None:
    """The number of a row's cell, never decreasing along ``order`` (ascending, nulls first).

    None if all rows fit one cell.

    Needs a session zone without clock changes where ``order`` holds times. Runs a few
    jobs: a count, one over the picked rows and, on tables of many cells, counts by cell.
    """
    cells = Cells(df, order)
    n = df.count()
    share = max(ROWS, -(-n // CELLS))
    if n <= share:
        return None
    every = max(1, share // PICKED)
    cells.split(df, order, every)
    for _ in range(ROUNDS if cells.borders and n > CHECKED * share else 0):
        counts = df.groupBy(cells.number().alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        crowded = [r["cell"] for r in counts.where(F.col("n") > CROWDED * share).collect()]
        if not crowded or every == 1:
            break
        every = max(1, every // PICKED)
        if not cells.split(df.where(cells.number().isin(crowded)), order, every):
            break
    return cells.number() if cells.borders else None
