"""Document fingerprints by winnowing: a few hashes of a text, with their places.

Every run of ``gram`` characters has a rolling hash. Of every ``window`` neighbouring
runs the least hash is kept, the rightmost of equal ones, with its position. Two texts
that share ``gram + window - 1`` characters therefore share a fingerprint inside them,
whatever surrounds them, and about one run of ``(window + 1) / 2`` is kept.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.llm.common import text_batches
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

#: Characters hashed at a time, which bounds the memory a long text takes.
BLOCK = 1 << 18


@dataclass(frozen=True)
class Winnow:
    gram: int = 16  # characters of a run
    window: int = 25  # neighbouring runs of which one is kept; at most 255

    @property
    def guarantee(self) -> int:
        """Shared passages of so many characters always share a fingerprint."""
        return self.gram + self.window - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Winnower:
    """Texts to fingerprints. Keeps the powers of the rolling hash for one block."""

    def __init__(self, winnow: Winnow):
        self.winnow = winnow
        n = BLOCK + winnow.gram + 1
        base = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base)]))
        self.inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]))

    def rolling(self, codes: np.ndarray, gram: int) -> np.ndarray:
        """Hashes of all runs of ``gram`` codes: differences of one running sum, modulo 2 to 64."""
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_mixed(codes.astype(np.uint64) + np.uint64(1)) * self.inverses[: len(codes)], out=sums[1:])
        runs = sums[gram:] - sums[: len(sums) - gram]
        return _mixed(runs * self.powers[: len(runs)])

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and positions kept, by position; a text shorter than a run is one run."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        gram, window = self.winnow.gram, self.winnow.window
        if not len(codes):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        if len(codes) < gram:
            # the length keeps it apart from runs of full size
            return _mixed(self.rolling(codes, len(codes)) + np.uint64(len(codes))), np.zeros(1, np.int64)
        runs = len(codes) - gram + 1
        window = min(window, runs)
        hashes, places = [], []
        for at in range(0, runs - window + 1, BLOCK - window + 1):
            h = self.rolling(codes[at : at + BLOCK + gram - 1], gram)
            kept = _minima(h, window)
            hashes.append(h[kept])
            places.append(kept + at)
        hash, place = np.concatenate(hashes), np.concatenate(places)
        fresh = np.diff(place, prepend=-1) > 0  # blocks overlap
        return hash[fresh], place[fresh]


def _minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the rightmost least of some window."""
    least, place, width = hashes, np.arange(len(hashes)), 1
    while width < window:
        step = min(width, window - width)
        right = least[step:] <= least[:-step]
        least = np.where(right, least[step:], least[:-step])
        place = np.where(right, place[step:], place[:-step])
        width += step
    return place[np.concatenate([[True], place[1:] != place[:-1]])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes as a share of all hashes of two fingerprints; 1 if neither has any."""
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 1.0


def matches(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int]]:
    """Positions in two texts at which both fingerprints hold the same hash, in order."""
    order = np.argsort(b[0], kind="stable")
    held = b[0][order]
    first, last = np.searchsorted(held, a[0], "left"), np.searchsorted(held, a[0], "right")
    for place, x, y in zip(a[1].tolist(), first.tolist(), last.tolist()):
        for other in b[1][order[x:y]].tolist():
            yield place, other


def packed(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as text: eight bytes for each hash kept, its top 56 bits and the step to its position.

    No two neighbours lie more than a window apart, so a step fits a byte.
    """
    hashes, places = fingerprint
    steps = np.diff(places, prepend=0).astype(np.uint64)
    return base64.b64encode(((hashes & ~np.uint64(0xFF)) | steps).astype("<u8").tobytes()).decode()


def unpacked(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (the low eight bits zero) and positions of a packed fingerprint."""
    both = np.frombuffer(base64.b64decode(text), "<u8")
    return both & ~np.uint64(0xFF), np.cumsum(both & np.uint64(0xFF)).astype(np.int64)


def fingerprints(docs: DataFrame, winnow: Winnow = Winnow(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, n_chars, hashes and positions of every row, without a shuffle.

    A null or empty text has no hashes; a text shorter than a run has one. Rows are
    independent, so repeated ones and null ids stay as they are. Texts of any length
    are hashed whole, in blocks. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(winnow)
        for batch in text_batches(batches):
            texts = [t.as_py() or "" for t in batch.column("text")]
            found = [winnower.of(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([h.view(np.int64) for h, _ in found], pa.list_(pa.int64())),
                    pa.array([p for _, p in found], pa.list_(pa.int64())),
                ],
                names=["id", "n_chars", "hashes", "positions"],
            )

    found = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {docs.schema[id].dataType.simpleString()}, n_chars long, hashes array<long>, positions array<long>"
    )
    return found.withColumnRenamed("id", id)


def edited(text: str, next: str) -> str:
    """``text``, its last half (rounded down) replaced by as many characters of ``next``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + next[:half]


#: Rows of a range, and ranges at most: what is broadcast. Beyond both, ranges grow with the table.
RANGE_ROWS, RANGES = 256, 1 << 16
_FAN = 256  # the place of an id is looked up in two steps of so many


def _splits(ids: DataFrame) -> np.ndarray:
    """Ids, descending, that cut the known ones into ranges of about equal size.

    Taken from ids chosen by their hash, about eight for each range.
    """
    known = ids.where(F.col("id").isNotNull())
    n = known.count()
    ranges = min(RANGES, n // RANGE_ROWS)
    if not ranges:
        return np.empty(0, np.int64)
    every = max(1, n // (8 * ranges))
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).toArrow().column("id").to_numpy()
    return np.unique(np.sort(picked)[:: max(1, len(picked) // ranges)])[::-1]


def _range_of(id: Column, splits: np.ndarray) -> Column:
    """How many splits lie above an id."""
    if not len(splits):
        return F.lit(0).cast("long")
    blocks = [splits[at : at + _FAN].tolist() for at in range(0, len(splits), _FAN)]
    constant = lambda v, kind: F.from_json(F.lit(json.dumps(v)), kind)
    above = lambda values: F.size(F.filter(values, lambda x: x > id))
    whole = above(constant([b[-1] for b in blocks], "array<bigint>"))
    inside = above(F.get(constant(blocks, "array<array<bigint>>"), whole))
    return (whole * _FAN + F.when(whole < len(blocks), inside).otherwise(0)).cast("long")


_COMPARED = (
    "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def against_next(docs: DataFrame, winnow: Winnow = Winnow(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text compared with the next one by descending id and with a copy edited by it.

    One row per row: the id, n_chars, edited (the text whose last half is the first half
    of the next), fingerprint, edited_fingerprint, near_edited, near_next. After the last
    row comes the first; a single row is its own next. Null texts are empty; two texts
    without hashes are alike (1.0). Rows of one id follow each other by text; null ids
    come last, by a hash of their text. Other columns are ignored and an empty table
    gives an empty one.

    Texts are shuffled once, by ranges of the id. The first row of every range is sent to
    the range before as well, so a task finds the next text of all its rows as they stream by.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    ids = docs.select(F.col(id).cast("long").alias("id"))
    splits = _splits(ids)
    # known ids in ranges; null ids behind them, in 256 ranges by hash
    unknown = F.xxhash64("text")
    rows = docs.select(F.col(id).cast("long").alias("id"), whole.alias("text")).select(
        F.when(F.col("id").isNotNull(), _range_of(F.col("id"), splits))
        .otherwise(len(splits) + 1 + 128 + F.shiftright(unknown, 56))
        .alias("range"),
        F.lit(False).alias("ahead"),
        F.bitwise_not("id").alias("down"),  # ascending where ids descend
        F.when(F.col("id").isNull(), unknown).otherwise(0).alias("tie"),
        "id",
        "text",
    )
    known = ids.where("id is not null").groupBy(_range_of(F.col("id"), splits).alias("range"))
    least = known.agg(F.min(F.struct(F.bitwise_not("id").alias("down"), F.lit(0).cast("long").alias("tie"))).alias("at"))
    least = least.unionByName(
        rows.where("id is null").groupBy("range").agg(F.min(F.struct("down", "tie")).alias("at"))
    )
    # one row a range
    around = Window.orderBy("range")
    back = F.coalesce(
        F.lag("range").over(around),
        F.last("range").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    firsts = least.select("range", "at.down", "at.tie", back.alias("before")).withColumnsRenamed(
        {"range": "_range", "down": "_down", "tie": "_tie"}
    )
    here = (
        (F.col("range") == F.col("_range"))
        & F.col("down").eqNullSafe(F.col("_down"))
        & (F.col("tie") == F.col("_tie"))
    )
    copies = rows.join(F.broadcast(firsts), here).select(
        F.col("before").alias("range"), F.lit(True).alias("ahead"), "down", "tie", "id", "text"
    )
    order = ["range", "ahead", "down", "tie", "text"]
    dealt = rows.unionByName(copies).repartition("range").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnower = Winnower(winnow)
        held = inside = None
        for batch in text_batches(batches):
            out = []
            for at, ahead, i, t in zip(*[batch.column(c).to_pylist() for c in ("range", "ahead", "id", "text")]):
                if at != inside:
                    held, inside = None, at
                elif ahead and held is None:
                    continue  # rows of the same id as the one that was met
                new = (i, t, winnower.of(t))
                if held is not None:
                    out.append(_compared(winnower, held, new))
                held = None if ahead else new
            yield _batch(out)

    columns = dealt.select("range", "ahead", "id", "text")
    return columns.mapInArrow(run, _COMPARED).withColumnRenamed("id", id)


def _compared(winnower: Winnower, here: tuple, then: tuple) -> tuple:
    id, text, own = here
    new = edited(text, then[1])
    other = winnower.of(new)
    return (id, len(text), new, packed(own), packed(other), likeness(own[0], other[0]), likeness(own[0], then[2][0]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    names = [c.split()[0] for c in _COMPARED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)
