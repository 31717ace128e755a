"""Comparison with the previous row of a key, on a stream.

Row-offset windows do not exist on streams, so the latest value of each key is
kept as state. Rows wait until the watermark has passed them and are then taken
in event-time order, so the result does not depend on arrival order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

ROW = np.dtype([("us", "<i8"), ("row_id", "<i8"), ("val", "<f8")])
SPAN_US = 60_000_000  # of event time that is never cut into two buckets
CHUNK = 4096  # rows of one state entry


class Increases(StatefulProcessor):
    """State per key: rows not yet passed by the watermark, and the last value.

    Up to ``CHUNK`` waiting rows are one packed value. More lie in buckets of event time, in
    entries of at most ``CHUNK`` rows. A bucket reaches to the next one: it takes as many spans
    of ``SPAN_US`` as fill one entry, or one span in any number of entries, so few rows cost few
    reads and writes of state. A timer reads the buckets the watermark has passed, one after the
    other, and no others: so memory holds one bucket, whatever else waits, and rows are sorted
    and compared as arrays. What waits is bounded by the watermark delay; of a silent key one
    value stays, however long. Late rows never arrive here: Spark drops them. A null or NaN
    value is no rise and nothing rises above it.
    """

    def __init__(self, span_us: int = SPAN_US):
        self.span_us = span_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.few = handle.getValueState("few", "packed binary")
        self.buckets = handle.getMapState("buckets", "bucket bigint", "chunks bigint, first bigint")
        self.rows = handle.getMapState("rows", "bucket bigint, chunk bigint", "packed binary")
        self.last = handle.getValueState("last", "us bigint, val double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        few, waiting = self._held()
        held = [few] if few is not None else []
        firsts = [int(few["us"].min())] if held else [first for _, first in waiting.values()]
        n, first = sum(map(len, held)), None
        for pdf in rows:
            new = np.empty(len(pdf), ROW)
            for c in ROW.names:
                new[c] = pdf[c].to_numpy()
            if not len(new):
                continue
            least = int(new["us"].min())
            first = least if first is None else min(first, least)
            n += len(new)
            if not waiting and n <= CHUNK:
                held.append(new)
                continue
            self._add(waiting, np.concatenate([*held, new]))
            held = []
        if first is None:
            return iter([])
        if held:
            self.few.update((np.concatenate(held).tobytes(),))
        elif few is not None:
            self.few.clear()
        # a timer is set for the first row of those that waited before
        if not firsts or first < min(firsts):
            self.handle.registerTimer(_ms_up(first))
        return iter([])

    def _held(self) -> tuple[np.ndarray | None, dict[int, tuple[int, int]]]:
        """The waiting rows if they are few, and the buckets of many."""
        few = self.few.get()
        if few is not None:
            return np.frombuffer(few[0], ROW), {}
        return None, self._waiting()

    def _waiting(self) -> dict[int, tuple[int, int]]:
        """Number of entries and first time of each bucket, by the span it begins with."""
        return {k[0]: tuple(v) for k, v in self.buckets.iterator()}

    def _add(self, waiting: dict[int, tuple[int, int]], new: np.ndarray) -> None:
        """Put rows into the buckets that reach over them; the first bucket also takes what lies before it."""
        begins = np.array(sorted(waiting), np.int64)
        if not len(begins):
            self._spread(waiting, new)
            return
        new = new[np.argsort(new["us"], kind="stable")]
        place = np.maximum(np.searchsorted(begins, new["us"] // self.span_us, side="right") - 1, 0)
        cuts = np.flatnonzero(np.diff(place)) + 1
        for at, part in zip(place[np.concatenate([[0], cuts])].tolist(), np.split(new, cuts)):
            bucket = int(begins[at])
            chunks, first = waiting[bucket]
            if chunks == 1:
                part = np.concatenate([self._entry(bucket, 0), part])
                if int(part["us"].min()) // self.span_us != bucket:
                    self._drop(waiting, bucket, chunks)
                self._spread(waiting, part)
                continue
            inside = part["us"] // self.span_us == bucket
            if inside.any():
                self._append(waiting, bucket, part[inside])
            for rest in (part[part["us"] // self.span_us < bucket], part[part["us"] // self.span_us > bucket]):
                if len(rest):
                    self._spread(waiting, rest)

    def _spread(self, waiting: dict[int, tuple[int, int]], part: np.ndarray) -> None:
        """Write rows as buckets of whole spans: as many spans as one entry holds, one at least."""
        part = part[np.argsort(part["us"], kind="stable")]
        spans, counts = np.unique(part["us"] // self.span_us, return_counts=True)
        groups, held = [], 0
        for span, n in zip(spans.tolist(), counts.tolist()):
            if not groups or held + n > CHUNK:
                groups.append([span, 0])
                held = 0
            held += n
            groups[-1][1] += n
        at = 0
        for bucket, n in groups:
            rows = part[at : at + n]
            at += n
            for chunk in range(-(-n // CHUNK)):
                self.rows.updateValue((bucket, chunk), (rows[chunk * CHUNK : (chunk + 1) * CHUNK].tobytes(),))
            self._note(waiting, bucket, -(-n // CHUNK), int(rows["us"][0]))

    def _append(self, waiting: dict[int, tuple[int, int]], bucket: int, part: np.ndarray) -> None:
        """Append rows to a bucket of one span, filling its last entry first."""
        chunks, first = waiting[bucket]
        first = min(first, int(part["us"].min()))
        held = self._entry(bucket, chunks - 1)
        if len(held) < CHUNK:
            part, chunks = np.concatenate([held, part]), chunks - 1
        for at in range(0, len(part), CHUNK):
            self.rows.updateValue((bucket, chunks), (part[at : at + CHUNK].tobytes(),))
            chunks += 1
        self._note(waiting, bucket, chunks, first)

    def _note(self, waiting: dict[int, tuple[int, int]], bucket: int, chunks: int, first: int) -> None:
        if waiting.get(bucket) != (chunks, first):
            waiting[bucket] = (chunks, first)
            self.buckets.updateValue((bucket,), (chunks, first))

    def _entry(self, bucket: int, chunk: int) -> np.ndarray:
        return np.frombuffer(self.rows.getValue((bucket, chunk))[0], ROW)

    def _drop(self, waiting: dict[int, tuple[int, int]], bucket: int, chunks: int) -> None:
        for chunk in range(chunks):
            self.rows.removeKey((bucket, chunk))
        self.buckets.removeKey((bucket,))
        del waiting[bucket]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        few, waiting = self._held()
        if few is not None:
            rows = np.sort(few, order=["us", "row_id"])
            due, later = rows[rows["us"] <= limit], rows[rows["us"] > limit]
            if len(due) and len(later):
                self.few.update((later.tobytes(),))
            elif len(due):
                self.few.clear()
            yield from self._risen(key, due)
            self._wake(later)
            return
        for bucket in sorted(waiting):
            chunks, first = waiting[bucket]
            if first > limit:
                self.handle.registerTimer(_ms_up(first))
                return
            rows = np.sort(np.concatenate([self._entry(bucket, c) for c in range(chunks)]), order=["us", "row_id"])
            self._drop(waiting, bucket, chunks)
            due, later = rows[rows["us"] <= limit], rows[rows["us"] > limit]
            if len(later):
                self._spread(waiting, later)
            self._wake(later)
            yield from self._risen(key, due)
            if len(later):
                return

    def _wake(self, later: np.ndarray) -> None:
        if len(later):
            self.handle.registerTimer(_ms_up(int(later["us"][0])))

    def _risen(self, key, due: np.ndarray) -> Iterator[pd.DataFrame]:
        """The rows above the row before, of ordered rows that follow the last value."""
        if not len(due):
            return
        last = self.last.get()
        seen = np.concatenate([[np.nan if last is None else last[1]], due["val"]])
        rises = due["val"] > seen[:-1]
        self.last.update((int(due["us"][-1]), float(due["val"][-1])))
        if rises.any():
            up = due[rises]
            yield pd.DataFrame(
                {"key": [key[0]] * len(up), "row_id": up["row_id"], "val": up["val"], "prev": seen[:-1][rises]}
            )

    def close(self) -> None:
        pass


def _ms_up(us: int) -> int:
    return -(-us // 1000)


def stream_increases(
    stream: DataFrame,
    key: str,
    row_id: str,
    val: str,
    watermark: str = "1 hour",
    ts: str = "ts",
) -> DataFrame:
    """Rows above the row before of their key, with that earlier value.

    One key is one state and hence one task; bound the micro-batch at the source
    for keys of high rate.
    """
    kind = dict(stream.dtypes)[key]
    rows = stream.withWatermark(ts, watermark).select(
        F.col(key).alias("key"),
        F.col(ts).alias("at"),
        F.unix_micros(ts).alias("us"),
        F.col(row_id).cast("bigint").alias("row_id"),
        F.col(val).cast("double").alias("val"),
    )
    out = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Increases(),
        outputStructType=f"key {kind}, row_id bigint, val double, prev double",
        outputMode="append",
        timeMode="EventTime",
    )
    return out.select(
        F.col("key").alias(key), F.col("row_id").alias(row_id), F.col("val").alias(val), "prev"
    )
