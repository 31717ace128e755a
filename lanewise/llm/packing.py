"""Packing: pieces of documents into sequences of a fixed length, balanced by attention cost.

A piece of n tokens costs ``linear * n + quadratic * n * n``: attention stays
within a piece. Each task packs its own rows in groups of bounded size, so
nothing is shuffled. In a group, pieces go by descending length to the sequence
of least cost that has room; a piece that fits nowhere is cut.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lanewise.llm.common import text_batches
from lanewise.llm.tokens import Encoder
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)


@dataclass(frozen=True)
class Packing:
    length: int = 4096  # of a sequence
    end: int = 2  # the id that closes a document
    group: int = 1 << 20  # tokens packed together
    linear: float = 1.0
    quadratic: float = 1 / 4096


def capacities(tokens: int, length: int) -> np.ndarray:
    """Room of the sequences for a group: full ones, then powers of two for the rest, so nothing is padded."""
    rest = tokens % length
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return np.array([length] * (tokens // length) + powers, np.int64)


def pack(sizes: list[int], p: Packing) -> list[tuple[int, int, int, int, int]]:
    """Document number, start, length, sequence and offset of every piece."""
    room = capacities(sum(sizes), p.length)
    cost = np.zeros(len(room))
    filled = np.zeros(len(room), np.int64)
    waiting = [
        (-min(p.length, n - start), d, start)
        for d, n in enumerate(sizes)
        for start in range(0, n, p.length)
    ]
    heapq.heapify(waiting)
    out = []
    while waiting:
        n, d, start = heapq.heappop(waiting)
        n = -n
        fits = room >= n
        s = int(np.where(fits, cost, np.inf).argmin()) if fits.any() else int(room.argmax())
        m = min(n, int(room[s]))
        out.append((d, start, m, s, int(filled[s])))
        room[s] -= m
        filled[s] += m
        cost[s] += p.linear * m + p.quadratic * m * m
        if m < n:
            heapq.heappush(waiting, (m - n, d, start + m))
    return out


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def packed(docs: DataFrame, tokenizer: str, p: Packing = Packing(), cache_bytes: int = 96 << 20) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the content of a tokenizer file. Every row of ``docs`` is
    packed, repeated ones too; null and empty texts are the end id alone, a null doc_id
    stays null. Texts of any length are encoded whole.
    Columns other than doc_id and text are ignored; an empty table gives no piece.
    A sequence is full or as long as a power of two. A task remembers the ids of pieces of
    text in about ``cache_bytes``; with less it encodes more of them again.
    """
    file = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file.value, cache_bytes)
        next_id = TaskContext.get().partitionId() << 40
        held: list[tuple[int | None, np.ndarray]] = []
        tokens = 0
        for batch in text_batches(batches, 1 << 20):
            found = encoder.encode(batch.column("text"))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), found):
                held.append((doc, np.append(ids, np.uint32(p.end))))
                tokens += len(ids) + 1
            if tokens >= p.group:
                rows, next_id = emit(held, next_id)
                yield rows
                held, tokens = [], 0
        if held:
            yield emit(held, next_id)[0]

    def emit(held, next_id):
        pieces = pack([len(ids) for _, ids in held], p)
        d, start, n, s, offset = (np.array(x, np.int64) for x in zip(*pieces))
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array([held[i][0] for i in d], pa.int64()),
                pa.array(start),
                pa.array(n),
                pa.array([held[i][1][a : a + m].astype("<u4").tobytes() for i, a, m in zip(d, start, n)], pa.binary()),
                pa.array([len(held[i][1]) for i in d], pa.int64()),
                pa.array(s + next_id),
                pa.array(offset),
            ],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
        return rows, next_id + int(s.max()) + 1

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
