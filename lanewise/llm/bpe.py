"""Byte-level BPE by numpy: many pieces at once, one merge a row and round.

Pieces of similar length are the rows of one padded matrix. In each round every
row merges its leftmost pair of least rank; ranks of pairs come from a hash
table, and rows without a pair to merge leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lanewise.llm.common import text_batches
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

NONE = np.int64(1 << 40)

#: Longer pieces are merged one by one with a heap: a matrix would take rounds x length steps.
WIDEST = 128


def read_ranks(content: str) -> dict[bytes, int]:
    """Ranks from the content of a file with a base64 token and its rank in each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


@dataclass(frozen=True)
class Table:
    """What merging needs: the id of each byte, and a hash table from pairs of ids to the id of both."""

    tokens: list[bytes | None]
    bytes_: np.ndarray
    keys: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(ranks: dict[bytes, int]) -> Table:
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        tokens: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        size = 1 << (2 * len(pairs) + 2).bit_length()
        keys, values = np.zeros(size, np.uint64), np.full(size, NONE)
        left = np.fromiter(pairs.keys(), np.uint64, len(pairs)) + np.uint64(1)
        ranked = np.fromiter(pairs.values(), np.int64, len(pairs))
        slot = _slot(left, size)
        while len(left):
            free = keys[slot] == 0
            winner = np.zeros(len(left), bool)
            _, first = np.unique(slot[free], return_index=True)
            winner[np.flatnonzero(free)[first]] = True
            keys[slot[winner]] = left[winner]
            values[slot[winner]] = ranked[winner]
            left, ranked, slot = left[~winner], ranked[~winner], (slot[~winner] + 1) & (size - 1)
        single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        return Table(tokens, single, keys, values)

    def parts(self) -> tuple:
        """Plain values that any executor can read; ``Table(*parts)`` is the table again."""
        return self.tokens, self.bytes_, self.keys, self.values

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id of each joined pair, or ``NONE``."""
        key = ((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)) + np.uint64(1)
        slot = _slot(key, len(self.keys))
        there = self.keys[slot]
        out = np.where(there == key, self.values[slot], NONE)
        open_ = np.flatnonzero((there != key) & (there != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
        return out


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    x = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(size - 1)).astype(np.int64)


def merge(pieces: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each piece."""
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(pieces)
    lengths = np.array([len(p) for p in pieces])
    low = 0
    for width in (4, 8, 16, 32, 64, WIDEST):
        at = np.flatnonzero((lengths > low) & (lengths <= width))
        low = width
        step = max(1, (1 << 18) // width)
        for k in range(0, len(at), step):
            _merge_matrix(pieces, at[k : k + step], width, table, out)
    for i in np.flatnonzero(lengths > WIDEST).tolist():
        out[i] = _merge_one(pieces[i], table)
    return out


def _merge_matrix(pieces, at, width, table, out) -> None:
    raw = b"".join([pieces[i].ljust(width, b"\0") for i in at])
    m = table.bytes_[np.frombuffer(raw, np.uint8).reshape(-1, width)]
    n = np.array([len(pieces[i]) for i in at])
    columns = np.arange(width)
    ranks = table.pair(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(len(at), width - 1)
    ranks[columns[None, 1:] >= n[:, None]] = NONE
    while len(at):
        j = ranks.argmin(axis=1)
        rows = np.arange(len(at))
        best = ranks[rows, j]
        done = best == NONE
        if done.any():
            for r in np.flatnonzero(done).tolist():
                out[at[r]] = m[r, : n[r]].astype(np.uint32)
            on = ~done
            at, m, n, ranks, j, best = at[on], m[on], n[on], ranks[on], j[on], best[on]
            rows = rows[: len(at)]
            if not len(at):
                return
        behind = columns[None, :] > j[:, None]
        m = np.where(behind, np.concatenate([m[:, 1:], m[:, -1:]], axis=1), m)
        m[rows, j] = best
        n = n - 1
        ranks = np.where(
            columns[None, :-1] >= j[:, None],
            np.concatenate([ranks[:, 1:], np.full((len(at), 1), NONE)], axis=1),
            ranks,
        )
        near = np.flatnonzero(j > 0)
        ranks[near, j[near] - 1] = table.pair(m[near, j[near] - 1], best[near])
        near = np.flatnonzero(j + 1 < n)
        ranks[near, j[near]] = table.pair(best[near], m[near, j[near] + 1])


def _merge_one(piece: bytes, table: Table) -> np.ndarray:
    """The same for a long piece: pairs wait in a heap by rank, then place."""
    ids = table.bytes_[np.frombuffer(piece, np.uint8)]
    first = table.pair(ids[:-1], ids[1:])
    ids = ids.tolist()
    after = list(range(1, len(ids))) + [-1]
    before = list(range(-1, len(ids) - 1))
    waiting = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first < NONE).tolist()]
    heapq.heapify(waiting)
    joined: dict[tuple[int, int], int] = {}

    def push(i: int) -> None:
        a, b = ids[i], ids[after[i]]
        if (a, b) not in joined:
            joined[a, b] = int(table.pair(np.array([a]), np.array([b]))[0])
        if joined[a, b] < NONE:
            heapq.heappush(waiting, (joined[a, b], i, a, b))

    while waiting:
        rank, i, a, b = heapq.heappop(waiting)
        k = after[i] if ids[i] >= 0 else -1
        if k < 0 or ids[i] != a or ids[k] != b:
            continue
        ids[i], ids[k] = rank, -1
        after[i] = after[k]
        if after[i] >= 0:
            before[after[i]] = i
            push(i)
        if before[i] >= 0:
            push(before[i])
    return np.array([x for x in ids if x >= 0], np.uint32)


class Encoder:
    """Ids of texts; the ids of pieces are remembered up to a bound."""

    def __init__(self, table: Table, pattern: str, remembered: int = 250_000):
        import regex

        self.table, self.remembered = table, remembered
        self.find = regex.compile(pattern).findall
        self.whole = {t.decode(): np.array([i], np.uint32).tobytes() for i, t in enumerate(table.tokens) if t is not None and _is_text(t)}
        self.known = dict(self.whole)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as 32-bit numbers; null texts count as empty."""
        if len(self.known) > self.remembered + len(self.whole):
            self.known = dict(self.whole)
        known = self.known
        cut = [self.find(t) if t else () for t in texts]
        fresh = list({p for pieces in cut for p in pieces if p not in known})
        for p, ids in zip(fresh, merge([p.encode() for p in fresh], self.table)):
            known[p] = ids.tobytes()
        get = known.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), np.uint32) for pieces in cut]


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def decode(ids: np.ndarray, table: Table) -> bytes:
    return b"".join([table.tokens[i] for i in ids.tolist()])


def encoded(docs: DataFrame, table: Table, pattern: str, ids: str = "ids") -> DataFrame:
    """``docs`` with the binary column ``ids``: little-endian 32-bit ids of the whole text.

    Null and empty texts have no ids. A column named like ``ids`` is replaced; all
    others and all rows stay.
    """
    docs = docs.drop(ids)
    sent = docs.sparkSession.sparkContext.broadcast(table.parts())
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Table(*sent.value), pattern)
        for batch in text_batches(batches):
            found = encoder.encode(batch.column("text").to_pylist())
            column = pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.BinaryType())]))


def digested(encoded_docs: DataFrame, table: Table, ids: str = "ids") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of documents with their ids."""
    sent = encoded_docs.sparkSession.sparkContext.broadcast(table.parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        back = Table(*sent.value)
        names = [str(i) for i in range(len(back.tokens))].__getitem__
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([sha256(",".join(map(names, x.tolist())).encode()).hexdigest() for x in found]),
                    pa.array([sha256(decode(x, back)).hexdigest() for x in found]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded_docs.select("doc_id", ids).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
