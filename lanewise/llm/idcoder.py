"""Token ids in a compact file format: context mixing and range coding in blocks.

Files are written by the model of ``idmix``: one mixture of orders 0 to 2 and one step of
the range coder an id. Blocks that are coded side by side share a table of order 0; the
table is a row of its own before theirs.

Files of the format before (``IDB2``) are still read. Its model, per block, starting from
nothing: the id last seen after the two ids before (order 2), after the one before
(order 1), and counts of ids by their hexadecimal digits (order 0). Their predictions are
mixed into one distribution: an id has order 0's probability for it, times that order's
weight, plus the weights of the orders that predict it. It is coded digit by digit from
that mixture: each digit's frequencies are order 0's counts plus a mass at the digit of
each prediction that still fits, and a digit multiplies the odds of the predictions that
fit by how unlikely order 0 thought it. The share of the id that each order explained
moves its weight, kept for every combination of recent success of both predictions. A
range coder turns the digits into 16-bit words.

Numpy codes many blocks side by side, one step of each at a time; the numbers are
integers throughout, so every machine decodes what any other encoded.

A block: magic, digits of an id, number of ids, number of documents pieces, first
and last piece's state, then per piece doc_id and length, then the words, behind the
crc32 of their table if they have one; a crc32 of all before closes it. A table: magic,
ids and frequencies, crc32. Both are rows of Parquet files (shard, block, data), so any
storage that Spark writes to holds them, and a failed task leaves none behind. A block's
table is the last one before it in its shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanewise.llm import idmix
from lanewise.llm.common import text_batches
from lanewise.llm.tokens import Encoder
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

MAGIC, MIXED, TABLE = b"IDB2", b"IDB3", b"IDT3"
HEAD = "<4sBIIII"
LEAST = np.uint64(1 << 32)  # of a coder's range between symbols
WORD = np.uint64(16)
SLOTS = 2048  # of each prediction table
NODES = 256  # of each digit's counts, by a hash of the digits before
GAIN, LIMIT = 12, 1 << 12
ONE = 1 << 16  # of weights and odds
FLOOR = ONE >> 7  # order 0 keeps this weight at least
MOST = ONE << 9  # odds of a prediction against order 0 at most
RATE = 6  # a weight moves by 2 ** -RATE of its distance
#: Weights of a prediction before anything is known, by its recent successes.
START = np.array([6000, 26000, 40000, 50000], np.int64)
#: What a symbol adds to the cumulative counts of 16.
STEP = np.array([[GAIN * (k >= s) for k in range(16)] for s in range(16)], np.uint16)
#: Recent success of a prediction after it failed, and after it held.
NEXT = np.array([0, 0, 1, 1, 1, 2, 3, 3])
#: Times this, the upper byte is the sum of all eight.
BYTES = np.uint64(0x0101010101010101)


class CorruptBlock(ValueError):
    """A block whose checksum or structure is wrong."""


class Model:
    """Adaptive state of ``n`` blocks, and the mixed frequencies of the digits of their next id."""

    def __init__(self, n: int, digits: int):
        self.n, self.digits = n, digits
        self.lane = np.arange(n)
        self.first = self.lane * 16
        # a prediction, -1 for none, and two bits of its recent success
        self.by_one = np.full(n * SLOTS, -1 << 2, np.int32)
        self.by_two = np.full(n * SLOTS, -1 << 2, np.int32)
        context = np.arange(32)
        # together the predictions leave order 0 a third at the start
        two, one = START[context >> 3], START[context >> 1 & 3]
        self.weight_two = np.tile(np.where(context & 1, two + one >> 1, two * 2 // 3), n)
        self.weight_one = np.tile(np.where(context & 1, 0, (ONE - two) * one // (2 * ONE)), n)
        # counts of the digits up to each; rows of 32 bytes, none in two lines of memory
        room = np.empty(n * digits * NODES * 32 + 64, np.uint8)
        at = -room.ctypes.data % 64
        self.below = room[at : at + n * digits * NODES * 32].view(np.uint16).reshape(-1, 16)
        self.below[:] = np.arange(1, 17)
        self.whole = self.below.view("V32").reshape(-1)
        self.p1 = np.zeros(n, np.int64)
        self.p2 = np.zeros(n, np.int64)

    def begin(self, a: int) -> None:
        """Predictions for the next id of the first ``a`` blocks, and their odds against order 0."""
        p1, p2, lane = self.p1[:a], self.p2[:a], self.lane[:a]
        mixed = p1 * 40503
        self.at_one = lane * SLOTS + (mixed >> 4 & SLOTS - 1)
        self.at_two = lane * SLOTS + (mixed + p2 * 30011 >> 3 & SLOTS - 1)
        one, two = (t.take(at).astype(np.int64) for t, at in ((self.by_one, self.at_one), (self.by_two, self.at_two)))
        self.one, self.two = one >> 2, two >> 2
        self.sure_one, self.sure_two = s1, s2 = one & 3, two & 3
        same = self.one == self.two
        self.has_two = self.two >= 0
        self.has_one = (self.one >= 0) & ~same
        self.context = lane * 32 + s2 * 8 + s1 * 2 + same
        self.w2, self.w1 = self.weight_two.take(self.context), self.weight_one.take(self.context)
        w2, w1 = self.w2 * self.has_two, self.w1 * self.has_one
        w0 = np.maximum(ONE - w2 - w1, FLOOR)
        self.odds_two, self.odds_one = (w2 << 16) // w0, (w1 << 16) // w0
        self.nodes: list[tuple[np.ndarray, np.ndarray]] = []

    def digit(self, d: int, before: np.ndarray) -> None:
        """Makes ready digit ``d``, after the digits ``before``: order 0's node and the extra masses."""
        shift = 4 * (self.digits - 1 - d)
        a = len(before)
        node = (self.lane[:a] * self.digits + d) * NODES + (before * 179 + (before >> 4) * 31 & NODES - 1)
        self.rows = self.below.take(node, axis=0)
        self.nodes.append((node, self.rows))
        self.total = self.rows[:, 15].astype(np.int64)
        self.digit_two, self.digit_one = self.two >> shift & 15, self.one >> shift & 15
        self.mass_two, self.mass_one = self.total * self.odds_two >> 16, self.total * self.odds_one >> 16

    def spans(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the mixture puts ``symbol``: frequencies below it, its own, the total. Odds follow the digit."""
        upto = self.rows.reshape(-1)
        at = self.first[: len(symbol)] + symbol
        low = upto.take(at - 1).astype(np.int64) * (symbol > 0)
        own = upto.take(at).astype(np.int64) - low
        fits_two, fits_one = self.digit_two == symbol, self.digit_one == symbol
        self.odds_two = np.minimum(self.odds_two * self.total // own, MOST) * fits_two
        self.odds_one = np.minimum(self.odds_one * self.total // own, MOST) * fits_one
        low += self.mass_two * (self.digit_two < symbol) + self.mass_one * (self.digit_one < symbol)
        own += self.mass_two * fits_two + self.mass_one * fits_one
        return low, own, self.total + self.mass_two + self.mass_one

    def find(self, value: np.ndarray) -> np.ndarray:
        """The digit in whose span the values lie."""
        upto = self.rows.reshape(-1)
        first = self.first[: len(value)]
        one_first = self.digit_one < self.digit_two
        # back to order 0's own frequencies: a mass ends the span of its digit
        own = value
        for digit, mass, before in (
            (self.digit_two, self.mass_two, self.mass_one * one_first),
            (self.digit_one, self.mass_one, self.mass_two * ~one_first),
        ):
            past = value - before - upto.take(first + digit).astype(np.int64)
            past += 1
            own = own - np.minimum(np.maximum(past, 0, out=past), mass, out=past)
        passed = (self.rows <= own.astype(np.uint16)[:, None]).view(np.uint64)
        return ((passed[:, 0] + passed[:, 1]) * BYTES >> np.uint64(56)).astype(np.int64)

    def learn(self, a: int, ids: np.ndarray) -> None:
        """Moves weights by the share of the id each order explained; counts what was left to order 0."""
        odds = self.odds_two + self.odds_one + ONE
        for weights, now, has, part in (
            (self.weight_two, self.w2, self.has_two, self.odds_two),
            (self.weight_one, self.w1, self.has_one, self.odds_one),
        ):
            share = (part << 16) // odds
            weights[self.context] = now + has * (share - now >> RATE)
        rest = np.flatnonzero(odds < 2 * ONE)
        left = ids.take(rest)
        for d, (node, rows) in enumerate(self.nodes):
            self._count(node.take(rest), rows.take(rest, axis=0), left >> 4 * (self.digits - 1 - d) & 15)
        for table, at, guess, sure in (
            (self.by_one, self.at_one, self.one, self.sure_one),
            (self.by_two, self.at_two, self.two, self.sure_two),
        ):
            table[at] = np.where(sure == 0, ids, guess) << 2 | NEXT.take((guess == ids) * 4 + sure)
        self.p2[:a] = self.p1[:a]
        self.p1[:a] = ids

    def _count(self, node: np.ndarray, rows: np.ndarray, symbol: np.ndarray) -> None:
        rows += STEP.take(symbol, axis=0)
        big = np.flatnonzero(rows[:, 15] > LIMIT)
        if len(big):
            each = np.diff(rows[big].astype(np.int64), axis=1, prepend=0)
            rows[big] = np.cumsum(each + 1 >> 1, axis=1)
        self.whole[node] = rows.view("V32").reshape(-1)


class Writer:
    """A range coder for each block; words may exceed 16 bits until the carries are settled."""

    def __init__(self, n: int, room: int):
        self.low, self.range = np.zeros(n, np.uint64), np.full(n, (1 << 48) - 1, np.uint64)
        self.words, self.at = np.zeros((n, room), np.int32), np.zeros(n, np.int64)

    def put(self, a: int, low, width, total) -> None:
        r = self.range[:a] // total.astype(np.uint64)
        self.low[:a] += r * low.astype(np.uint64)
        r *= width.astype(np.uint64)
        small = np.flatnonzero(r < LEAST)
        while len(small):
            self._emit(small)
            r[small] = wider = r.take(small) << WORD
            small = small[wider < LEAST]
        self.range[:a] = r

    def _emit(self, lanes) -> None:
        low = self.low[lanes]
        self.words[lanes, self.at[lanes]] = (low >> np.uint64(32)).astype(np.int32)
        self.at[lanes] += 1
        self.low[lanes] = (low & np.uint64(0xFFFFFFFF)) << WORD

    def close(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(3):
            self._emit(every)
        for k in range(int(self.at.max()) - 1, 0, -1):
            carry = self.words[:, k] >> 16
            if carry.any():
                self.words[:, k] &= 0xFFFF
                self.words[:, k - 1] += carry
        return [w[:n].astype("<u2").tobytes() for w, n in zip(self.words, self.at)]


class Reader:
    """The inverse of ``Writer``."""

    def __init__(self, words: list[np.ndarray]):
        n = len(words)
        self.words = np.zeros((n, max(map(len, words)) + 4), np.uint16)
        for i, w in enumerate(words):
            self.words[i, : len(w)] = w
        self.range = np.full(n, (1 << 48) - 1, np.uint64)
        w = self.words.astype(np.uint64)
        self.code = w[:, 0] << np.uint64(32) | w[:, 1] << WORD | w[:, 2]
        self.at = np.full(n, 3, np.int64)

    def value(self, a: int, total) -> np.ndarray:
        total = total.astype(np.uint64)
        self.step = self.range[:a] // total
        return np.minimum(self.code[:a] // self.step, total - np.uint64(1)).astype(np.int64)

    def take(self, a: int, low, width) -> None:
        code = self.code[:a] - self.step * low.astype(np.uint64)
        r = self.step * width.astype(np.uint64)
        small = np.flatnonzero(r < LEAST)
        while len(small):
            at = self.at.take(small)
            code[small] = code.take(small) << WORD | self.words[small, np.minimum(at, self.words.shape[1] - 1)]
            self.at[small] = at + 1
            r[small] = wider = r.take(small) << WORD
            small = small[wider < LEAST]
        self.code[:a] = code
        self.range[:a] = r


def _steps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks by descending size, and how many of them still have an id at each step."""
    order = np.argsort(-sizes, kind="stable")
    steps = np.arange(int(sizes.max()))
    return order, len(sizes) - np.searchsorted(np.sort(sizes), steps, side="right")


def encode_ids(blocks: list[np.ndarray], digits: int = 4) -> list[bytes]:
    """Code words of blocks of ids below 16 ** digits, each block on its own."""
    if not blocks:
        return []
    sizes = np.array([len(b) for b in blocks])
    order, actives = _steps(sizes)
    n, steps = len(blocks), len(actives)
    ids = np.zeros((steps, n), np.int32)
    for k, i in enumerate(order):
        ids[: sizes[i], k] = blocks[i]
    model, out = Model(n, digits), Writer(n, int(steps * digits * 24 / 16) + 8)
    for step, a in enumerate(actives.tolist()):
        now = ids[step, :a].astype(np.int64)
        model.begin(a)
        for d in range(digits):
            shift = 4 * (digits - 1 - d)
            model.digit(d, now >> shift + 4)
            out.put(a, *model.spans(now >> shift & 15))
        model.learn(a, now)
    coded = out.close()
    back = [b""] * n
    for k, i in enumerate(order):
        back[i] = coded[k]
    return back


def decode_ids(coded: list[bytes], sizes: list[int], digits: int = 4) -> list[np.ndarray]:
    """The ids of blocks of the given sizes."""
    if not coded:
        return []
    size = np.array(sizes)
    order, actives = _steps(size)
    n, steps = len(coded), len(actives)
    ids = np.zeros((steps, n), np.int32)
    model, code = Model(n, digits), Reader([np.frombuffer(coded[i], "<u2") for i in order])
    for step, a in enumerate(actives.tolist()):
        now = np.zeros(a, np.int64)
        model.begin(a)
        for d in range(digits):
            model.digit(d, now)
            symbol = model.find(code.value(a, model.total + model.mass_two + model.mass_one))
            low, own, _ = model.spans(symbol)
            code.take(a, low, own)
            now = now << 4 | symbol
        ids[step, :a] = now
        model.learn(a, now)
    back: list[np.ndarray] = [np.empty(0, np.uint32)] * n
    for k, i in enumerate(order):
        back[i] = ids[: size[i], k].astype(np.uint32)
    return back


@dataclass(frozen=True)
class Piece:
    """A stretch of a document in a block: its id (None if null), its ids there, whether it begins and ends there."""

    doc_id: int | None
    length: int
    begins: bool
    ends: bool


PIECE = "<?qI??"


def seal(code: bytes, pieces: list[Piece], digits: int, magic: bytes = MAGIC) -> bytes:
    table = b"".join(
        struct.pack(PIECE, p.doc_id is None, p.doc_id or 0, p.length, p.begins, p.ends) for p in pieces
    )
    head = struct.pack(HEAD, magic, digits, sum(p.length for p in pieces), len(pieces), len(table), len(code))
    body = head + table + code
    return body + struct.pack("<I", zlib.crc32(body))


def _whole(data: bytes, magics: tuple[bytes, ...], least: int) -> None:
    if len(data) < least + 4 or data[:4] not in magics:
        raise CorruptBlock("not a block of token ids")
    if struct.unpack("<I", data[-4:])[0] != zlib.crc32(data[:-4]):
        raise CorruptBlock("checksum of a block of token ids is wrong")


def unseal(data: bytes) -> tuple[bytes, list[Piece], int]:
    """Code, pieces and digits of a block; raises ``CorruptBlock`` if a byte is wrong or missing."""
    _whole(data, (MAGIC, MIXED), struct.calcsize(HEAD))
    _, digits, _, n, table, code = struct.unpack_from(HEAD, data)
    at, size = struct.calcsize(HEAD), struct.calcsize(PIECE)
    pieces = []
    for k in range(n):
        null, doc, length, begins, ends = struct.unpack_from(PIECE, data, at + k * size)
        pieces.append(Piece(None if null else doc, length, begins, ends))
    return data[at + table : at + table + code], pieces, digits


def seal_group(blocks: list[tuple[np.ndarray, list[Piece]]], digits: int) -> list[bytes]:
    """The table of some blocks of ids below 16 ** digits, and the blocks."""
    table, coded = idmix.encode([ids for ids, _ in blocks])
    body = TABLE + table.pack()
    mark = struct.pack("<I", zlib.crc32(body))
    return [body + mark, *(seal(mark + c, pieces, digits, MIXED) for c, (_, pieces) in zip(coded, blocks))]


def unseal_table(data: bytes) -> tuple[bytes, idmix.Table]:
    """What the blocks of a table begin their code with, and the table."""
    _whole(data, (TABLE,), len(TABLE))
    return data[-4:], idmix.Table.unpack(data[4:-4])


def open_group(coded: list[bytes], sizes: list[int], table: tuple[bytes, idmix.Table] | None) -> list[np.ndarray]:
    """The ids of blocks coded with ``table``."""
    if table is None or any(c[:4] != table[0] for c in coded):
        raise CorruptBlock("the table of a block of token ids is missing")
    return idmix.decode(table[1], [c[4:] for c in coded], sizes)


def write(
    docs: DataFrame, tokenizer: str, path: str, end: int = 2, block: int = 4096, together: int = 2048, digits: int = 4
) -> None:
    """Encode the texts of ``docs`` (doc_id, text) and write their ids below ``path``, by ascending doc_id.

    Every document is followed by the id ``end``; null and empty texts are that id
    alone. Null doc_ids come first; rows of one doc_id all stay, in any order. The
    table is sorted by ranges of doc_id, so no task holds more than its range.
    """
    # a worker keeps a broadcast value from task to task, and with it the encoder and the words it remembers
    kept = docs.sparkSession.sparkContext.broadcast({"file": tokenizer})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept.value.get("encoder")
        if encoder is None:
            encoder = kept.value["encoder"] = Encoder(kept.value["file"])
        shard, number = TaskContext.get().partitionId(), 0
        full: list[tuple[np.ndarray, list[Piece]]] = []
        ids: list[np.ndarray] = []
        pieces: list[Piece] = []
        room = block

        def emit():
            nonlocal number, full
            data = seal_group(full, digits)
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard] * len(data), pa.int32()),
                    pa.array(range(number, number + len(data)), pa.int64()),
                    pa.array([0, *(len(b) for b, _ in full)], pa.int64()),
                    pa.array(data, pa.binary()),
                ],
                names=["shard", "block", "n_tokens", "data"],
            )
            number += len(data)
            full = []
            return rows

        # what texts share is looked up once a batch
        for batch in text_batches(batches, 8 << 20):
            found = encoder.encode(batch.column("text"))
            for doc, x in zip(batch.column("doc_id").to_pylist(), found):
                x = np.append(x, np.uint32(end))
                at = 0
                while at < len(x):
                    part = x[at : at + room]
                    ids.append(part)
                    pieces.append(Piece(doc, len(part), at == 0, at + len(part) == len(x)))
                    at += len(part)
                    room -= len(part)
                    if not room:
                        full.append((np.concatenate(ids), pieces))
                        ids, pieces, room = [], [], block
                        if len(full) == together:
                            yield emit()
        if pieces:
            full.append((np.concatenate(ids), pieces))
        if full:
            yield emit()

    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, "shard int, block long, n_tokens long, data binary").write.parquet(path)


def read(spark: SparkSession, path: str, together: int = 2048) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of the documents below ``path``.

    A shard is read in one task, and every task reads as many shards, up to ``together`` blocks of a table at once; ids
    of one document are checked as they come and never gathered.
    """
    blocks = spark.read.parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # one row per shard: the only table that one task sees whole
    before = sizes.select(
        "shard",
        (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"shard": None, "at": 0, "crc": 0, "n": 0, "start": 0}
        table, kind = None, b""
        waiting: list[tuple[int, bytes, list[Piece], int]] = []

        def emit():
            nonlocal waiting
            sizes = [sum(p.length for p in pieces) for _, _, pieces, _ in waiting]
            coded = [c for _, c, _, _ in waiting]
            ids = open_group(coded, sizes, table) if kind == MIXED else decode_ids(coded, sizes, waiting[0][3])
            out = []
            for (shard, _, pieces, _), x in zip(waiting, ids):
                if shard != state["shard"]:
                    state.update(shard=shard, at=0)
                data = x.astype("<u4").tobytes()
                k = 0
                for p in pieces:
                    if p.begins:
                        state.update(crc=0, n=0, start=state["at"])
                    state["crc"] = zlib.crc32(data[4 * k : 4 * (k + p.length)], state["crc"])
                    state["n"] += p.length
                    state["at"] += p.length
                    k += p.length
                    if p.ends:
                        out.append((shard, p.doc_id, state["start"], state["n"], state["crc"]))
            waiting = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, (pa.int32(), *[pa.int64()] * 4))],
                names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
            )

        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist()):
                if waiting and (data[:4] != kind or len(waiting) == together):
                    yield emit()
                kind = data[:4]
                if kind == TABLE:
                    table = unseal_table(data)
                else:
                    waiting.append((shard, *unseal(data)))
        if waiting:
            yield emit()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = (
        blocks.select("shard", "block", "data").repartitionById(parts, "shard").sortWithinPartitions("shard", "block")
    )
    docs = ordered.mapInArrow(run, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(before, "shard").select(
        "doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
